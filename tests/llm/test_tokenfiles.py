import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rivermill.llm import queries, tokenfiles

LIBRARY = Tokenizer.from_file(queries.WORD_MODEL)
ODD = [
    "Don't <|endoftext|>stop <|startoftext|> it'S x'll", "tab\there and there ́combining é ẛ̣", "ΑΣ ΑΣ. ΣΑΣ İstanbul ǅ ﬁ",
    "a\x0bb\x0cc\r\nd\x1ce\x85f", "  lead  and \n\n trail \n", "😀👩‍👩‍👧 日本語テスト 한국어", "1234 56.78 #tag ## 2 # ''s '", "\x00 null ﻿ bom", "x" * 5000,
]


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sSdtΣé́<|>")), max_size=40), max_size=6))
def test_words_encoded_once_give_the_librarys_ids(texts):
    encoder = tokenfiles.Encoder(LIBRARY.to_str())
    for part in (texts, [*texts, *ODD]):
        if part:
            flat, counts = encoder.encode(part)
            assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [ids_of(t)[:-1] for t in part]


@pytest.mark.parametrize("held", [0, 8, 1 << 19])
def test_words_that_return_and_marks_next_to_them(monkeypatch, held):
    monkeypatch.setattr(tokenfiles, "HELD_WORDS", held)
    encoder, texts = tokenfiles.Encoder(LIBRARY.to_str()), ["Word, word. WORD word., wor'd. İx. . , ., a. A.", "", "word, A. b", "x" * 100 + ". end", "".join(map(chr, range(256))), " ".join(map(chr, range(0x250))), "Éàÿß. ÀÞ, ªº µ"]
    for part in (texts, ODD, texts[:1], texts * 2, ODD):
        flat, counts = encoder.encode(part)
        assert encoder.by_word and [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [ids_of(t)[:-1] for t in part]


def test_another_model_is_encoded_whole():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = tokenfiles.Encoder(library.to_str())
    flat, counts = encoder.encode(ODD)
    assert not encoder.by_word and [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in ODD]


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    keys = np.random.default_rng(n).integers(-(2**63), 2**63 - 1, n)
    prints = tokenfiles.fingerprints(keys)
    levels = tokenfiles.build(np.unique(prints))
    assert sorted(tokenfiles.slots(levels, prints)) == list(range(n))
    at = np.arange(n)
    blob = tokenfiles.pack(keys, at, at * 3, at + 1, at + 2)
    rows, columns = tokenfiles.find(blob, np.concatenate([keys[::-1], np.arange(1000)]))
    assert rows.tolist() == list(range(n)) and [c.tolist() for c in columns] == [list((f * at + g)[::-1]) for f, g in ((1, 0), (3, 0), (1, 1), (1, 2))]


@pytest.fixture(scope="module")
def rows():
    texts = [f"word{k % 37} and {'more ' * (k % 50)}#{k}" for k in range(300)]
    return [(int((k * 7919) % 100_003) - 5000, t) for k, t in enumerate(texts)] + [(200_000 + k, t) for k, t in enumerate(ODD)]


def by_the_book(rows):
    """Rows of one id may stand in any order; they are compared as the set of their ids, and by the starts of the run."""
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(t)
        out.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_files_and_index_give_every_document_back(spark, docs, rows, tmp_path):
    path, index = str(tmp_path / "ids"), str(tmp_path / "index")
    tokenfiles.write_ids(docs(rows, clash=True), path, queries.WORD_MODEL, 2, shard_bytes=4000)
    tokenfiles.build_index(spark, path, index, keys_per_part=50)
    asked = spark.createDataFrame([(i,) for i, _ in rows[::2]] * 2 + [(-77_777,), (None,)], "key LONG")
    got = tokenfiles.read_documents(spark, path, index, asked).collect()
    wanted = {i for i, _ in rows[::2]}
    assert sorted((r.key, r.start, r.n_tokens, r.ids_crc32) for r in got) == [w for w in by_the_book(rows) if w[0] in wanted]
    files = sorted((tmp_path / "ids").glob("part-*"))
    payload = b"".join(bytes(tokenfiles._shard(memoryview(f.read_bytes()))[3]) for f in files if f.stat().st_size)
    assert len(files) > 3 and np.frombuffer(payload, "<u2").tolist() == [x for _, t in sorted(rows) for x in ids_of(t)]


def test_odd_rows_and_shared_ids(spark, docs, odd_rows, tmp_path):
    rows = odd_rows + [(None, "second without id")] + [(6, f"copy {k}") for k in range(40)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.token_files(spark, str(tmp_path)).collect()
    want = by_the_book(rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((w[0], w[2], w[3]) for w in want)
    ends = sorted((r.start, r.start + r.n_tokens, r.doc_id) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and [e[2] for e in ends] == [w[0] for w in want]


def test_wide_ids_and_another_end(spark, docs, tmp_path):
    tokenfiles.write_ids(docs([(1, "two words"), (2, "")]), str(tmp_path / "ids"), queries.WORD_MODEL, 70_500)
    (file,) = [f for f in (tmp_path / "ids").glob("part-*") if f.stat().st_size]
    *_, data, width = tokenfiles._shard(memoryview(file.read_bytes()))
    assert width == 4 and np.frombuffer(data, "<u4").tolist() == [*ids_of("two words")[:-1], 70_500, 70_500]


def test_no_rows(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.token_files(spark, str(tmp_path)).count() == 0


def test_a_cut_shard_is_an_error(spark, docs, tmp_path):
    tokenfiles.write_ids(docs([(1, "a few words")]), str(tmp_path / "ids"), queries.WORD_MODEL, 2)
    (file,) = [f for f in (tmp_path / "ids").glob("part-*") if f.stat().st_size]
    with pytest.raises(ValueError):
        tokenfiles._shard(memoryview(file.read_bytes()[:-10]))
