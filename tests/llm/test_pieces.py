import random
from collections import Counter

import pytest
import sentencepiece

from rivermill.llm import pieces
from rivermill.llm.queries import PIECE_MODEL


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary.load(PIECE_MODEL))


def encoded(encoder, texts):
    flat, counts = encoder.encode(texts)
    out, at = [], 0
    for n in counts:
        out.append(flat[at : at + n].tolist())
        at += n
    return out


def test_ids_are_those_of_the_model(encoder, library):
    rng = random.Random(7)
    parts = ["the", " ", "  ", "a", "tion", "\n", "é", "日", "😀", "th", "er", "x", "Z", "12", "==", "-", "\t", "\0", "▁", "</s>", "ﬁ", "​"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 90))) for _ in range(600)]
    texts += [" " * k + "x" + " " * k for k in range(60)] + ["", "日本語の文章" * 200, "a" * 3000, "word " * 5000]
    assert encoded(encoder, texts) == [library.encode(t) for t in texts]


def test_segments_met_before_give_the_same_ids(encoder, library, monkeypatch):
    texts = ["some words, some more words", "words more some"]
    first = encoded(encoder, texts)
    monkeypatch.setattr(pieces, "REMEMBERED", 0)  # forgets before every call
    assert encoded(encoder, texts) == first == [library.encode(t) for t in texts]


def test_decoding_is_that_of_the_model(encoder, library):
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(3, 32000) for _ in range(rng.randint(0, 12))]
        if not any(i < 259 for i in ids):  # loose bytes are no text
            assert encoder.decode(ids) == library.decode(ids)
    assert encoder.decode([]) == ""


def test_odd_rows_and_round_trip(spark, docs, odd_rows, library):
    got = pieces.encode(spark, docs(odd_rows, clash=True), PIECE_MODEL).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.n_tokens) for r in got) == Counter((i, tuple(library.encode(t or "")), len(library.encode(t or ""))) for i, t in odd_rows)
    assert {r.doc_id for r in got if not r.restored} == {7}  # holds a mark, which decodes as a space
    back = pieces.decode(spark, spark.createDataFrame(got), PIECE_MODEL).collect()
    assert Counter(map(tuple, back)) == Counter((i, (t or "").replace("▁", " ")) for i, t in odd_rows)
    assert pieces.encode(spark, docs([]), PIECE_MODEL).count() == 0


def test_long_texts_are_runs_of_their_own(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pieces, "BATCH_CHARS", 10)
    texts = ["abc", None, "x" * 50, "", "defgh", "ijklmnop"]
    runs = list(pieces._pieces_of(pa.array(texts)))
    assert [t for _, run in runs for t in run] == texts and [b for b, _ in runs] == [0, 2, 3, 5]


def test_other_kinds_of_models_are_refused():
    with pytest.raises(ValueError, match="tied scores"):
        pieces.Encoder(pieces.Vocabulary(("<unk>", "▁", "a", "b", "ab", "ba"), (0, -9, -9, -9, -1, -1), "unnnnn"))
