import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rivermill.llm import queries, spelling


def counted(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            seen[low] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_the_book(rows):
    words = counted(rows)
    forms, out = {}, []
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out.append((w, forms[w], n, len(close), words[forms[w]] if forms[w] else None))
    end = lambda w: end(forms[w]) if forms[w] else w
    return sorted((w, f, end(w), n, k, m) for w, f, n, k, m in out)


def collected(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.fixture(scope="module")
def words():
    rng = np.random.default_rng(5)
    letters = np.array(list("abeéàÿ"))
    base = ["".join(rng.choice(letters, rng.integers(5, 9))) for _ in range(60)]
    texts = []
    for k in range(400):
        w = base[int(rng.integers(0, 60) ** 2 / 60)]
        at = int(rng.integers(0, len(w)))
        change = [w, w, w, w[:at] + w[at + 1 :], w[:at] + "e" + w[at:], w[:at] + "é" + w[at + 1 :]][int(rng.integers(0, 6))]
        texts.append((k % 90, " ".join([change.upper() if k % 11 == 0 and change.isascii() else change, w, "aaaaa", "aaaaaa"])))
    return texts


def test_equal_to_brute_force(docs, words, odd_rows):
    rows = words + odd_rows + [(900 + k, "Ärgerß " + "q" * 3000 + " " + "q" * 2999 + " 日本 abc") for k in range(4)]
    assert collected(spelling.variants(docs(rows, clash=True))) == by_the_book(rows)


def test_every_long_chain_of_forms_has_its_end(docs):
    chain = [("stone" + "s" * k, 2**k) for k in range(2, 8)]  # each twice as frequent as the one before
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    assert collected(spelling.variants(docs(rows))) == by_the_book(rows)


def test_numbers_that_stand_for_two_nodes_are_found_and_another_seed_is_taken(spark, docs, words):
    poor = lambda parent, letter, seed: spelling.fingerprint(parent, letter, seed) % np.uint64(1 << 12 if seed < 2 else 1 << 63)
    table = spark.createDataFrame([(w,) for w in counted(words)], "word STRING")
    assert [spelling.ambiguous(table, s, poor) for s in (0, 1, 2)] == [True, True, False]
    assert collected(spelling.variants(docs(words), number=poor)) == by_the_book(words)


def test_no_rows(docs):
    assert spelling.variants(docs([])).count() == 0 and spelling.variants(docs([(1, "ab cd"), (2, None)])).count() == 0


def test_query(spark, docs, words, tmp_path):
    docs(words).write.parquet(str(tmp_path / "documents.parquet"))
    assert collected(queries.spelling_variants(spark, str(tmp_path))) == by_the_book(words)
