import hashlib
from collections import defaultdict

import numpy as np
import pytest

from rivermill.llm import codes, queries

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def by_the_book(rows, length, entries=16, rounds=6):
    """Kept rows (id, code, error, label), and the codebooks, in plain whole numbers."""
    kept = [(i, [int(np.floor(np.float64(x) * 4096)) if abs(x) < 2**60 else int(np.float64(x)) * 4096 for x in v], g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    others = [(i, None, None, g) for i, v, g in kept if len(v) != length]
    kept = sorted((r for r in kept if len(r[1]) == length), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wide = -(-length // 8)
    cut = [[(v + [0] * (8 * wide - length))[k * wide : (k + 1) * wide] for _, v, _ in kept] for k in range(8)]
    books = [[list(x) for x in part[:entries]] for part in cut]
    away = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (away(x, book[e]), e))
    for _ in range(rounds):
        for part, book in zip(cut, books):
            groups = defaultdict(list)
            for x in part:
                groups[nearest(x, book)].append(x)
            for e, own in groups.items():
                book[e] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for n, (i, _, g) in enumerate(kept):
        chosen = [nearest(part[n], book) for part, book in zip(cut, books)]
        out.append((i, "".join(f"{e:02x}" for e in chosen), sum(away(part[n], book[e]) for part, book, e in zip(cut, books, chosen)), g))
    return out + others, books


def check(spark, rows, length):
    got, books = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    want, want_books = by_the_book(rows, length)
    assert [b.tolist() for b in books] == want_books
    assert codes.digest(books) == hashlib.sha256(",".join(str(v) for b in want_books for e in b for v in e).encode()).hexdigest()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1:]))
    fits = lambda x: x if x is None or x < 2**63 else None
    assert sorted(((r.vec_id, r.code, r.error, r.label) for r in got.collect()), key=key) == sorted(((i, c, fits(e), g) for i, c, e, g in want), key=key)
    totals = defaultdict(int)
    for _, _, e, g in want:
        totals[g] += e or 0
    assert {r.label: r.label_error for r in got.collect()} == {g: fits(t) for g, t in totals.items()}


def clustered(n, length, seed, ties=False):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.3, (5, length))
    points = middles[rng.integers(0, 5, n)] + rng.normal(0, 0.05, (n, length))
    return np.round(points * 8) / 8 if ties else points


@pytest.mark.parametrize("ties", [False, True])
def test_equal_to_plain_lloyd(spark, monkeypatch, ties):
    points = clustered(600, 16, 3, ties).astype(np.float32)
    rows = [(int(i), [float(x) for x in p], int(i) % 3 if i % 7 else None) for i, p in enumerate(points)]
    rows += [(1000 + k, rows[5][1], 1) for k in range(80)]  # many copies of one vector
    monkeypatch.setattr(codes, "BLOCK", 128)
    check(spark, rows, 16)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k % 5)] * 10, 0) for k in range(30)]
    rows += [(90, None, 0), (91, [nan] * 10, 0), (92, [inf] + [0.0] * 9, 1), (93, [None] + [0.0] * 9, 1), (94, [1.0] * 3, 2), (95, [], 2), (None, [0.5] * 10, None), (7, [9.5] * 10, 4), (7, [9.5] * 10, 4)]
    check(spark, rows, 10)


def test_numbers_beyond_64_bits(spark):
    rows = [(k, [3.0e38 * (-1) ** k, 1e-3 * k, float(k), -1.0, 0.0, 2.0, 5e20, 1.0], k % 2) for k in range(40)]
    rows = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in rows]
    check(spark, rows, 8)


def test_fewer_vectors_than_entries_and_none(spark):
    check(spark, [(k, [0.1 * k] * 8, None) for k in range(11)], 8)
    check(spark, [(k, [0.0] * 8, None) for k in range(40)], 8)
    out, books = codes.compress(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and codes.digest(books) == hashlib.sha256(b"").hexdigest()


def test_most_parts_are_assigned_by_whole_nodes(monkeypatch):
    points = (clustered(1024, 8, 1) * 4096).astype(np.int64)
    compared = []
    plain = codes._compare
    monkeypatch.setattr(codes, "_compare", lambda p, e, b, nodes, *rest: (compared.append(len(np.unique(nodes)) * 32), plain(p, e, b, nodes, *rest)))
    nearest, counts, sums = codes.assign(codes.grow(points, 16), points[:5])
    away = ((points[:, None, :] - points[None, :5, :]) ** 2).sum(axis=2)
    assert (nearest == away.argmin(axis=1)).all() and counts.tolist() == np.bincount(nearest, minlength=5).tolist()
    assert all((sums[e] == points[nearest == e].sum(axis=0)).all() for e in range(5)) and sum(compared) < 1024


def test_query(spark, tmp_path):
    rows = [(k, [float(x) for x in np.random.default_rng(k).normal(size=64).astype(np.float32)], k % 3, "x") for k in range(60)]
    spark.createDataFrame(rows, SCHEMA + ", code STRING").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.vector_codes(spark, str(tmp_path)).collect()
    want, _ = by_the_book([r[:3] for r in rows], 64)
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [w[:3] for w in want] and len({r.codebooks_sha256 for r in got}) == 1
