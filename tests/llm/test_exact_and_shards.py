import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivermill.llm import exact, queries, shards


def groups_of(rows):
    by = defaultdict(list)
    for i, text in rows:
        by[text or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by.items()}


@pytest.mark.parametrize("weak", [False, True])
def test_groups_equal_brute_force(docs, odd_rows, weak):
    rows = odd_rows + [(k, f"t{k % 7}") for k in range(100, 160)]
    digest = (lambda t: F.substring(exact.sha256(t), 1, 0)) if weak else exact.sha256  # one digest for all: only the texts tell
    want = groups_of(rows)
    got = exact.copy_groups(docs(rows, clash=True), digest=digest, salts=3).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(
        (i, *want[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows
    )
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) and {r.text_sha256 for r in kept} == {hashlib.sha256(t.encode()).hexdigest() for t in want}


@pytest.mark.parametrize("weak", [False, True])
def test_distinct_rows_keep_the_largest_id_and_all_columns(docs, odd_rows, weak):
    df = docs(odd_rows, clash=True)
    digest = (lambda t: F.substring(exact.sha256(t), 1, 0)) if weak else exact.sha256
    out = exact.distinct_rows(df, digest=digest)
    assert out.schema.names == df.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    want = groups_of(odd_rows)
    assert Counter((r.doc_id, r.text or "", r.size) for r in out.collect()) == Counter((i, t, "x") for t, (i, _) in want.items())


def test_no_rows(docs):
    assert exact.copy_groups(docs([])).count() == 0 and exact.distinct_rows(docs([])).count() == 0
    assert shards.assign_shards(docs([]), "doc_id", 4).count() == 0


def jump_by_the_book(key, buckets):
    b, j = -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one():
    keys = [0, 1, 2, 2**63, 2**64 - 1, *range(1000, 1400)]
    for n in (1, 2, 8, 9, 1000):
        assert shards.jump(np.array(keys, np.uint64), n).tolist() == [jump_by_the_book(k, n) for k in keys]


def test_growing_moves_rows_only_into_the_new_shard_and_slots_have_no_gaps(docs):
    rows = [(k, "x" * (k % 13)) for k in range(2000)]
    got = shards.assign_shards(docs(rows, clash=True), "doc_id", 8, size=F.length("text")).collect()
    assert len(got) == 2000
    moved = [r for r in got if r.shard != r.grown_shard]
    assert all(r.grown_shard == 8 for r in moved) and 2000 / 9 * 0.7 < len(moved) < 2000 / 9 * 1.3
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_any_key_type_and_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k STRING")
    got = shards.assign_shards(df, "k", 5).collect()
    assert len(got) == 4 and len({r.shard for r in got if r.k == "a"}) == 1


def test_query_of_sharding(spark, docs, odd_rows, tmp_path):
    docs(odd_rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.sharding(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want and {r.law for r in got} == {"key"}
