"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A text is the weighted set of its windows of five words (all its words where there are fewer). A window weighs its count
in the text times `1 + IDF_SHARE * ln((N + 1) / (df + 1)) / ln(N + 1)`. The share is small on purpose: windows that
many texts share count less, yet a large group of near copies does not lose its similarity to its own size. Document
frequencies come from all documents, as a count-min sketch of fixed size less its expected noise.

Consistent weighted sampling draws `BANDS * ROWS` samples per distinct text; two texts agree in a sample with
the probability of their weighted Jaccard similarity. Texts that share a band are compared, on their whole weighted
sets, with the leader of that bucket, the member that shares the most buckets with others, unless they are in its class
already; then the leader leaves and the next one leads, for `ROUNDS` rounds. The members of buckets that still hold more
than one class meet anew by the rarest of their windows: as many as any two texts of at least the threshold must share
one of. There two are compared only if what both still have from that window on could reach the threshold, which is the
case in one group of every similar pair: that of the rarest window they share. Those groups go on until nobody is left to
lead. Texts are moved only if a bitmap of fixed size says that somebody asks for them. So every pair that shares a band is verified, in one class
already, or below the threshold by an exact bound. Links of at least the threshold make classes; a class is named after
its smallest id.

A null or empty text has no windows and equals only its like; texts are equal when identical (null counts as empty). Ids are whole numbers. Rows that share an
id are one document; a row without an id takes the class of its equals, and has none if no row with an id equals it.
Texts of any length are compared whole; empty tables give empty results; further columns are carried by
`drop_near_duplicates`, whatever their names, and left out by `near_duplicates`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.session import drop_path, fresh_path, materialise

SPAN, THRESHOLD, IDF_SHARE = 5, 0.8, 0.25
#: A pair of similarity 0.8 shares no band with a probability of 0.0002.
BANDS, ROWS = 16, 4
ROUNDS = 2
#: Growth of the number of leaders per round among crowded texts, and room for rounding in bounds on sums of weights.
LEADERS, SLACK = 4, 1e-4
#: Cells of the frequency sketch, and how it is cut for summing up: 64 strips of 64 KB, met over two stages.
CELL_BITS, STRIPS, SALTS = 20, 64, 1024
#: Bits of the bitmap that tells which texts to fetch: 4 MB; more ids than that only let through more rows than needed.
BITMAP_BITS = 1 << 25
#: Rows of the variate tables; a window takes rows for r, c and beta by three parts of its hash.
POOL_BITS, SEED = 12, 20240229
#: Bytes of text hashed, and windows sampled, at once.
CHUNK_BYTES, CHUNK_WINDOWS = 1 << 20, 2048

_U = np.uint64
_BASE, _UNBASE = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = [_U(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(SPAN)]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(1 << bits, _BASE), np.full(1 << bits, _UNBASE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of all texts, and where each text's begin (one more than texts)."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    up, down = _powers(max(16, int(len(data)).bit_length()))
    inside = ~_BLANK[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = turns[::2], turns[1::2]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)])])
    words = _mix((sums[end] - sums[begin]) * down[begin])
    first = np.searchsorted(begin, np.cumsum(sizes + 1) - sizes)
    count = np.diff(np.append(first, len(words)))
    padded = np.concatenate([words, np.zeros(SPAN, _U)])
    whole = np.zeros(len(words), _U)
    short = np.minimum(count, SPAN)
    left = np.repeat(first + count, count) - np.arange(len(words))  # words from here to the end of the text
    for k in range(SPAN):
        whole += np.where(left > k, padded[k : k + len(words)] * _STEP[k], _U(0))
    starts = (left >= SPAN) | ((np.repeat(short, count) < SPAN) & (left == np.repeat(count, count)))
    hashes = _mix(whole[starts])
    per_text = np.where(count >= SPAN, count - SPAN + 1, np.minimum(count, 1))
    return hashes, np.concatenate([[0], np.cumsum(per_text)])


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about CHUNK_BYTES; a longer text is a run of its own. Null is empty."""
    begin, held, size = 0, [], 0
    for k in range(len(texts)):
        text = texts[k].as_buffer()
        raw = text.to_pybytes() if text is not None else b""
        if held and size + len(raw) > CHUNK_BYTES:
            yield begin, held
            begin, held, size = k, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield begin, held


# -- document frequencies ------------------------------------------------------------------------------------------------


def frequency_sketch(docs: DataFrame, text: str) -> np.ndarray:
    """Weight per cell. What comes to the driver is the sketch, 4 MB whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n = np.zeros(1 << CELL_BITS, np.int64), 0
        for batch in batches:
            for _, texts in _chunks(batch.column(0)):
                hashes, bounds = windows(texts)
                # once per text: the number in the run above the leading bits of the hash
                tagged = np.repeat(np.arange(len(texts), dtype=_U) << _U(44), np.diff(bounds)) | hashes >> _U(20)
                cells += np.bincount(((np.unique(tagged) >> _U(44 - CELL_BITS)) & _U((1 << CELL_BITS) - 1)).astype(np.int64), minlength=1 << CELL_BITS)
                n += len(texts)
        if n:
            strips = [pa.scalar(part.tobytes(), pa.binary()) for part in np.split(cells, STRIPS)]
            yield pa.RecordBatch.from_pydict({"strip": pa.array(range(STRIPS), pa.int32()), "n": pa.array([n] * STRIPS, pa.int64()), "cells": pa.array([s.as_py() for s in strips], pa.binary())})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << CELL_BITS) // STRIPS, np.int64)
        for part in frame["cells"]:
            total += np.frombuffer(part, np.int64)
        return pd.DataFrame({"strip": [frame["strip"].iloc[0]], "n": [frame["n"].sum()], "cells": [total.tobytes()]})

    schema = "strip int, n long, cells binary"
    parts = docs.select(text).mapInArrow(count, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = parts.groupBy("strip", "salt").applyInPandas(lambda f: add(f), schema)
    rows = sorted(some.groupBy("strip").applyInPandas(lambda f: add(f), schema).collect())
    if not rows:
        return np.ones(1 << CELL_BITS, np.float32)
    cells = np.concatenate([np.frombuffer(r["cells"], np.int64) for r in rows]).astype(np.float64)
    n = rows[0]["n"]
    noise = (cells.sum() - cells) / (len(cells) - 1)  # what other windows are expected to add to a cell
    df = np.clip(cells - noise, 1, n)
    return (1 + IDF_SHARE * np.log((n + 1) / (df + 1)) / np.log(n + 1)).astype(np.float32)


def weighted_sets(texts: list[bytes], weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct windows of every text, ascending, and their weights."""
    hashes, bounds = windows(texts)
    for a, b in zip(bounds[:-1], bounds[1:]):
        own, counts = np.unique(hashes[a:b], return_counts=True)
        yield own, counts * weights[(own >> _U(64 - CELL_BITS)).astype(np.int64)]


# -- samples -------------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _variates() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    shape = (1 << POOL_BITS, BANDS * ROWS)
    r = rng.gamma(2, 1, shape)
    return r.astype(np.float32), (1 / r).astype(np.float32), np.log(rng.gamma(2, 1, shape)).astype(np.float32), rng.random(shape, np.float32)


def band_keys(own: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One key per band, of the window and level that each sample of the band has drawn."""
    r, inverse, c, beta = _variates()
    mask = _U((1 << POOL_BITS) - 1)
    best = np.full(BANDS * ROWS, np.inf, np.float32)
    drawn, level, columns = np.zeros(BANDS * ROWS, _U), np.zeros(BANDS * ROWS, np.int64), np.arange(BANDS * ROWS)
    logs = np.log(weights).astype(np.float32)
    for at in range(0, len(own), CHUNK_WINDOWS):
        h = own[at : at + CHUNK_WINDOWS]
        i, j, k = ((h >> _U(s) & mask).astype(np.int64) for s in (0, POOL_BITS, 2 * POOL_BITS))
        shift = beta[k]
        t = np.floor(logs[at : at + CHUNK_WINDOWS, None] * inverse[i] + shift)
        a = c[j] - r[i] * (t - shift + 1)
        least = a.argmin(axis=0)
        value = a[least, columns]
        won = value < best
        best[won], drawn[won], level[won] = value[won], h[least[won]], t[least[won], columns[won]]
    samples = _mix(drawn + _mix(level.astype(_U) + (columns.astype(_U) << _U(32)))).reshape(BANDS, ROWS)
    return _mix((samples * np.array(_STEP[:ROWS])).sum(axis=1, dtype=_U)).view(np.int64)


def signed(docs: DataFrame, shipped, text: str, doc_id: str) -> DataFrame:
    """`id`, `digest` of the text, and its band keys (none without windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _chunks(batch.column(1)):
                keys = [band_keys(own, w) if len(own) else [] for own, w in weighted_sets(texts, shipped.value)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "digest", "bands"],
                )

    return docs.select(F.col(doc_id).cast("long"), text).mapInArrow(run, "id long, digest binary, bands array<long>")


# -- steps ---------------------------------------------------------------------------------------------------------------


class Steps:
    """Written intermediate tables; those of a round go when it is over."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()


# -- pairs ---------------------------------------------------------------------------------------------------------------


def similar(pairs: DataFrame, texts: DataFrame, shipped) -> DataFrame:
    """Pairs (`a`, `b`) with `alike`; the sets of both are compared whole."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: tuple[object, tuple[np.ndarray, np.ndarray] | None] = (None, None)
        for frame in frames:
            alike = []
            for b, mine, theirs in zip(frame["b"], frame["text_a"], frame["text_b"]):
                if known[0] != b:  # rows of one leader mostly follow each other
                    known = (b, next(weighted_sets([(theirs or "").encode()], shipped.value)))
                alike.append(jaccard(next(weighted_sets([(mine or "").encode()], shipped.value)), known[1]) >= THRESHOLD)
            yield pd.DataFrame({"a": frame["a"], "b": frame["b"], "alike": alike})

    def needed(side: str) -> DataFrame:  # a later round asks for few texts; only those are moved
        return likely(texts, pairs.select(F.col(side).alias("rep"))).select(F.col("id").alias(side), F.col("text").alias(f"text_{side}"))

    left, right = needed("a"), needed("b")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInPandas(run, "a long, b long, alike boolean")


def jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets with ascending elements."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    hit = y[0][at] == x[0]
    shared = np.minimum(x[1][hit], y[1][at[hit]]).sum(dtype=np.float64)
    return float(shared / (x[1].sum(dtype=np.float64) + y[1].sum(dtype=np.float64) - shared))


def likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose `id` may be a wanted `rep`, told before any shuffle by a bitmap of hashed ids of `BITMAP_BITS`, whatever the input."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP_BITS))
    own = bit(F.col("rep"))
    bitmap = wanted.groupBy(F.bitmap_bucket_number(own).alias("_at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias("_bits"))
    placed = rows.withColumns({"_at": F.bitmap_bucket_number(bit(F.col("id"))), "_bit": F.bitmap_bit_position(bit(F.col("id"))).cast("int")})
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = F.expr("shiftright(_byte, _bit % 8) % 2 = 1")
    return placed.join(F.broadcast(bitmap), "_at").withColumn("_byte", byte).where(found).select(*rows.columns)


def postings(texts: DataFrame, shipped) -> DataFrame:
    """The rarest windows of every text (`rep`): what is left weighs less than the threshold's share of its `total`.

    Texts of at least the threshold share more than what is left of either, so one of these windows at least, by any order
    of the windows that is the same for all texts. `rest` is the weight of what is left, `ahead` that of the window and all
    that come after it: what two texts can share at most if it is the first one that both have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, held in _chunks(batch.column(1)):
                ids = batch.column(0).slice(begin, len(held)).to_numpy(zero_copy_only=False)
                for rep, (own, weights) in zip(ids, weighted_sets(held, shipped.value)):
                    each = shipped.value[(own >> _U(64 - CELL_BITS)).astype(np.int64)]
                    order = np.lexsort((own, -each))
                    sums = np.cumsum(weights[order], dtype=np.float64)
                    if not len(sums):
                        continue
                    # a little more than needed, for sums that differ in their last bits
                    n = min(int(np.searchsorted(sums, sums[-1] * (1 - THRESHOLD * (1 - SLACK)), "right")) + 1, len(sums))
                    each = weights[order[:n]].astype(np.float64)
                    columns = [own[order[:n]].view(np.int64), np.full(n, rep), each, np.full(n, sums[-1]), np.full(n, sums[-1] - sums[n - 1]), sums[-1] - sums[:n] + each]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "rep", "weight", "total", "rest", "ahead"])

    return texts.select("id", "text").mapInArrow(run, "bucket long, rep long, weight double, total double, rest double, ahead double")


def relabel(named: DataFrame, edges: DataFrame) -> DataFrame:
    """`named` (`rep`, `label`) after further links between classes."""
    side = lambda c: named.select(F.col("rep").alias(c), F.col("label").alias(f"of_{c}"))
    between = edges.join(side("a"), "a").join(side("b"), "b").where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()
    between = materialise(between, "near-between")
    if between.isEmpty():
        return named
    onward = components(between).withColumnsRenamed({"id": "was", "label": "onward"})
    return materialise(named.join(onward, F.col("label") == F.col("was"), "left").select("rep", F.coalesce("onward", "label").alias("label")), "near-named")


def links(spark: SparkSession, reps: DataFrame, docs: DataFrame, shipped, text: str, doc_id: str) -> DataFrame:
    """Pairs (`a`, `b`) of a representative and the smallest one of its class, of classes of more than one."""
    entries = reps.select("rep", F.explode("bands").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(entries.join(crowded, "bucket"), "near-members")
    shares = members.groupBy("rep").agg(F.sum("n").alias("shares"))
    place = F.struct("shares", (-F.col("rep")).alias("neg"))
    open_ = materialise(members.join(shares, "rep").select("bucket", "rep", place.alias("place")), "near-places")
    wanted = open_.select("rep").distinct()
    # the bitmap lets a few more through, which nobody asks for; an exact join would move all texts
    texts = materialise(likely(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), wanted), "near-texts")
    named = materialise(wanted.withColumn("label", F.col("rep")), "near-named")
    tried, left, old = None, True, Steps(spark)
    for _ in range(ROUNDS):
        own = Steps(spark)
        placed = own.write(open_.join(named, "rep"), "near-open")
        old.drop()
        top = placed.groupBy("bucket").agg(F.max(F.struct("place", "label")).alias("top"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        top = own.write(top.where("lo <> hi").select("bucket", "top"), "near-leaders")
        left = not top.isEmpty()
        if not left:  # no bucket holds two classes
            break
        # the leader meets all that are left of its bucket and leaves; those of its class need no comparison
        asked = own.write(placed.join(top, "bucket").where("place < top.place").withColumn("lead", -F.col("top.place.neg")), "near-asked")
        pairs = asked.where("label <> top.label").select(F.greatest("rep", "lead").alias("a"), F.least("rep", "lead").alias("b")).distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        checked = materialise(similar(own.write(pairs, "near-pairs"), texts, shipped), "near-checked")
        tried = checked if tried is None else tried.unionByName(checked)
        named = relabel(named, checked.where("alike"))
        open_, old = asked.select("bucket", "rep", "place"), own
    if left:
        named = crowded_links(open_, named, tried, texts, shipped)
    return named.where("label <> rep").select(F.col("rep").alias("a"), F.col("label").alias("b"))


def crowded_links(open_: DataFrame, named: DataFrame, tried: DataFrame, texts: DataFrame, shipped) -> DataFrame:
    """`named` after all links among the members of buckets that still hold more than one class.

    Every round some texts lead, by their hash, in all their groups at once: `LEADERS` times as many as before, so that
    large classes close before all meet all, and at last everybody. Who has led leaves. A member that could reach the
    threshold with nobody of its group, by the smallest total and the largest room there, leaves before; and two meet
    only where they could reach it if the group's window was the first they share, which it is for one of their groups.
    """
    spark = open_.sparkSession
    mixed = open_.join(named, "rep").groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    reps = materialise(open_.join(materialise(mixed.select("bucket"), "near-mixed"), "bucket").select("rep").distinct(), "near-crowded")
    old = Steps(spark)
    rows = old.write(postings(likely(texts, reps), shipped).join(reps, "rep", "left_semi"), "near-postings")
    share, step = THRESHOLD / (1 + THRESHOLD) * (1 - SLACK), None
    while True:
        own = Steps(spark)
        rows = rows.join(named, "rep")
        room = F.max(F.col("ahead") - F.col("total") * share)
        groups = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("total").alias("least"), room.alias("room")).where("lo <> hi")
        groups = own.write(groups.select("bucket", "n", "least", "room"), "near-groups")
        most = groups.agg(F.max("n")).first()[0]
        if most is None:
            return named
        can = (F.col("ahead") >= (F.col("total") + F.col("least")) * share) & (F.col("room") >= F.col("total") * share)
        rows = own.write(rows.join(groups.drop("n"), "bucket").where(can).drop("least", "room"), "near-grouped")
        old.drop()
        step = max(0, math.ceil(math.log(most, LEADERS)) - 1) if step is None else max(0, step - 1)
        leads = F.pmod(F.xxhash64("rep"), F.lit(LEADERS**step)) == 0
        lead = own.write(rows.where(leads).select("bucket", *[F.col(c).alias(f"lead_{c}") for c in ("rep", "weight", "total", "rest", "ahead", "label")]), "near-leaders")
        # of two leaders the smaller one asks; what both have posted and the larger rest bound what they share
        met = rows.join(lead, "bucket").where((F.col("label") != F.col("lead_label")) & (~leads | (F.col("rep") > F.col("lead_rep"))))
        met = met.where(F.least("ahead", "lead_ahead") >= (F.col("total") + F.col("lead_total")) * share)
        pairs = met.select(F.greatest("rep", "lead_rep").alias("a"), F.least("rep", "lead_rep").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        checked = materialise(similar(own.write(pairs, "near-pairs"), texts, shipped), "near-checked")
        named = relabel(named, checked.where("alike"))
        if step == 0:  # all have led
            return named
        rows, old = rows.where(~leads).drop("label"), own


def components(edges: DataFrame) -> DataFrame:
    """`id` and the smallest id it is connected to. Every step takes the least label around, then that label's own."""
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-edges")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "near-labels")
    while True:
        around = both.join(labels.withColumnsRenamed({"id": "b"}), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("around"))
        stepped = labels.join(around, "id").select("id", F.least("label", "around").alias("step"), F.col("label").alias("was"))
        stepped = materialise(stepped, "near-step")
        onward = stepped.select(F.col("id").alias("via"), F.col("step").alias("onward"))
        new = materialise(stepped.join(onward, F.col("step") == F.col("via")).select("id", F.least("step", "onward").alias("label"), "was"), "near-labels")
        if new.where("label <> was").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")


def near_duplicates(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `class_id` (the smallest id of its class) and `kept` (it is that one)."""
    shipped = spark.sparkContext.broadcast(frequency_sketch(docs, text))
    rows = materialise(signed(docs, shipped, text, doc_id), "near-signed")
    reps = materialise(rows.groupBy("digest").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "near-reps")
    edges = links(spark, reps.where("rep IS NOT NULL").select("rep", "bands"), docs, shipped, text, doc_id)
    named = materialise(reps.join(edges, F.col("rep") == F.col("a"), "left").select("digest", F.coalesce("b", "rep").alias("class_id")), "near-classes")
    kind = docs.schema[doc_id].dataType
    joined = rows.select("id", "digest").join(named, "digest")
    return joined.select(F.col("id").cast(kind).alias(doc_id), F.col("class_id").cast(kind).alias("class_id"), F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stand for their class, unchanged; rows without an id stay."""
    gone = materialise(near_duplicates(spark, docs, text, doc_id).where("NOT kept").select(F.col(doc_id).alias("gone")), "near-gone")
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.{doc_id}") == F.col("g.gone"), "left_anti")
