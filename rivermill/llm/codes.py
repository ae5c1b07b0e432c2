"""Vector code compression: one codebook per part position, fitted by Lloyd rounds over two trees.

Vectors are scaled, rounded down to integers and cut into `PARTS` equal consecutive parts. Blocks of vectors are written
once, each with a tree per part position that holds the box, the sum and the number of the parts below every node. A
round walks such a tree and a tree over the codebook's entries together: bounds on the distance between two boxes drop
combinations of nodes, a node that keeps a single entry is assigned whole by its stored sum, and parts of the leaves that
keep several are compared in integers. Every comparison is one of whole numbers, so results do not depend on the trees,
the blocks or the partitions. Only sums per entry, whose number the codebooks bound, come to the driver.

Rows whose vector is null or holds null or non-finite components are left out. The vector of the smallest id sets the
length; a row with another length is returned without code and error. A length that `PARTS` does not divide is filled up
with zeros. Null ids come last in the order of ids; rows that share an id are ordered by their vectors. With fewer than
`ENTRIES` vectors there are fewer entries. `error` and `label_error` are null where they do not fit a long. Further
columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.session import materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block, and parts of a leaf of its trees.
BLOCK, LEAF = 1024, 16
#: Below this, sums of squares of a part and sums of a block fit 64 bits; beyond it numbers are Python's.
SMALL = 1 << 26
#: Sums travel as two decimals, above and below this.
LIMB = 10**30


def whole(values: np.ndarray) -> np.ndarray:
    """Whole-valued floats as integers: 64 bits where that is enough for all that follows."""
    if not values.size or np.abs(values).max() < SMALL:
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def grow(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """The order of the points in the tree, the points in that order, and (bounds, low, high, sum) of the nodes by level.

    Node k of a level is split in the middle, along its widest side, into nodes 2k and 2k + 1 of the next one.
    """
    n, order, levels = len(points), np.arange(len(points)), []
    depth = max(0, (n // leaf).bit_length() - 1) if points.shape[1] else 0
    rough = points.astype(np.float64)
    for level in range(depth + 1):
        bounds = np.arange((1 << level) + 1) * n >> level
        if level:
            node = np.repeat(np.arange(len(before) - 1), np.diff(before))
            at = rough[order]
            side = (np.maximum.reduceat(at, before[:-1]) - np.minimum.reduceat(at, before[:-1])).argmax(axis=1)
            order = order[np.lexsort((at[np.arange(n), side[node]], node))]
        before = bounds
        levels.append(bounds)
    placed = points[order]
    return order, placed, [(b, np.minimum.reduceat(placed, b[:-1]), np.maximum.reduceat(placed, b[:-1]), np.add.reduceat(placed, b[:-1])) for b in levels]


def entry_tree(entries: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Entry per leaf, and the levels. Filled up to a power of two by repeats of the last entry, which lose every tie."""
    full = 1 << (len(entries) - 1).bit_length()
    order, _, levels = grow(entries[np.minimum(np.arange(full), len(entries) - 1)], 1)
    return np.minimum(order, len(entries) - 1), levels


def assign(tree: tuple, entries: np.ndarray, known: tuple[np.ndarray, list[tuple]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's parts: the nearest entry of each, in the block's order; per entry the number and the sum of its parts."""
    order, points, levels = tree
    if points.dtype == object or np.abs(entries).max(initial=0) >= SMALL:
        points, entries = points.astype(object), entries.astype(object)
        levels, known = [(b, *(x.astype(object) for x in rest)) for b, *rest in levels], None
    at_leaf, marks = known or entry_tree(entries)
    nearest = np.full(len(points), -1)
    counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, points.dtype)
    p, e, deep, fine = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while len(p):
        bounds, low, high, total = levels[deep]
        _, from_, to, _ = marks[fine]
        apart = np.maximum(np.maximum(low[p] - to[e], from_[e] - high[p]), 0)
        reach = np.maximum(high[p] - from_[e], to[e] - low[p])
        least, most = (apart * apart).sum(axis=1), (reach * reach).sum(axis=1)
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(p))))
        keep = least <= np.minimum.reduceat(most, first)[of]
        if fine == len(marks) - 1:
            # the entry of the smallest reach against each other one, over the whole box
            own = at_leaf[e]
            best = np.minimum.reduceat(most, first)
            lead = np.minimum.reduceat(np.where(most == best[of], own, len(entries)), first)[of]
            step = entries[own] - entries[lead]
            farther = (entries[own] ** 2 - entries[lead] ** 2).sum(axis=1) - 2 * np.maximum(low[p] * step, high[p] * step).sum(axis=1)
            keep &= ~((own != lead) & ((farther > 0) | ((farther == 0) & (lead < own)))).astype(bool)
            p, e = p[keep], e[keep]
            pairs = np.unique(p * len(entries) + at_leaf[e])  # a filled-up leaf repeats an entry
            p, own = pairs // len(entries), pairs % len(entries)
            first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            sizes = np.diff(np.append(first, len(p)))
            alone = first[sizes == 1]
            for node, entry in zip(p[alone], own[alone]):
                nearest[bounds[node] : bounds[node + 1]] = entry
                counts[entry] += bounds[node + 1] - bounds[node]
                sums[entry] = sums[entry] + total[node]
            several = np.repeat(sizes > 1, sizes)
            p, own = p[several], own[several]
            if deep == len(levels) - 1:
                _compare(points, entries, bounds, p, own, nearest, counts, sums)
                break
            back = np.full(len(entries), -1)
            back[at_leaf[::-1]] = np.arange(len(at_leaf))[::-1]
            e = back[own]
        else:
            p, e = p[keep], e[keep]
        halves = 2 if deep < len(levels) - 1 else 1
        marked = 2 if fine < len(marks) - 1 else 1
        p = (p[:, None] * halves + np.arange(halves)[None, :]).repeat(marked, axis=1).ravel()
        e = np.tile(e[:, None] * marked + np.arange(marked)[None, :], (1, halves)).ravel()
        sorted_ = np.argsort(p, kind="stable")
        p, e, deep, fine = p[sorted_], e[sorted_], deep + halves - 1, fine + marked - 1
    back = np.empty_like(nearest)
    back[order] = nearest
    return back, counts, sums


def _compare(points, entries, bounds, nodes, candidates, nearest, counts, sums) -> None:
    """Uncertain leaves: exact distances to their candidates, in ascending order of entries, so ties stay with the lower one."""
    best = np.full(len(points), None, object) if points.dtype == object else np.full(len(points), np.iinfo(np.int64).max)
    touched = np.zeros(len(points), bool)
    for entry in np.unique(candidates):
        own = nodes[candidates == entry]
        rows = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in own])
        away = ((points[rows] - entries[entry]) ** 2).sum(axis=1)
        if points.dtype == object:
            closer = np.array([b is None or a < b for a, b in zip(away, best[rows])], bool)
        else:
            closer = away < best[rows]
        best[rows[closer]], nearest[rows[closer]] = away[closer], entry
        touched[rows] = True
    for entry in np.unique(nearest[touched]):
        own = points[touched & (nearest == entry)]
        counts[entry] += len(own)
        sums[entry] = sums[entry] + own.sum(axis=0)


def usable(vector: Column) -> Column:
    """Not null, every component a finite number that stays one when scaled."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, sound), F.lit(False))


def integers(column: pa.Array, length: int) -> np.ndarray:
    """Scaled and rounded down, as whole-valued floats, filled up to a multiple of PARTS."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat.reshape(len(column), length) * SCALE)
    return np.pad(scaled, ((0, 0), (0, -length % PARTS)))


def parts_of(scaled: np.ndarray) -> list[np.ndarray]:
    return [whole(part) for part in np.split(scaled, PARTS, axis=1)]


def blocks(rows: DataFrame, length: int) -> DataFrame:
    """`ids`, `labels`, and `trees`: written once, read by every round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                trees = [grow(points, LEAF) for points in parts_of(integers(part.column(2), length))]
                yield pa.RecordBatch.from_arrays([_one(part.column(0)), _one(part.column(1)), pa.array([pickle.dumps(trees)], pa.binary())], ["ids", "labels", "trees"])

    kinds = rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    return materialise(rows.mapInArrow(run, f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, trees binary"), "code-blocks")


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def refit(stored: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry replaced by the mean, rounded down, of the parts that it is nearest to; an unused entry stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        known = [entry_tree(b) if len(b) else None for b in books]
        for batch in batches:
            for packed in batch.column(0):
                for k, tree in enumerate(pickle.loads(packed.as_py())):
                    _, n, total = assign(tree, books[k], known[k])
                    counts[k] += n
                    sums[k] = sums[k] + total.astype(object)
        rows = [(k, e, i, int(counts[k][e]), *divmod(int(v), LIMB)) for k in range(PARTS) for e in np.flatnonzero(counts[k]) for i, v in enumerate(sums[k][e])]
        if rows:
            k, e, i, n, high, low = zip(*rows)
            wide = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()), pa.array(n, pa.int64()), pa.array(map(Decimal, high), wide), pa.array(map(Decimal, low), wide)],
                ["part", "entry", "place", "n", "high", "low"],
            )

    partial = stored.select("trees").mapInArrow(run, "part int, entry int, place int, n long, high decimal(38,0), low decimal(38,0)")
    new = [b.astype(object) for b in books]
    for r in partial.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        new[r.part][r.entry, r.place] = (int(r.high) * LIMB + int(r.low)) // r.n
    return [_fit(b) for b in new]


def _fit(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64) if not values.size or max(abs(int(v)) for v in values.ravel()) < SMALL else values


def encode(stored: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """`id`, `label`, `code` and `error` of every vector of the blocks."""
    hexes = np.array([f"{k:02x}" for k in range(256)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [entry_tree(b) if len(b) else None for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(c)[row].values for c in (0, 1))
                codes, errors = [], np.zeros(len(ids), object)
                for k, tree in enumerate(pickle.loads(batch.column(2)[row].as_py())):
                    nearest, _, _ = assign(tree, books[k], known[k])
                    order, points, _ = tree
                    gap = points - books[k][nearest[order]]
                    errors[order] += (gap * gap).sum(axis=1).astype(object)
                    codes.append(hexes[nearest])
                error = pa.array([int(x) if x < 1 << 63 else None for x in errors], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(["".join(c) for c in zip(*codes)], pa.string()), error], ["id", "label", "code", "error"])

    kinds = [stored.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")]
    return stored.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, code string, error long")


def compress(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """The rows with `code`, `error` and `label_error`, and the codebooks: one array (entries, length) per part position."""
    rows = table.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(usable(F.col("vector")))
    least = [F.col("id").asc_nulls_last(), F.col("vector").asc()]
    first = rows.orderBy(*least).limit(1).collect()
    length = len(first[0].vector) if first else 0
    fits = rows.where(F.size("vector") == length)
    start = [list(r.vector) for r in fits.orderBy(*least).limit(ENTRIES).collect()]
    books = parts_of(integers(pa.array(start, pa.list_(pa.float64())), length))
    stored = blocks(fits, length)
    for _ in range(ROUNDS if start else 0):
        books = refit(stored, books)
    coded = encode(stored, books)
    others = rows.where(F.size("vector") != length).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = materialise(coded.unionByName(others), "codes")
    # written, so that Spark can split the rows of a frequent label at the join
    per_label = coded.groupBy("label").agg(F.when(F.count("*") == F.count(F.coalesce("error", F.when(F.col("code").isNull(), 0))), F.expr("try_cast(coalesce(sum(cast(error as decimal(38,0))), 0) as bigint)")).alias("label_error"))
    per_label = materialise(per_label.withColumnRenamed("label", "of"), "code-errors")
    out = coded.join(per_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias(vec_id), "code", "error", F.col("label").alias(label), "label_error"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal digits, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()
