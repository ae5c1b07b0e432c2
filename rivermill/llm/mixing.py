"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

A source's target is its weight's share of the total, but at most `epochs` times its size; what the clamped sources leave
is shared out again by weight until none is above. Every row is taken floor(target / size) times, and the rows that come
first in a seeded order once more, as long as that brings the source nearer to its target. A null source is a source of
its own, after all others; a null text has size 0 and takes nothing; a source without words has target 0. Repeated rows
are taken alike. An empty table gives an empty result. Rows travel as one struct, so no column name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivermill.session import materialise

#: Hexadecimal digits of the seeded order that number the pieces of a source; rows are ranked in one piece per source only.
PIECE_DIGITS = 3


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds `weight` to one row per `source`: the given ones in turn, by code point, null last."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (nth % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, total: Column, epochs: int) -> DataFrame:
    """Adds `target` to one row per `source` with `source_size` and `weight`.

    In the order of cap per weight the clamped sources come first. So the level is the one left for the k-th and later
    sources, for the first k at which it stays below the k-th cap. The rows here are sources, never documents.
    """
    cap = F.col("source_size") * epochs
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    clamped = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    tried = sources.withColumn("_level", (total - clamped) / open_weight)
    fits = F.when(F.col("_level") <= cap / F.col("weight"), F.col("_level"))
    level = F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return tried.withColumn("_level", level).withColumn("target", F.least(cap.cast("double"), F.col("_level") * F.col("weight"))).drop("_level")


def mix(docs: DataFrame, text: str = "text", *, size, share: tuple[int, int] = (3, 2), epochs: int = 2, weights: tuple[float, ...] = (3, 1, 2), seed: str = "mix", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """`row` (a row of `docs` as a struct), `size`, `source_size`, `target` and `times`, how often the mix takes the row.

    `size`: from the text's column to the column of its size. `share`: the mix's total as a fraction of all sizes.
    Sizes are added up per source and piece of the seeded order; the piece that holds a source's boundary is ranked row
    by row and gives the last order value taken once more. So rows meet with one row per source. Those rows are written
    first: Spark then knows their size, sends them to the texts while they are few, and else joins by shuffle.
    """
    tag = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))  # joins on a null source too
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    piece = F.substring(order, 1, PIECE_DIGITS)
    rows = docs.select(F.struct("*").alias("row"), tag.alias("_tag"), order.alias("_order"), F.col(text).alias("_text"))
    pieces = docs.select(tag.alias("_tag"), F.col(source).alias("source"), piece.alias("_piece"), size(F.col(text)).alias("_size"))
    pieces = pieces.groupBy("_tag", "source", "_piece").agg(F.sum("_size").alias("_sum"))
    sources = pieces.groupBy("_tag", "source").agg(F.sum("_sum").alias("source_size"))
    everything = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    sources = water_fill(cyclic_weights(sources, weights).withColumn("_all", everything), F.col("_all") * share[0] / share[1], epochs)
    sources = sources.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    sources = sources.select("_tag", "source_size", "target", "_whole", (F.col("target") - F.col("_whole") * F.col("source_size")).alias("_rest"))
    before = Window.partitionBy("_tag").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    split = pieces.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).join(sources, "_tag")
    split = materialise(split.where("_before < _rest AND _before + _sum > _rest").select("_tag", "_piece", "_before", "_rest"), "mix-split")
    # sizes are taken after the join, so only of the rows in the boundary's piece
    inside = rows.select("_tag", "_order", F.substring("_order", 1, PIECE_DIGITS).alias("_piece"), "_text").join(split, ["_tag", "_piece"])
    inside = inside.withColumn("_size", size(F.col("_text"))).drop("_text")
    upto = F.sum("_size").over(Window.partitionBy("_tag", "_piece").orderBy("_order"))  # rows of one order value together
    nearer = inside.withColumn("_upto", F.col("_before") + upto).where(F.col("_upto") - F.col("_size") / 2 <= F.col("_rest"))
    last = nearer.groupBy("_tag").agg(F.max("_order").alias("_last"))
    start = split.select("_tag", F.col("_piece").alias("_from"))  # where no row of the piece is taken, all before it are
    cuts = materialise(sources.join(start, "_tag", "left").join(last, "_tag", "left"), "mix-cuts")
    more = F.when(F.col("_rest") <= 0, False).when(F.col("_from").isNull(), True)
    more = more.otherwise((F.col("_order") < F.col("_from")) | F.coalesce(F.col("_order") <= F.col("_last"), F.lit(False)))
    taken = rows.join(cuts, "_tag").withColumn("size", size(F.col("_text")))
    times = F.when(F.col("size") > 0, F.col("_whole") + more.cast("int")).otherwise(0)
    return taken.select("row", "size", "source_size", "target", times.cast("int").alias("times"))


def expand(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns it came with."""
    return mixed.where("times > 0").select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
