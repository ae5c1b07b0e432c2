"""Exponentially weighted mean of a series of any length (weights restart from the first value, missing rows keep decaying).

What a stretch of rows adds to an EWM is a small state: the mean and the weight at its last value, the position of
that value and the number of values. Two neighbouring states combine into one, in any grouping, so the state before a
block follows from one row per stretch, and no block needs rows of another one however long a gap lasts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis

# exp(-36.8) is about 1e-16: older rows no longer change a double.
FADE = 36.8


def decay(span: float) -> float:
    return max(0.0, 1 - 2 / (span + 1))


def fade_rows(span: float) -> int:
    """Rows after which a weight of the given span is below double precision."""
    q = decay(span)
    return 1 if q == 0 else math.ceil(FADE / -math.log(q))


def _combine(q: float):
    """State of an earlier stretch followed by a later one, brought to the last value of the later one."""

    def join(a: Column, b: Column) -> Column:
        kept = F.when(a["weight"] > 0, a["weight"] * F.pow(F.lit(q), (b["last"] - a["last"]).cast("double"))).otherwise(0.0)
        weight = kept + b["weight"]
        mean = (kept * a["mean"] + b["weight"] * b["mean"]) / weight
        return F.struct(mean.alias("mean"), weight.alias("weight"), b["last"].alias("last"))

    return join


def ewm_carry(df: DataFrame, axis: Axis, value: str, spans: list[float]) -> DataFrame:
    """Per block of `df` (split by `axis`), the state of all earlier blocks: `_n` values and `_ewm_<i>` per span.

    Rows are summed up per stretch (map-side); the scan runs over one row per stretch. A stretch is no longer than any
    weight lasts, so its sums stay finite, and a value fades within a known number of stretches that hold values: the
    scan combines that many, whatever gaps lie between.
    """
    keys = list(axis.keys)
    size = min(fade_rows(s) for s in spans)
    longest = max(fade_rows(s) for s in spans)
    # A range of `longest` rows meets that many stretches, and each block edge in it cuts one of them in two.
    reach = math.ceil(longest / size) + 2 + math.ceil(longest / axis.rows_per_block())
    pos, x = F.col("_pos"), F.col(value)
    rows = df.where("_core").select(*keys, "_blk", pos, F.floor(pos / size).alias("_part"), x)
    end = (F.col("_part") + 1) * size - 1
    sums = []
    for i, span in enumerate(spans):
        q = decay(span)
        if q == 0:
            sums += [F.max_by(x, F.when(x.isNotNull(), pos)).alias(f"_s{i}"), F.lit(1.0).alias(f"_w{i}")]
        else:
            weight = F.pow(F.lit(q), (end - pos).cast("double"))
            sums += [F.sum(x * weight).alias(f"_s{i}"), F.sum(F.when(x.isNotNull(), weight)).alias(f"_w{i}")]
    last = F.max(F.when(x.isNotNull(), pos))
    parts = rows.groupBy(*keys, "_blk", "_part").agg(last.alias("_last"), F.count(x).alias("_n"), *sums)
    parts = parts.withColumn("_held", F.col("_n") > 0)

    order = Window.partitionBy(*keys, "_held").orderBy("_blk", "_part")
    frame = order.rowsBetween(-(reach - 1), 0)
    none = F.struct(F.lit(0.0).alias("mean"), F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("last"))
    states = {}
    for i, span in enumerate(spans):
        q = decay(span)
        at_last = F.lit(1.0) if q == 0 else F.col(f"_w{i}") * F.pow(F.lit(q), (F.col("_last") - end).cast("double"))
        own = F.struct(
            (F.col(f"_s{i}") / F.col(f"_w{i}")).alias("mean"), at_last.alias("weight"), F.col("_last").alias("last")
        )
        states[f"_ewm_{i}"] = F.when(F.col("_held"), F.aggregate(F.collect_list(own).over(frame), none, _combine(q)))
    parts = parts.withColumns(states)

    newest = F.when(F.col("_held"), F.col("_part"))
    blocks = parts.groupBy(*keys, "_blk").agg(
        F.sum("_n").alias("_n"), *[F.max_by(name, newest).alias(name) for name in states]
    )
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        *keys,
        "_blk",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[F.last(name, ignorenulls=True).over(before).alias(name) for name in states],
    )


def _at_row(x: Column, span: float, axis: Axis, carry: Column, carried_n: Column, min_periods: int) -> Column:
    """The mean at each row of a block: stretches of `fade_rows` inside the block, `carry` for all before it."""
    q = decay(span)
    upto = axis.running()
    if q == 0:
        mean = x
    else:
        size = fade_rows(span)
        pos = F.col("_pos")
        part = F.floor(pos / size)
        p = (pos - part * size).cast("double")
        inside = (
            Window.partitionBy(*axis.keys, "_blk", part).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        )
        before = Window.partitionBy(*axis.keys, "_blk").orderBy(part).rangeBetween(-1, -1)
        grow, shrink = F.pow(F.lit(q), -p), F.pow(F.lit(q), F.lit(size - 1.0) - p)
        older = carry["weight"] * F.pow(F.lit(q), (pos - carry["last"]).cast("double"))

        def weighted(v: Column, earlier: Column) -> Column:
            own = F.pow(F.lit(q), p) * F.sum(v * grow).over(inside)
            near = F.pow(F.lit(q), p + 1) * F.coalesce(F.sum(v * shrink).over(before), F.lit(0.0))
            return own + near + F.coalesce(earlier, F.lit(0.0))

        one = F.when(x.isNotNull(), F.lit(1.0))
        mean = weighted(x, older * carry["mean"]) / weighted(one, older)
    held = F.coalesce(F.last(F.when(x.isNotNull(), mean), ignorenulls=True).over(upto), carry["mean"])
    return F.when(carried_n + F.count(x).over(upto) >= max(1, min_periods), held)


def ewm_means(
    df: DataFrame,
    axis: Axis,
    value: str,
    means: dict[str, tuple[float, int]],
    source: DataFrame | None = None,
) -> DataFrame:
    """Adds one EWM mean of `value` per entry of `means` (name: span, least number of values) to rows split by `axis`.

    A mean stands on the rows a block owns (`_core`); it uses no copied row. A value is carried over missing ones
    without an end. `source`, if given, is the same split with `value` made by a cheaper plan: the states are summed up
    from it.
    """
    spans = sorted({span for span, _ in means.values()})
    carry = ewm_carry(df if source is None else source, axis, value, spans)
    joined = df.join(carry, [*axis.keys, "_blk"], "left").withColumn(
        "_own", F.when(F.col("_core"), F.col(value).cast("double"))
    )
    made = {
        name: _at_row(F.col("_own"), span, axis, F.col(f"_ewm_{spans.index(span)}"), F.coalesce("_n", F.lit(0)), least)
        for name, (span, least) in means.items()
    }
    return joined.withColumns(made).drop("_own", "_n", *[f"_ewm_{i}" for i in range(len(spans))])
