"""Time blocks: windows and running totals that never need a whole series in one task.

A regular axis gives every row an absolute position (hours or days since the epoch), so the block of a
row follows from its timestamp alone. `split` copies the rows a block needs from its neighbours (the
halo); a task then holds one block and its halo however long the series of one site is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

DEFAULT_BLOCK = 16_384


@dataclass(frozen=True)
class Axis:
    """Keys of one series, seconds per row, and optionally a fixed number of rows per block."""

    keys: tuple[str, ...] = ("site",)
    step: int = 3600
    block: int | None = None
    ts: str = "ts"

    @property
    def steps_per_day(self) -> int:
        return 86_400 // self.step

    def position(self, ts: str | None = None) -> Column:
        return F.floor(F.unix_seconds(F.col(ts or self.ts)) / F.lit(self.step))

    def rows_per_block(self, halo: int = 0) -> int:
        return self.block or max(DEFAULT_BLOCK, 4 * halo)

    def split(self, df: DataFrame, back: int = 0, ahead: int = 0) -> DataFrame:
        """Adds `_pos`, `_blk`, `_core`; rows within `back` (`ahead`) of a block are copied into it."""
        size = self.rows_per_block(back + ahead)
        own = F.floor(F.col("_pos") / size)
        df = df.withColumn("_pos", self.position())
        if back == 0 and ahead == 0:
            return df.withColumns({"_blk": own, "_core": F.lit(True)})
        blocks = F.sequence(
            F.floor((F.col("_pos") - ahead) / size), F.floor((F.col("_pos") + back) / size)
        )
        return df.withColumn("_blk", F.explode(blocks)).withColumn("_core", F.col("_blk") == own)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "_blk").orderBy("_pos")

    def running(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, 0)

    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, "_blk")

    def core(self, df: DataFrame, keep_block: bool = False) -> DataFrame:
        """Keeps each row once and drops the helper columns."""
        extra = [c for c in df.columns if c.startswith("_") and not (keep_block and c in ("_blk", "_pos"))]
        return df.where("_core").drop(*extra)


def rolling(fn, x: Column, w: WindowSpec, n: int, min_periods: int | None = None) -> Column:
    """`fn` over the last `n` rows, NULL until `min_periods` (default `n`) values are present."""
    frame = w.rowsBetween(-(n - 1), 0)
    need = n if min_periods is None else min_periods
    return F.when(F.count(x).over(frame) >= need, fn(x).over(frame))


def diff(x: Column, w: WindowSpec, n: int) -> Column:
    return x - F.lag(x, n).over(w)


def block_prefix(df: DataFrame, axis: Axis, sums: dict[str, Column], block: str = "_blk") -> DataFrame:
    """Per block, the totals of all earlier blocks of the same series (one row per block)."""
    totals = df.groupBy(*axis.keys, block).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*axis.keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *axis.keys, block, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(n) for n in sums]
    )


def running_totals(
    df: DataFrame, axis: Axis, sums: dict[str, Column], order: str | None = None, size: int | None = None
) -> DataFrame:
    """Running totals over a whole series: earlier blocks from a summary, the own block from a window.

    `order` may be any ascending whole number per series (for example an ingest id); default is time.
    """
    rows = size or axis.rows_per_block()
    pos = F.col(order).cast("long") if order else axis.position()
    df = df.withColumn("_pos", pos).withColumn("_blk", F.floor(F.col("_pos") / rows))
    carry = block_prefix(df, axis, {f"_b_{n}": c for n, c in sums.items()})
    inside = axis.running()
    return df.join(carry, [*axis.keys, "_blk"]).select(
        *[c for c in df.columns if not c.startswith("_")],
        *[
            (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_b_{n}")).alias(n)
            for n, c in sums.items()
        ],
    )


def row_positions(df: DataFrame, axis: Axis, name: str = "rn") -> DataFrame:
    """1-based row number per series in time order, without putting a series into one task."""
    return running_totals(df, axis, {name: F.lit(1)}).withColumn(name, F.col(name).cast("long"))


def densify(df: DataFrame, axis: Axis) -> DataFrame:
    """One row per step from the first to the last timestamp of each series; missing values are NULL."""
    size = axis.rows_per_block()
    bounds = df.groupBy(*axis.keys).agg(
        F.min(axis.position()).alias("_lo"), F.max(axis.position()).alias("_hi")
    )
    blocks = bounds.withColumn(
        "_b", F.explode(F.sequence(F.floor(F.col("_lo") / size), F.floor(F.col("_hi") / size)))
    )
    first = F.greatest(F.col("_lo"), F.col("_b") * size)
    last = F.least(F.col("_hi"), F.col("_b") * size + (size - 1))
    axis_rows = blocks.select(*axis.keys, F.explode(F.sequence(first, last)).alias("_p")).select(
        *axis.keys, F.timestamp_seconds(F.col("_p") * axis.step).alias(axis.ts)
    )
    return axis_rows.join(df, [*axis.keys, axis.ts], "left")
