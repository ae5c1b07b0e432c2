"""Positional splits, folds and row rules on series in time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis, row_positions


def numbered(df: DataFrame, axis: Axis) -> DataFrame:
    """Adds `rn` (1-based) and `n` (rows of the series)."""
    sizes = df.groupBy(*axis.keys).agg(F.count(F.lit(1)).alias("n"))
    return row_positions(df, axis).join(sizes, list(axis.keys))


def split_train_test(df: DataFrame, axis: Axis, test_ratio: float = 0.2) -> DataFrame:
    cut = F.floor(F.col("n") * (1 - test_ratio))
    return numbered(df, axis).withColumn("role", F.when(F.col("rn") <= cut, "train").otherwise("test"))


def split_fit_val_test(df: DataFrame, axis: Axis, fit: float = 0.8, val: float = 0.1) -> DataFrame:
    n_fit, n_val = F.floor(F.col("n") * fit), F.floor(F.col("n") * val)
    role = F.when(F.col("rn") <= n_fit, "fit").when(F.col("rn") <= n_fit + n_val, "val").otherwise("test")
    return numbered(df, axis).withColumn("role", role)


def fold_roles(k: int, gap: int) -> Column:
    """For each row (`rn`, `n`), the folds it takes part in and its role there."""
    test_size = F.floor(F.col("n") / (k + 1))
    pos = F.col("rn") - 1

    def one(fold: Column) -> Column:
        start = F.col("n") - (F.lit(k) - fold) * test_size
        role = F.when((pos >= start) & (pos < start + test_size), "val").when(pos < start - gap, "train")
        return F.struct(fold.alias("fold"), role.alias("role"))

    folds = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), one)
    return F.filter(folds, lambda f: f["role"].isNotNull())


def time_series_folds(df: DataFrame, axis: Axis, k: int, gap: int) -> DataFrame:
    """Expanding-window folds: training ends `gap` rows before the validation part."""
    rows = numbered(df, axis).withColumn("_f", F.explode(fold_roles(k, gap)))
    return rows.select(*[c for c in rows.columns if c not in ("_f", "n")], "_f.fold", "_f.role")


def split_reference_current(df: DataFrame, days: int = 30, key: str = "site") -> DataFrame:
    newest = df.groupBy(key).agg(F.max("ts").alias("_newest"))
    current = F.col("ts") >= F.col("_newest") - F.make_interval(days=F.lit(days))
    return df.join(newest, key).withColumn("part", F.when(current, "current").otherwise("reference")).drop("_newest")


def drop_incomplete(df: DataFrame, features: list[str]) -> DataFrame:
    return df.na.drop("any", subset=features)


def keep_tail(df: DataFrame, features: list[str], keep: int, axis: Axis) -> DataFrame:
    """Complete rows, and in any case the last `keep` rows of each series."""
    rn = F.row_number().over(Window.partitionBy(*axis.keys).orderBy(F.desc(axis.ts)))
    tail = df.select(*axis.keys, axis.ts).withColumn("_rn", rn).where(F.col("_rn") <= keep)
    edge = tail.groupBy(*axis.keys).agg(F.min(axis.ts).alias("_edge"))
    complete = F.lit(True)
    for f in features:
        complete = complete & F.col(f).isNotNull()
    return df.join(edge, list(axis.keys)).where(complete | (F.col(axis.ts) >= F.col("_edge"))).drop("_edge")


def from_now(df: DataFrame, now, key: str = "site") -> DataFrame:
    """Rows at or after `now`, leads counted from 0. A forecast holds only some dozens of such rows per site."""
    at = df.where(F.col("ts") >= F.lit(now).cast("timestamp"))
    lead = F.row_number().over(Window.partitionBy(key).orderBy("ts")) - 1
    return at.withColumn("lead_hours", lead)
