"""Data contract of a prepared series: errors, warnings, report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_MISSING_SHARE = 0.10
MIN_HISTORY_DAYS = 180
MAX_GAP_HOURS = 24
ORDER_BLOCK = 100_000


def with_previous(df: DataFrame, key: str, order: str, value: str, name: str = "previous", size: int = ORDER_BLOCK) -> DataFrame:
    """The value of the row before in `order` (whole numbers), block by block with the last value of the
    block before handed on."""
    df = df.withColumn("_blk", F.floor(F.col(order) / size))
    last = df.groupBy(key, "_blk").agg(F.max_by(value, order).alias("_last"))
    carry = last.select(
        key, "_blk", F.lag("_last").over(Window.partitionBy(key).orderBy("_blk")).alias("_carry")
    )
    inside = F.lag(value).over(Window.partitionBy(key, "_blk").orderBy(order))
    return df.join(carry, [key, "_blk"]).withColumn(name, F.coalesce(inside, F.col("_carry"))).drop("_blk", "_carry")


def contract_facts(
    df: DataFrame, target: str = "flow", order: str = "seq", others: tuple[str, ...] = (), block: int = ORDER_BLOCK
) -> DataFrame:
    """One row of counts per site; `order` is the stored row order."""
    rows = with_previous(df, "site", order, "ts", size=block)
    gap = (F.unix_seconds("ts") - F.unix_seconds("previous")) / 3600
    long_gap = F.when(gap > MAX_GAP_HOURS, gap)
    dead = F.lit(0)
    for c in others:
        dead = dead + F.when(F.count(c) == 0, 1).otherwise(0)
    seconds = F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))
    n = F.count(F.lit(1))
    return rows.groupBy("site").agg(
        n.alias("n_rows"),
        F.count(target).alias("n_target"),
        F.sum(F.when(F.col("ts") < F.col("previous"), 1).otherwise(0)).alias("n_unsorted"),
        (n - F.count_distinct("ts")).alias("n_duplicates"),
        F.sum(F.when(F.col(target) < 0, 1).otherwise(0)).alias("n_negative"),
        (1 - F.count(target) / n).alias("missing_share"),
        (seconds / 86400).alias("span_days"),
        F.count(long_gap).alias("n_gaps"),
        F.max(long_gap).alias("max_gap_hours"),
        dead.cast("long").alias("n_dead_columns"),
    )


def contract_errors(facts: DataFrame, no_target: str = "target_all_missing") -> Column:
    """Codes in the order of the checks; `no_target` is the one for a series without a single target value."""
    c = F.col
    found = F.array(
        F.when(c("n_unsorted") > 0, "not_sorted"),
        F.when(c("n_duplicates") > 0, "duplicate_ts"),
        F.when(c("n_target") == 0, no_target),
        F.when(c("n_negative") > 0, "negative_flow"),
    )
    return F.when(c("n_rows") == 0, F.array(F.lit("empty"))).otherwise(F.array_compact(found))


def contract_warnings(facts: DataFrame) -> Column:
    c = F.col
    found = F.array(
        F.when(c("missing_share") > MAX_MISSING_SHARE, "missing_target"),
        F.when(c("span_days") < MIN_HISTORY_DAYS, "short_history"),
        F.when(c("n_gaps") > 0, "long_gaps"),
        F.when(c("n_dead_columns") > 0, "dead_columns"),
    )
    # A series without any target value is reported as an error alone.
    nothing = (c("n_rows") == 0) | (c("n_target") == 0)
    return F.when(nothing, F.array().cast("array<string>")).otherwise(F.array_compact(found))


def contract_report(
    df: DataFrame, sites: DataFrame | None = None, strict: bool = False, others: tuple[str, ...] = (), target: str = "flow"
) -> DataFrame:
    """Report row per site; `sites` adds those without a single row. `strict` turns warnings into errors."""
    if target not in df.columns:
        listed = (sites if sites is not None else df.select("site").distinct()).select("site")
        return listed.select(
            "site",
            F.array(F.lit("target_missing")).alias("errors"),
            F.array().cast("array<string>").alias("warnings"),
            F.lit(False).alias("ok"),
        )
    numeric = dict(df.dtypes)[target] in ("double", "float", "int", "bigint", "smallint")
    if not numeric:
        # The order of the rows is still checked; there is nothing to count in the target.
        df = df.withColumn(target, F.lit(None).cast("double"))
    facts = contract_facts(df, target=target, others=others)
    if sites is not None:
        facts = sites.select("site").join(facts, "site", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    errors = contract_errors(facts, "target_all_missing" if numeric else "target_not_numeric")
    warnings = contract_warnings(facts)
    if strict:
        errors, warnings = F.concat(errors, warnings), F.array().cast("array<string>")
    return facts.withColumns({"errors": errors, "warnings": warnings}).select(
        "site", "errors", "warnings", (F.size("errors") == 0).alias("ok")
    )


def require_ok(report: DataFrame) -> None:
    """Fails the job when any site breaks the contract; one number reaches the driver."""
    broken = report.where(~F.col("ok")).count()
    if broken:
        raise ValueError(f"data contract broken for {broken} site(s)")
