"""Input drift: two-sample distances per column, share of drifted columns, gauges and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.functions.ordered import running_by_value, value_buckets

P_VALUE = 0.05
NORMED_DISTANCE = 0.1
DATASET_SHARE = 0.4
KGE_FLOOR = 0.5
KS_TERMS = 100


def unpivot_columns(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.unpivot(keys, columns, "column", "value").where(F.col("value").isNotNull())


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided Kolmogorov-Smirnov p-value; 1 for a distance of 0."""
    lam = F.sqrt(n * m / (n + m)) * d

    def add(acc: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, 2.0).otherwise(-2.0)
        return acc + sign * F.exp(-2.0 * k * k * lam * lam)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0), add)
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def two_sample(long: DataFrame, keys: list[str]) -> DataFrame:
    """KS distance and Wasserstein distance between the `reference` and `current` rows of each key.

    Equal values are counted first; running counts come from value buckets, so no task sorts a whole column.
    """
    ref = F.col("part") == "reference"
    counts = long.groupBy(*keys, "value").agg(
        F.sum(ref.cast("long")).alias("a"), F.sum((~ref).cast("long")).alias("b")
    )
    ranked = running_by_value(value_buckets(counts, keys, "value", ["a", "b"]), keys, "value", ["a", "b"])
    gap = F.abs(F.try_divide("cum_a", "_all_a") - F.try_divide("cum_b", "_all_b"))
    spread = (
        long.where(ref).groupBy(*keys).agg(F.greatest(F.stddev_pop("value"), F.lit(0.001)).alias("_spread"))
    )
    area = F.sum(gap * F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0)))
    stats = ranked.groupBy(*keys).agg(
        F.max("_all_a").alias("n_reference"),
        F.max("_all_b").alias("n_current"),
        F.max(gap).alias("ks"),
        area.alias("wasserstein"),
    )
    return (
        stats.where((F.col("n_reference") > 0) & (F.col("n_current") > 0))
        .join(spread, keys)
        .withColumn("wasserstein_normed", F.col("wasserstein") / F.col("_spread"))
        .withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_reference"), F.col("n_current")))
        .drop("_spread")
    )


def column_drift(long: DataFrame, keys: list[str], statistic: str = "ks") -> DataFrame:
    """Both verdicts, `drifted_ks` and `drifted_distance`; the named `statistic` ("ks" or "wasserstein") decides `drifted`."""
    verdicts = {"ks": "drifted_ks", "wasserstein": "drifted_distance"}
    if statistic not in verdicts:
        raise ValueError(f"statistic must be one of {sorted(verdicts)}")
    stats = two_sample(long, keys).withColumns({"drifted_ks": F.col("p_value") < P_VALUE, "drifted_distance": F.col("wasserstein_normed") > NORMED_DISTANCE})
    return stats.withColumns({"statistic": F.lit(statistic), "drifted": F.col(verdicts[statistic])})


def dataset_drift(columns: DataFrame, threshold: float = DATASET_SHARE) -> DataFrame:
    share = F.avg(F.col("drifted").cast("double"))
    return columns.groupBy("site").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.sum(F.col("drifted").cast("long")).alias("n_drifted"),
        share.alias("share"),
        (share >= threshold).alias("dataset_drift"),
    )


def drift_report(df: DataFrame, columns: list[str], days: int = 30, statistic: str = "ks") -> DataFrame:
    """Per site; a site where one side is empty is listed as skipped."""
    from rivermill.operators.splits import split_reference_current

    parts = split_reference_current(df, days)
    long = unpivot_columns(parts.select("site", "part", *[F.col(c).cast("double").alias(c) for c in columns]), ["site", "part"], columns)
    report = dataset_drift(column_drift(long, ["site", "column"], statistic))
    return df.select("site").distinct().join(report, "site", "left").withColumn("skipped", F.col("n_columns").isNull())


def latest(df: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    picked = df.groupBy(key).agg(F.max_by(F.struct(*values), order).alias("_v"))
    return picked.select(key, *[F.col(f"_v.{v}").alias(v) for v in values])


def gauges(metrics: DataFrame, drift: DataFrame) -> DataFrame:
    """Latest KGE and drift per site. `metrics(site, version, kge)`, `drift(site, run_date, share, dataset_drift)`."""
    scores = latest(metrics, "site", "version", ["kge"])
    state = latest(drift, "site", "run_date", ["share", "dataset_drift"])
    return scores.join(state, "site", "full_outer")


def alerts(gauge: DataFrame) -> DataFrame:
    rules = F.array_compact(
        F.array(
            F.when(F.col("kge") < KGE_FLOOR, "model_quality_low"),
            F.when(F.col("dataset_drift"), "input_drift"),
        )
    )
    return gauge.select("site", F.explode(rules).alias("alert"))
