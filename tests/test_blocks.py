import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis, densify, diff, rolling, row_positions, running_totals
from rivermill.functions.ewm import ewm_means
from rivermill.functions.ordered import SALTS, exact_quantiles, place

SMALL = Axis(("site",), 3600, block=37)
WHOLE = Axis(("site",), 3600)


def gappy(n, seed=0, share=0.2):
    rng = np.random.default_rng(seed)
    values = rng.gamma(2.0, 10.0, n)
    return [None if rng.random() < share else float(v) for v in values]


def test_blocked_windows_equal_one_long_window(series, ordered):
    df = series(gappy(300))

    def run(axis):
        w = axis.window()
        split = axis.split(df, back=48, ahead=5)
        out = axis.core(split.withColumns({
            "mean": rolling(F.avg, F.col("flow"), w, 48, 7), "top": rolling(F.max, F.col("flow"), w, 24, 1),
            "step": diff(F.col("flow"), w, 3), "ahead": F.lead("flow", 5).over(w)}))
        return ordered(out, "mean", "top", "step", "ahead")

    a, b = run(SMALL), run(WHOLE)
    assert len(a) == 300
    for x, y in zip(a, b):
        assert x == pytest.approx(y)


def test_rolling_counts_present_values(series, ordered):
    values = gappy(120, 3)
    ax = SMALL
    out = ax.core(ax.split(series(values), back=10).withColumn("m", rolling(F.avg, F.col("flow"), ax.window(), 10, 6)))
    want = pd.Series(values, dtype=float).rolling(10, min_periods=6).mean()
    got = pd.Series(ordered(out, "m"), dtype=float)
    pd.testing.assert_series_equal(got, want, check_names=False)


@pytest.mark.parametrize("span", [1, 12, 72, 360])
def test_ewm_follows_the_recursive_definition(series, ordered, span):
    values = gappy(900, span, 0.3)
    values[:5] = [None] * 5
    values[300:520] = [None] * 220
    want = pd.Series(values, dtype=float).ewm(span=span, min_periods=24).mean()
    for block, back in ((211, 0), (37, 20), (None, 0)):
        ax = Axis(("site",), 3600, block=block)
        out = ax.core(ewm_means(ax.split(series(values), back=back), ax, "flow", {"m": (span, 24)}))
        got = pd.Series(ordered(out, "m"), dtype=float)
        pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-9)


def test_ewm_carries_a_value_over_a_gap_of_years_whatever_the_block(series, ordered):
    """Blocks without any value, weights far below the smallest double, dates before the epoch."""
    values = gappy(60, 1) + [None] * 3000 + [7.5] + [None] * 40 + gappy(60, 2)
    spans = {"flash": (2, 1), "short": (12, 1), "base": (30, 40)}
    want = pd.DataFrame({n: pd.Series(values, dtype=float).ewm(span=s, min_periods=k).mean() for n, (s, k) in spans.items()})
    df = series(values, start="1966-01-01", freq="D")
    for block in (50, 700, None):
        ax = Axis(("site",), 86_400, block=block)
        rows = ordered(ax.core(ewm_means(ax.split(df), ax, "flow", spans)), *spans)
        got = pd.DataFrame(rows, columns=list(spans), dtype=float)
        pd.testing.assert_frame_equal(got, want, rtol=1e-9)
    assert got["short"].iloc[3000] == got["short"].iloc[59]


def test_ewm_of_no_rows_and_of_no_values(series, ordered):
    df = series([None, None, None])
    for rows, size in ((df, 3), (df.where("false"), 0)):
        out = SMALL.core(ewm_means(SMALL.split(rows), SMALL, "flow", {"m": (12, 1)}))
        assert ordered(out, "m") == [None] * size


def test_densify_fills_missing_hours(spark):
    df = spark.createDataFrame([("a", "2026-01-01 00:00:00", 1.0), ("a", "2026-01-01 05:00:00", 2.0), ("b", "2026-02-01 00:00:00", 3.0)],
                               "site STRING, ts STRING, flow DOUBLE").withColumn("ts", F.to_timestamp("ts"))
    for block in (None, 2):
        rows = densify(df, Axis(("site",), 3600, block=block)).orderBy("site", "ts").collect()
        assert [r.flow for r in rows] == [1.0, None, None, None, None, 2.0, 3.0]


def test_running_totals_cross_blocks(series, ordered):
    values = [1.0, None, 2.5] * 50
    out = running_totals(series(values), SMALL, {"total": F.col("flow"), "n": F.when(F.col("flow").isNotNull(), 1)})
    want = pd.Series(values, dtype=float).fillna(0).cumsum().tolist()
    assert [r[0] for r in ordered(out, "total", "n")] == pytest.approx(want)
    assert ordered(out, "n")[-1] == 100
    assert ordered(row_positions(series(values), SMALL), "rn") == list(range(1, 151))


def test_quantiles_are_exact_with_ties_and_a_hot_group(spark):
    rng = np.random.default_rng(1)
    groups = {"hot": np.round(rng.gamma(2, 5, 5000), 1), "one": np.array([4.0]), "same": np.full(50, 7.0), "few": rng.normal(size=11)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "site STRING, v DOUBLE")
    probs = {"p0": 0.0, "p15": 0.15, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}
    for buckets, per_bucket in ((4, 1), (256, 1), (256, 16), (4096, 256)):
        got = {r.site: r for r in exact_quantiles(df, ["site"], "v", probs, buckets, per_bucket).collect()}
        for k, vs in groups.items():
            assert [got[k][n] for n in probs] == pytest.approx(np.percentile(vs, [p * 100 for p in probs.values()]).tolist())


def test_values_of_a_hot_group_stay_spread(spark):
    """Without broadcast, the values of the only group meet its cut points in many tasks, and buckets stay in order."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        counts = spark.range(20_000).select(F.lit("hot").alias("site"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n"))
        placed = place(counts, ["site"], "v", 256, 100).withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in placed.groupBy("task").count().collect()]
        sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_bucket").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert SALTS >= 8 and sum(tasks) == 20_000 and max(tasks) < 20_000 / 3
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:])) and max(r.n for r in sizes) < 1000
