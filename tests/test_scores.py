import numpy as np
import pytest
from pyspark.sql import functions as F

from rivermill.operators import drift as dr
from rivermill.operators import evaluate as ev

Y, P = "y", "p"


def pairs(spark, y, p):
    rows = [(None if a is None else float(a), None if b is None else float(b)) for a, b in zip(y, p)]
    return spark.createDataFrame(rows, "y DOUBLE, p DOUBLE")


def one(df, column):
    return df.agg(column.alias("v")).first().v


def test_loss_known_values(spark):
    assert one(pairs(spark, [1, 2, 3, 4, 5], [1.1, 2.1, 2.9, 4.2, 4.8]), ev.kge_loss(F.col(Y), F.col(P))) == pytest.approx(0.046351372458186435)
    assert one(pairs(spark, [5] * 5, [5, 5, 5, 5, 6]), ev.kge_loss(F.col(Y), F.col(P))) == pytest.approx(1.0399997920000417)
    assert one(pairs(spark, [1.0], [2.0]), ev.kge_loss(F.col(Y), F.col(P))) == 2.0


def test_missing_pairs_do_not_poison_the_score(spark):
    full = one(pairs(spark, [1, 2, 3, 4, 5], [1.1, 2.1, 2.9, 4.2, 4.8]), ev.kge_loss(F.col(Y), F.col(P)))
    holes = one(pairs(spark, [1, 2, 3, None, 4, 5, 9], [1.1, 2.1, 2.9, 7, 4.2, 4.8, None]), ev.kge_loss(F.col(Y), F.col(P)))
    assert holes == pytest.approx(full)


def test_flat_series_has_no_correlation_and_no_error(spark):
    flat = pairs(spark, [3, 3, 3], [3, 3, 3])
    assert one(flat, ev.kge(F.col(Y), F.col(P))) is None
    assert one(pairs(spark, [0.5, 0.5], [0.4, 0.6]), ev.kge_m3s(F.col(Y), F.col(P))) is None


@pytest.mark.parametrize("seed,scale,pct", [(0, None, 50), (1, 2.5, 25), (2, 4.0, 15)])
def test_start_of_the_weighting_zone_follows_the_extreme_ratio(spark, seed, scale, pct):
    y = np.random.default_rng(seed).uniform(1.0, 1.1, 400)
    if scale:
        y[0] = scale
    df = spark.createDataFrame([("a", float(v)) for v in y], "site STRING, flow DOUBLE")
    row = ev.flow_quantiles(df).first()
    assert row.start_pct == pct
    assert (row.q_start, row.q90, row.q99) == pytest.approx(tuple(np.percentile(y, [pct, 90, 99])))


def test_weights_grow_with_the_zone(spark):
    y = np.random.default_rng(3).gamma(2, 5, 500)
    df = spark.createDataFrame([("a", float(v)) for v in y], "site STRING, flow DOUBLE")
    rows = sorted((r.flow, r.weight) for r in ev.flow_weights(df).collect())
    q50, q90, q99 = np.percentile(y, [50, 90, 99])
    low = [w for v, w in rows if v <= np.percentile(y, 15)]
    assert set(low) == {1.4}
    assert max(w for v, w in rows if v <= q90) < 1 + 4 + 1e-9
    assert max(w for _, w in rows) <= 1 + 4 * 3 * 6


def long_rows(spark, y, p):
    rows = [("a", i, "m", 1, float(v), float(w)) for i, (v, w) in enumerate(zip(y, p))]
    df = spark.createDataFrame(rows, "site STRING, i INT, model STRING, lead INT, y DOUBLE, p DOUBLE")
    return df.withColumn("ts", F.timestamp_seconds(F.col("i") * 86_400))


def test_regimes_split_at_the_thresholds(spark):
    y = np.repeat([1.0, 5.0, 10.0], 40) + np.linspace(0, 0.5, 120)
    rows = long_rows(spark, y, y + 0.1).withColumn("model", F.lit("persistence"))
    got = {r.regime: r.n for r in ev.score_by_regime(rows, 1).collect()}
    q33, q90 = np.percentile(y, [33, 90])
    assert got == {"low": int((y <= q33).sum()), "normal": int(((y > q33) & (y <= q90)).sum()), "flood": int((y > q90).sum())}


def test_few_pairs_give_no_score(spark):
    row = ev.score_per_lead(long_rows(spark, range(9), range(9))).first()
    assert row.kge is None and row.rmse is None


def test_ks_and_distance_against_plain_counting(spark):
    rng = np.random.default_rng(4)
    a, b = np.round(rng.normal(10, 2, 700), 1), np.round(rng.normal(11, 2, 130), 1)
    rows = [("s", "c", "reference", float(v)) for v in a] + [("s", "c", "current", float(v)) for v in b]
    df = spark.createDataFrame(rows, "site STRING, column STRING, part STRING, value DOUBLE")
    got = dr.column_drift(df, ["site", "column"]).first()
    grid = np.unique(np.concatenate([a, b]))
    fa = np.array([(a <= x).mean() for x in grid])
    fb = np.array([(b <= x).mean() for x in grid])
    assert got.ks == pytest.approx(np.abs(fa - fb).max())
    assert got.wasserstein == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(grid)).sum())
    assert got.wasserstein_normed == pytest.approx(got.wasserstein / a.std())


@pytest.mark.parametrize("mean,drifted", [(10, False), (40, True)])
def test_shifted_column_is_reported(spark, mean, drifted):
    rng = np.random.default_rng(0)
    rows = [("s", "c", "reference", float(v)) for v in rng.normal(10, 2, 500)] + [("s", "c", "current", float(v)) for v in rng.normal(mean, 2, 100)]
    df = spark.createDataFrame(rows, "site STRING, column STRING, part STRING, value DOUBLE")
    row = dr.column_drift(df, ["site", "column"]).first()
    assert row.drifted is drifted and (row.p_value < 0.05) is drifted


def test_one_of_three_columns_is_no_dataset_drift(spark):
    rows = spark.createDataFrame([("s", True), ("s", False), ("s", False)], "site STRING, drifted BOOLEAN")
    row = dr.dataset_drift(rows).first()
    assert row.n_drifted == 1 and row.dataset_drift is False


def test_alerts(spark):
    g = spark.createDataFrame([("a", 0.4, True), ("b", 0.9, False), ("c", None, None)], "site STRING, kge DOUBLE, dataset_drift BOOLEAN")
    assert sorted(map(tuple, dr.alerts(g).collect())) == [("a", "input_drift"), ("a", "model_quality_low")]
