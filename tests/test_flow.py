import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.operators.flow import flow_features, flow_lags, rolling_quantile
from rivermill.operators.upstream import seasonal_shift, transit_table, upstream_features

HOURLY = Axis(("site",), 3600)
DAILY = Axis(("site",), 86_400)
UP = Axis(("site", "station"), 3600)


def test_lag_list():
    assert flow_lags(8, 24) == [8, 12, 16, 24, 32, 168, 336]
    assert flow_lags(8, 1) == [7, 8, 12, 14, 16, 24, 32]


def test_ramp_has_known_lags_and_slopes(series):
    row = flow_features(series([float(i) for i in range(500)]), HOURLY, 8).orderBy("ts").collect()[400]
    assert row.lag_8 == 392 and row.lag_336 == 64
    assert row.gradient_8v12 == 4 and row.gradient_16v24 == 8 and row.gradient_168v336 == 168
    assert row.accel_24v32v32v168 == 8 - 136
    assert row.trend_rel == pytest.approx(4 / 392.001)
    assert row.decline_vs_max == pytest.approx(392 / 400.000001)
    assert row.recession_log_8 == pytest.approx(np.log1p(388) - np.log1p(392))


def test_spike_is_capped_and_baseflow_follows(series, ordered):
    values = [10.0] * 10 + [20.0] * 10 + [15.0] * 10 + [50.0] + [12.0] * 14
    out = flow_features(series(values, freq="D"), DAILY, 2)
    s = pd.Series(values)
    q95 = s.rolling(365, min_periods=30).quantile(0.95)
    top = s.rolling(30, min_periods=1).max()
    want_max = top.where(~(top > q95), q95)
    base = s.shift(2).ewm(span=7, min_periods=1).mean()
    want_base = base.where(~(base > q95), q95)
    assert ordered(out, "max_seen_30d") == pytest.approx(want_max.tolist())
    got = ordered(out, "baseflow_7d")
    assert got[:2] == [None, None]
    assert got[2:] == pytest.approx(want_base.tolist()[2:])
    lag = s.shift(2)
    mean, std = lag.rolling(30, min_periods=7).mean(), lag.rolling(30, min_periods=7).std()
    z = ordered(out, "anomaly_zscore")
    assert z[-1] == pytest.approx(((lag - mean) / (std + 1e-6)).iloc[-1])
    assert z[7] is None and z[8] is not None


def test_moving_quantile_is_the_same_in_small_blocks(series, ordered):
    rng = np.random.default_rng(5)
    values = [None if rng.random() < 0.1 else float(v) for v in rng.gamma(2, 3, 200)]
    df = series(values, freq="D")
    want = pd.Series(values, dtype=float).rolling(60, min_periods=20).quantile(0.95)
    for block in (None, 33):
        out = rolling_quantile(df, Axis(("site",), 86_400, block=block), "flow", 60, 20, 0.95, "q")
        pd.testing.assert_series_equal(pd.Series(ordered(out, "q"), dtype=float), want, check_names=False)


def _upstream(series, values, start):
    return series(values, start=start, name="upstream").withColumn("station", F.lit("A"))


def _transit(spark, hours):
    docs = spark.createDataFrame([("a", "A", hours)], "site STRING, station STRING, transit MAP<STRING, DOUBLE>")
    return transit_table(docs)


def test_shift_changes_with_the_receiving_season(spark, series, ordered):
    up = _upstream(series, [float(i) for i in range(14 * 24)], "2026-02-25")
    out = seasonal_shift(up, _transit(spark, {"DJF": 3.0, "MAM": 5.0}), UP, 1)
    values = ordered(out, "upstream")
    march = 4 * 24
    assert values[march - 1] == march - 1 - 3
    assert values[march] == march - 5


def test_shift_never_below_the_horizon(spark, series, ordered):
    up = _upstream(series, [float(i) for i in range(240)], "2026-01-01")
    assert ordered(seasonal_shift(up, _transit(spark, {"DJF": 2.0}), UP, 5), "upstream")[100] == 95
    other = _transit(spark, {"DJF": 9.0}).where("station = 'none'")
    assert ordered(seasonal_shift(up, other, UP, 5), "upstream")[100] == 95


def test_upstream_gradients_and_ratio(spark, series):
    up = _upstream(series, [float(i) for i in range(60)], "2026-01-01")
    lag = series([4.0] * 60).withColumnRenamed("flow", "flow_lag")
    none = _transit(spark, {"DJF": 1.0}).where("false")
    row = upstream_features(up, none, lag, UP, 8).orderBy("ts").collect()[50]
    assert row.upstream_lag_8 == 42 and row.upstream_lag_20 == 30
    assert row.upstream_gradient_6h == 6 and row.upstream_gradient_24h == 24
    assert row.upstream_ratio == pytest.approx(42 / 4.000001)
