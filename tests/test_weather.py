import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivermill.functions import columns as fn
from rivermill.functions.blocks import Axis
from rivermill.operators import weather as wx

POINT = Axis(("site", "point"), 3600)


def basin(spark, alt=300.0, k=2.0, expo=1.0):
    return spark.createDataFrame([("a", alt, 100.0, k, expo, 0.9, 43.13, 0.92)],
                                 "site STRING, alt_basin DOUBLE, surface_km2 DOUBLE, k_base DOUBLE, exposition DOUBLE, kc_unit DOUBLE, out_lat DOUBLE, out_lon DOUBLE")


def frame(series, temps, precip, alt=300.0, lat=43.1, lon=0.9, start="2026-01-01"):
    return series(temps, start=start, name="temp_k", point=1, precip_cum_mm=np.array(precip, dtype=float), lat=lat, lon=lon, alt=alt)


def test_distance_windows_and_haversine(spark):
    rows = spark.createDataFrame([(float(k),) for k in (10, 50, 75, 100, 500, 1000, 2000)], "km DOUBLE")
    got = [r[0] for r in rows.select(fn.distance_windows(F.col("km"))).collect()]
    near, mid, far, last = [1, 3, 6, 12, 24, 36, 48, 72], [6, 12, 24, 36, 48, 72], [12, 24, 36, 48, 72, 168], [24, 36, 48, 72, 168]
    assert got == [near, near, mid, mid, far, far, last]
    km = spark.range(1).select(fn.haversine_km(F.lit(48.8566), F.lit(2.3522), F.lit(45.764), F.lit(4.8357))).first()[0]
    assert km == pytest.approx(391.5, abs=1)


def test_evapotranspiration_known_value(spark):
    ts = F.lit("2026-06-21 12:00:00").cast("timestamp")
    got = spark.range(1).select(fn.et0(F.lit(43.0), ts, F.lit(293.15), F.lit(1.0))).first()[0]
    assert got == pytest.approx(0.31794851615741726, rel=1e-9)


def test_reference_temperature_uses_only_the_latest_year(spark, series):
    w = frame(series, [293.15], [0.0], start="2026-06-21 12:00").unionByName(frame(series, [250.0], [0.0], start="2025-06-21 12:00"))
    assert wx.reference_temperature(w, ["site", "point"]).first().mean_temp_k == pytest.approx(293.15)


def test_phase_of_precipitation(spark, series, ordered):
    out = wx.weather_base(frame(series, [276.4, 276.4, 269.9], [0.0, 2.0, 4.0]), basin(spark), POINT).where("_core")
    assert ordered(out, "rain") == [None, 2.0, 0.0]
    assert ordered(out, "snow") == [0.0, 0.0, 2.0]
    assert ordered(out, "ground_rain") == pytest.approx([0.0, 1.8, 0.0])


def walk(potential, snow):
    """The plain step-by-step rule: melt at most what lies there, the rest fades a little."""
    stock, out = 0.0, []
    for p, s in zip(potential, snow):
        if p is None or s is None:
            out.append((0.0, p))
            stock = 0.0
            continue
        melt = min(p, stock + s)
        stock = max(0.0, (stock + s - melt) * wx.STOCK_DECAY)
        out.append((stock, melt))
    return out


@pytest.mark.parametrize("block", [None, 25_000])
def test_snow_scan_equals_the_step_by_step_rule(spark, series, ordered, block):
    rng = np.random.default_rng(7)
    n = 2500
    potential = [None if rng.random() < 0.004 else float(max(0, v)) for v in rng.normal(0.1, 0.6, n)]
    snow = [None if rng.random() < 0.003 else float(v) for v in rng.gamma(0.3, 1.0, n)]
    df = series(potential, name="melt_potential")
    df = df.join(series(snow, name="snow"), ["site", "ts"])
    ax = Axis(("site",), 3600, block=block)
    out = ax.core(wx.snow_scan(ax.split(df, back=wx.snow_memory()), ax))
    got = ordered(out, "snow_stock", "melt")
    want = walk(potential, snow)
    assert [g[0] for g in got] == pytest.approx([w[0] for w in want], abs=1e-9)
    for g, w in zip(got, want):
        assert (g[1] is None) == (w[1] is None)
        if g[1] is not None:
            assert g[1] == pytest.approx(w[1], abs=1e-9)


def test_features_do_not_depend_on_the_block_length(spark, series, ordered):
    rng = np.random.default_rng(2)
    n = 600
    temps = [None if rng.random() < 0.05 else float(v) for v in 273 + rng.normal(0, 6, n)]
    precip = np.cumsum(rng.gamma(0.4, 2.0, n))
    w = frame(series, temps, precip, lat=43.6, lon=1.4)
    names = ["net_inflow", "snow_stock", "antecedent_rain", "melt_168h", "deficit_30d", "reserve_base", "discharge_mean_7d", "hydraulic_shock", "inflow_mean_72h"]
    small = Axis(("site", "point"), 3600, block=128)
    a = ordered(wx.weather_features(w, basin(spark, 1500.0), small), *names)
    b = ordered(wx.weather_features(w, basin(spark, 1500.0), POINT), *names)
    assert len(a) == n
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=1e-9)
    sat = ["saturation", "saturation_diff_168", "saturation_diff_6"]
    a = ordered(wx.saturation_features(w, basin(spark), small), *sat)
    b = ordered(wx.saturation_features(w, basin(spark), POINT), *sat)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=1e-9)


@pytest.mark.parametrize("only", [["precip", "rain_shock"], ["antecedent_rain"], ["deficit_30d", "deficit_7d"], ["melt_168h", "inflow_sum_168h"],
                                  ["discharge_mean_7d", "reserve_base"], ["discharge_mean_30d", "transfer_h"]])
def test_columns_asked_for_alone_are_the_same_in_small_blocks(spark, series, ordered, only):
    rng = np.random.default_rng(4)
    n = 900
    w = frame(series, [float(v) for v in 273 + rng.normal(0, 6, n)], np.cumsum(rng.gamma(0.4, 2.0, n)), lat=43.6, lon=1.4)
    small = Axis(("site", "point"), 3600, block=64)
    a = ordered(wx.weather_features(w, basin(spark, 1500.0), small, only=only), *only)
    b = ordered(wx.weather_features(w, basin(spark, 1500.0), POINT), *only)
    assert len(a) == n
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=1e-9)


def test_high_basin_block_is_null_below_the_limit(spark, series):
    w = frame(series, [280.0] * 48, np.arange(48) * 2.0)
    low = wx.local_features(w, basin(spark, 300.0), POINT).first()
    high = wx.local_features(w, basin(spark, 1500.0), POINT).first()
    assert low.frost_factor is None and low.log_snow_stock is None
    assert high.frost_factor is not None and high.frost_flag in (0, 1)


def test_cumulate_then_decumulate(spark, series, ordered):
    raw = series([10.0, 12.5, 9.0, 8.0], name="temp_c", point=1, precip_mm=np.array([0.0, 2.0, 0.0, 3.5]), lat=43.0, lon=1.0, alt=200.0)
    out = wx.normalise_weather(raw, POINT)
    assert ordered(out, "temp_k")[:2] == pytest.approx([283.15, 285.65])
    assert np.diff(ordered(out, "precip_cum_mm")).tolist() == pytest.approx([2.0, 0.0, 3.5])


def test_seasons_and_cycles(spark):
    row = spark.sql("SELECT timestamp'2026-03-01 06:00:00' AS ts").select(fn.season(F.col("ts")), *fn.cyclic(F.hour("ts"), 24)).first()
    assert row[0] == "spring" and row[1] == pytest.approx(1.0) and row[2] == pytest.approx(math.cos(math.pi / 2), abs=1e-12)
