"""Flow, upstream and weather features on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermill.functions.ewm import ewm_means
from rivermill.operators import flow as fl
from rivermill.operators import sequences as sq
from rivermill.operators import upstream as us
from rivermill.operators import weather as wx
from rivermill.plans import tables as t
from rivermill.plans.oracle import ewm_sql, same
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.shape import rounded

LAGS = (7, 8, 12, 14, 16, 24, 32)
PAIRS = tuple(zip(LAGS, LAGS[1:]))
HOURS = wx.WINDOW_HOURS


def _flow(columns):
    def run(s, d):
        feats = fl.flow_features(t.daily(s, d), t.DAILY, t.H, only=columns)
        return rounded(feats.select("site", "ts", *columns), 8)

    return run


def _weather(columns, lags=(), part=wx.weather_features):
    def run(s, d):
        feats = part(t.dense_weather(s, d), t.basins(s, d), t.POINTS, lags, columns)
        # Half of the temperature means end in a 5 at the sixth place; nine keep both engines off the tie.
        return rounded(feats.select("site", "point", "ts", *columns), 9 if "temp_48h" in columns else 6)

    return run


def _upstream(columns):
    def run(s, d):
        flow_lag = us_flow_lag(s, d)
        feats = us.upstream_features(t.daily_upstream(s, d), t.transit(s, d), flow_lag, t.STATIONS_DAILY, t.H)
        return rounded(feats.select("site", "station", "ts", *columns), 8)

    return run


def us_flow_lag(s, d):
    """Reference flow `H` steps earlier, as an equi join key moved forward."""
    moved = F.timestamp_seconds(F.unix_seconds("ts") + t.H * t.DAILY.step)
    return t.daily(s, d).select("site", moved.alias("ts"), F.col("flow").alias("flow_lag"))


def w29(s, d):
    return rounded(wx.saturation_features(t.dense_weather(s, d), t.basins(s, d), t.POINTS))


def d17(s, d):
    return rounded(wx.basin_inflow(t.dense_weather(s, d), t.basins(s, d), t.POINTS))


def d20(s, d):
    return rounded(wx.reference_temperature(t.dense_weather(s, d), ["site", "point"]))


def w32(s, d):
    return rounded(sq.trend_slope(t.dense_hourly(s, d), t.HOURLY))


def w33(s, d):
    rows = sq.lead_matrix(t.dense_hourly(s, d), t.HOURLY, "flow", t.H)
    return rounded(rows.select("site", "ts", *[F.col("leads")[k - 1].alias(f"t_{k}") for k in range(1, t.H + 1)], F.col("leads").isNotNull().alias("inside")))


def w34(s, d):
    w = t.dense_weather(s, d).select("site", "point", "ts", "temp_k", "precip_cum_mm")
    return rounded(sq.weather_lag_block(w, t.POINTS, ["temp_k", "precip_cum_mm"], t.H), 8)


SEQ = 24


def _array_facts(df):
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v.cast("double"))
    return df.select(
        "site", "ts", F.size("x").cast("long").alias("steps"), F.size(F.col("x")[0]).cast("long").alias("inputs"),
        total.alias("x_sum"), F.col("x")[SEQ - 1][0].cast("double").alias("last_known"),
        F.col("x")[SEQ][0].cast("double").alias("blanked"), F.col("y")[t.H - 1].alias("y_last"),
    )


def w35(s, d):
    return rounded(_array_facts(sq.sliding_sequences(t.dense_hourly(s, d), t.HOURLY, SEQ, t.H)))


def w36(s, d):
    df = sq.last_window(t.dense_hourly(s, d), t.HOURLY, SEQ, t.H)
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v.cast("double"))
    return rounded(df.select("site", F.size("x").cast("long").alias("steps"), total.alias("x_sum"), F.col("x")[SEQ - 1][0].cast("double").alias("last_known")))


def w37(s, d):
    dims = wx.weather_base(t.dense_weather(s, d), t.basins(s, d), t.POINTS).where("_core")
    one = dims.groupBy("site", "point").agg(F.first("distance_km").alias("distance_km"), F.first("windows").alias("windows"), F.first("transfer_h").alias("transfer_h"))
    return rounded(one.withColumn("windows", F.array_join("windows", ",")))


def j02(s, d):
    """EWM over daily upstream flow of every station."""
    ax = t.STATIONS_DAILY
    split = ax.split(t.daily_upstream(s, d))
    return rounded(ax.core(ewm_means(split, ax, "upstream", {"ewm_15": (15, 3)})), 8)


def j03(s, d):
    base = wx.weather_base(t.dense_weather(s, d), t.basins(s, d), t.POINTS)
    daily = t.POINTS.core(base).groupBy("site", "point", F.date_trunc("day", "ts").alias("ts"))
    return rounded(daily.agg(F.sum("melt").alias("melt"), F.max("snow_stock").alias("stock_max"), F.sum("snow").alias("snow")))


_LOCAL = {
    "w15_decumulate_precip": ["precip"],
    "w16_rain_snow_partition": ["temp", "rain", "snow", "ground_rain"],
    "w17_snow_stock_melt": ["snow_stock", "melt", "melt_potential"],
    "w18_net_inflow": ["inflow_raw", "net_inflow"],
    "w19_temp_smooth": ["temp_48h", "temp_24h", "temp_diff6_48h", "temp_diff6_24h"],
    "w20_high_altitude_block": ["frost_factor", "log_snow_stock", "cooling_6h", "warming_6h", "stock_x_temp", "rain_on_snow",
                                "melt_24h", "melt_72h", "melt_168h", "melt_gradient_24h", "frost_flag"],
    "w21_antecedent_index": ["antecedent_rain"],
    "w22_water_deficit": ["deficit_7d", "deficit_30d"],
    "w23_rain_intensity": ["rain_1h", "rain_3h", "rain_shock"],
    "w31_melt_ratio": ["melt_ratio"],
}
_TRAVELLED = {
    "w25_transfer_shift": ["transfer_h", "inflow_shifted"],
    "w26_theoretical_discharge": ["discharge", "discharge_gradient_1h", "discharge_gradient_3h", "discharge_accel_6h",
                                  "inflow_acceleration", "hydraulic_shock"],
    "w27_windowed_inflow": [f"{n}_{h}h" for h in HOURS for n in ("inflow_sum", "inflow_mean", "discharge", "inflow_lag")],
    "w28_reserves_ewm": ["reserve_flash", "reserve_short", "reserve_medium", "reserve_base", "ratio_fast_base"],
    "w30_reactivity": ["reactivity_12h", "discharge_mean_6h", "discharge_mean_24h", "discharge_mean_7d", "discharge_mean_30d", "surge_relative"],
}
_LAG24 = ["precip_lag_6", "temp_lag_6", "precip_sum_6", "precip_lag_24", "temp_lag_24", "precip_sum_24"]
_F = {
    "w02_rolling_q95_cap": ["q95_year"],
    "w03_max_seen_30d": ["max_seen_30d"],
    "w04_flow_lags": [f"lag_{n}" for n in LAGS],
    "w05_decline_vs_max": ["decline_vs_max"],
    "w06_lag_gradients": [f"gradient_{a}v{b}" for a, b in PAIRS],
    "w07_lag_accelerations": [f"accel_{a}v{b}v{c}v{e}" for (a, b), (c, e) in zip(PAIRS, PAIRS[1:])],
    "w08_trend_rel": ["trend_rel"],
    "w09_recession_log": ["recession_log_7", "recession_log_12"],
    "w10_baseflow_ewm": ["baseflow_7d", "baseflow_30d", "ratio_fast_base"],
    "w11_anomaly_zscore": ["anomaly_zscore", "ratio_seasonal"],
}
_U = {
    "w12_upstream_lags": ["upstream_lag_8", "upstream_lag_20", "upstream_lag_24", "upstream_lag_32"],
    "w13_upstream_gradients": ["upstream_gradient_6h", "upstream_gradient_24h"],
    "w14_upstream_ratio": ["upstream_ratio"],
}

QUERIES = {
    **{k: _flow(c) for k, c in _F.items()},
    **{k: _upstream(c) for k, c in _U.items()},
    **{k: _weather(c, part=wx.local_features) for k, c in _LOCAL.items()},
    **{k: _weather(c) for k, c in _TRAVELLED.items()},
    "w24_weather_lags": _weather(_LAG24, (6, 24), wx.local_features),
    "w29_saturation_index": w29, "w32_trend_slope_72h": w32, "w33_lead_matrix": w33, "w34_weather_lag_block": w34, "w35_sliding_sequences": w35,
    "w36_last_window": w36, "w37_windows_for_distance": w37, "d17_basin_mean_inflow": d17, "d20_ref_year_mean_temp": d20,
    "j02_ewm_mean": j02, "j03_snow_scan": j03,
}

def _flow_sql(columns: dict[str, str]) -> str:
    return q(f"SELECT site, ts, {rr(8, **columns)} FROM flow_feat", "flow_feat")


def _win(n: int, agg: str, x: str, least: int | None = None, keys: str = "site, point", order: str = "rn") -> str:
    """Aggregate over the last n rows with a floor on present values."""
    over = f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS {n - 1} PRECEDING)"
    need = n if least is None else least
    return f"CASE WHEN count({x}) {over} >= {need} THEN {agg}({x}) {over} END"


def _lag(x: str, n: int) -> str:
    return f"lag({x}, {n}) OVER (PARTITION BY site, point ORDER BY rn)"


def _d(x: str, n: int) -> str:
    return f"({x} - {_lag(x, n)})"


def _weather_sql(columns: dict[str, str], source: str, extra=None, frm: str | None = None, digits: int = 6, plain=()) -> str:
    listed = ", ".join(["site", "point", "ts", *plain, *([rr(digits, **columns)] if columns else [])])
    return q(f"SELECT {listed} FROM {frm or source}", source, extra=extra)


_SHIFT = {
    "shifted": """SELECT r.site, r.station, r.ts, u.upstream, f.lag_flow
      FROM (SELECT a.site, a.station, a.ts, greatest(8, coalesce(t.hours, 8)::BIGINT)::INTEGER AS n FROM (SELECT *, CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter'
              WHEN month(ts) IN (3, 4, 5) THEN 'spring' WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM upstream) a
            LEFT JOIN transit t ON t.site = a.site AND t.station = a.station AND t.season = a.season) r
      LEFT JOIN upstream u ON u.site = r.site AND u.station = r.station AND u.ts = r.ts - to_days(n)
      LEFT JOIN (SELECT site, ts + INTERVAL 8 DAY AS ts, flow AS lag_flow FROM daily) f ON f.site = r.site AND f.ts = r.ts"""
}


def _up_sql(columns: dict[str, str]) -> str:
    return q(f"SELECT site, station, ts, {rr(8, **columns)} FROM shifted WINDOW w AS (PARTITION BY site, station ORDER BY ts)", "upstream", "transit", "daily", extra=_SHIFT)


_EWM_SHIFTED = {f"e{n}": ewm_sql("arrived", "site, point", n, "inflow_shifted", "v") for n in (12, 72, 168, 720)}
_EWM_JOIN = "arrived a " + " ".join(
    f"LEFT JOIN e{n} ON e{n}.site = a.site AND e{n}.point = a.point AND e{n}.rn = a.rn" for n in (12, 72, 168, 720)
)


def _mean(h: int) -> str:
    return _win(h, "avg", "inflow_shifted", 1)


def _used(h: int, x: str) -> str:
    return f"CASE WHEN list_contains(windows, {h}) THEN {x} END"


_REACT = {
    "smooth": f"SELECT *, {_mean(24)} * surface_km2 / 3.6 AS ref, {_mean(12)} AS m12, {_mean(72)} AS m72, {_mean(168)} AS m168 FROM arrived",
    "ref6": f"SELECT *, {_win(6, 'avg', 'ref', 1)} AS mean6 FROM smooth",
}
_SAT = {
    "m30": f"SELECT *, {_win(720, 'avg', 'net_inflow', 1)} AS m FROM net",
    "sat": "SELECT *, m / (avg(m) OVER (PARTITION BY site, point ORDER BY rn) + 1e-6) AS saturation FROM m30",
}
_TEMP = {
    "deficit": "SELECT *, CASE WHEN et0 - ground_rain < 0 THEN 0.0 ELSE et0 - ground_rain END AS missing FROM net",
}
_SEQ_ROWS = {
    "feat": """SELECT site, ts, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn, ln(1 + CASE WHEN flow < 0 THEN 0 ELSE flow END) AS y,
       y::FLOAT::DOUBLE AS f, sin(2 * pi() * hour(ts) / 24)::FLOAT::DOUBLE + cos(2 * pi() * hour(ts) / 24)::FLOAT::DOUBLE
       + sin(2 * pi() * dayofyear(ts) / 365)::FLOAT::DOUBLE + cos(2 * pi() * dayofyear(ts) / 365)::FLOAT::DOUBLE AS clock FROM dense""",
}

ORACLE = {
    "w02_rolling_q95_cap": _flow_sql({"q95_year": "q95_year"}),
    "w03_max_seen_30d": _flow_sql({"max_seen_30d": "max_seen_30d"}),
    "w04_flow_lags": _flow_sql({f"lag_{n}": f"lag_{n}" for n in LAGS}),
    "w05_decline_vs_max": _flow_sql({"decline_vs_max": "lag_8 / (max_seen_30d + 1e-6)"}),
    "w06_lag_gradients": _flow_sql({f"gradient_{a}v{b}": f"lag_{a} - lag_{b}" for a, b in PAIRS}),
    "w07_lag_accelerations": _flow_sql(
        {f"accel_{a}v{b}v{c}v{e}": f"(lag_{a} - lag_{b}) - (lag_{c} - lag_{e})" for (a, b), (c, e) in zip(PAIRS, PAIRS[1:])}
    ),
    "w08_trend_rel": _flow_sql({"trend_rel": "(lag_7 - lag_8) / (lag_8 + 1e-3)"}),
    "w09_recession_log": _flow_sql({"recession_log_7": "ln(1 + lag_8) - ln(1 + lag_7)", "recession_log_12": "ln(1 + lag_14) - ln(1 + lag_12)"}),
    "w10_baseflow_ewm": q(
        f"""SELECT site, ts, {rr(8, baseflow_7d='b7', baseflow_30d='b30', ratio_fast_base='b7 / (b30 + 1e-6)')} FROM (
              SELECT f.site, f.ts, CASE WHEN e7.v > q95_year THEN q95_year ELSE e7.v END AS b7, CASE WHEN e30.v > q95_year THEN q95_year ELSE e30.v END AS b30
              FROM flow_lag f LEFT JOIN e7 ON e7.site = f.site AND e7.rn = f.rn LEFT JOIN e30 ON e30.site = f.site AND e30.rn = f.rn)""",
        "flow_lag",
        extra={"e7": ewm_sql("flow_lag", "site", 7, "lag_8", "v"), "e30": ewm_sql("flow_lag", "site", 30, "lag_8", "v")}),
    "w11_anomaly_zscore": q(
        f"""SELECT site, ts, {rr(8, anomaly_zscore='(lag_8 - m) / (sd + 1e-6)', ratio_seasonal='lag_8 / (m + 1e-6)')} FROM (
              SELECT *, {_win(30, 'avg', 'lag_8', 7, 'site')} AS m, {_win(30, 'stddev_samp', 'lag_8', 7, 'site')} AS sd FROM flow_lag)""", "flow_lag"),
    "w12_upstream_lags": _up_sql({"upstream_lag_8": "upstream", **{f"upstream_lag_{8 + n}": f"lag(upstream, {n}) OVER w" for n in (12, 16, 24)}}),
    "w13_upstream_gradients": _up_sql({f"upstream_gradient_{h}h": "upstream - lag(upstream, 1) OVER w" for h in (6, 24)}),
    "w14_upstream_ratio": _up_sql({"upstream_ratio": "upstream / (lag_flow + 1e-6)"}),
    "w15_decumulate_precip": _weather_sql({"precip": "precip"}, "wr"),
    "w16_rain_snow_partition": _weather_sql({c: c for c in _LOCAL["w16_rain_snow_partition"]}, "melt_in"),
    "w17_snow_stock_melt": _weather_sql({c: c for c in _LOCAL["w17_snow_stock_melt"]}, "runoff"),
    "w18_net_inflow": _weather_sql({c: c for c in _LOCAL["w18_net_inflow"]}, "net"),
    "w19_temp_smooth": _weather_sql({"temp_48h": "temp_48h", "temp_24h": "temp_24h", "temp_diff6_48h": _d("temp_48h", 6), "temp_diff6_24h": _d("temp_24h", 6)}, "net", digits=9),
    "w20_high_altitude_block": _weather_sql(
        {"frost_factor": "frost_factor", "log_snow_stock": "CASE WHEN high THEN ln(1 + snow_stock) END",
         "cooling_6h": "CASE WHEN high THEN CASE WHEN c6 > 0 THEN 0 ELSE c6 END END", "warming_6h": "CASE WHEN high THEN CASE WHEN c6 < 0 THEN 0 ELSE c6 END END",
         "stock_x_temp": "CASE WHEN high THEN snow_stock * temp END", "rain_on_snow": "CASE WHEN high THEN ground_rain * snow_stock END",
         "melt_24h": "CASE WHEN high THEN m24 END", "melt_72h": f"CASE WHEN high THEN {_win(72, 'sum', 'melt', 1)} END",
         "melt_168h": f"CASE WHEN high THEN {_win(168, 'sum', 'melt', 1)} END", "melt_gradient_24h": f"CASE WHEN high THEN {_d('m24', 24)} END"},
        "net", extra={"hb": f"SELECT *, {_d('temp', 6)} AS c6, {_win(24, 'sum', 'melt', 1)} AS m24 FROM net"}, frm="hb",
        plain=("CASE WHEN high AND point = 1 THEN CASE WHEN frost < 0.2 THEN 1 ELSE 0 END END AS frost_flag",)),
    "w21_antecedent_index": q(
        f"SELECT n.site, n.point, n.ts, {rr(antecedent_rain='v')} FROM net n LEFT JOIN e ON e.site = n.site AND e.point = n.point AND e.rn = n.rn",
        "net", extra={"e": ewm_sql("net", "site, point", 360, "ground_rain", "v")}),
    "w22_water_deficit": _weather_sql({"deficit_7d": _win(168, "sum", "missing", 1), "deficit_30d": _win(720, "sum", "missing", 1)}, "net", extra=_TEMP, frm="deficit"),
    "w23_rain_intensity": _weather_sql({"rain_1h": "precip", "rain_3h": _win(3, "sum", "precip"), "rain_shock": f"precip / ({_win(24, 'avg', 'precip')} + 0.1)"}, "wr"),
    "w24_weather_lags": _weather_sql(
        {c: e for n in (6, 24) for c, e in ((f"precip_lag_{n}", _lag("precip", n)), (f"temp_lag_{n}", _lag("temp_k", n)), (f"precip_sum_{n}", _win(n, "sum", "precip")))}, "wr"),
    "w25_transfer_shift": _weather_sql({"inflow_shifted": "inflow_shifted"}, "arrived", plain=("transfer_h",)),
    "w26_theoretical_discharge": _weather_sql(
        {"discharge": "discharge", "discharge_gradient_1h": _d("discharge", 1), "discharge_gradient_3h": "g3", "discharge_accel_6h": _d("g3", 3),
         "inflow_acceleration": _d("inflow_shifted", 3), "hydraulic_shock": f"{_d('inflow_shifted', 6)} / ({_lag('inflow_shifted', 6)} + 0.1)"},
        "arrived", extra={"g": f"SELECT *, {_d('discharge', 3)} AS g3 FROM arrived"}, frm="g"),
    "w27_windowed_inflow": _weather_sql(
        {c: e for h in HOURS for c, e in (
            (f"inflow_sum_{h}h", _used(h, _win(h, "sum", "net_inflow"))), (f"inflow_mean_{h}h", _used(h, _mean(h))),
            (f"discharge_{h}h", _used(h, f"{_mean(h)} * surface_km2 / 3.6")), (f"inflow_lag_{h}h", _used(h, _lag("inflow_shifted", h))))}, "arrived"),
    "w28_reserves_ewm": q(
        f"""SELECT a.site, a.point, a.ts, {rr(reserve_flash='e12.v', reserve_short='e72.v', reserve_medium='e168.v', reserve_base='e720.v', ratio_fast_base='e72.v / (e720.v + 1e-6)')}
            FROM {_EWM_JOIN}""", "arrived", extra=_EWM_SHIFTED),
    "w29_saturation_index": _weather_sql(
        {"saturation": "saturation", **{f"saturation_diff_{h}": _d("saturation", h) for h in (168, 48, 24, 6)}}, "net", extra=_SAT, frm="sat"),
    "w30_reactivity": _weather_sql(
        {"reactivity_12h": "m12 / (CASE WHEN list_contains(windows, 168) THEN m168 ELSE m72 END + 1e-6)", "discharge_mean_6h": "mean6",
         "discharge_mean_24h": _win(24, "avg", "ref", 1), "discharge_mean_7d": _win(168, "avg", "ref", 24), "discharge_mean_30d": _win(720, "avg", "ref", 24),
         "surge_relative": "discharge / (mean6 + 0.1)"}, "arrived", extra=_REACT, frm="ref6"),
    "w31_melt_ratio": _weather_sql({"melt_ratio": "melt / (net_inflow + 1e-6)"}, "net"),
    "w32_trend_slope_72h": q(
        f"""SELECT site, ts, {rr(flow='flow', trend="coalesce(CASE WHEN count(flow) OVER w >= 12 THEN regr_slope(flow, rn) OVER w END, 0)")}
            FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts)::DOUBLE AS rn FROM dense) WINDOW w AS (PARTITION BY site ORDER BY ts ROWS 71 PRECEDING)""", "dense"),
    "w33_lead_matrix": q(
        f"""SELECT site, ts, {rr(**{f't_{k}': f'CASE WHEN inside THEN lead(flow, {k}) OVER w END' for k in range(1, 9)})}, inside FROM (
              SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts DESC) > 8 AS inside FROM dense)
            WINDOW w AS (PARTITION BY site ORDER BY ts)""", "dense"),
    "w34_weather_lag_block": q(
        f"""SELECT site, point, ts, {same(8, 'temp_k', 'precip_cum_mm')}, {rr(8, temp_k_lag='coalesce(lag(temp_k, 8) OVER w, 0)', precip_cum_mm_lag='coalesce(lag(precip_cum_mm, 8) OVER w, 0)')}
            FROM weather WINDOW w AS (PARTITION BY site, point ORDER BY ts)""", "weather"),
    "w35_sliding_sequences": q(
        f"""SELECT site, ts, 32::BIGINT AS steps, 6::BIGINT AS inputs, {rr(x_sum='hist + clocks + 8', last_known='f', blanked='0.0::DOUBLE', y_last='y_last')} FROM (
              SELECT *, count(f) OVER w AS n, sum(f) OVER h AS hist, lead(y, 8) OVER o AS y_last, sum(clock) OVER w AS clocks, count(*) OVER w AS total
              FROM (SELECT * FROM feat) WINDOW o AS (PARTITION BY site ORDER BY rn), h AS (PARTITION BY site ORDER BY rn ROWS 23 PRECEDING),
                   w AS (PARTITION BY site ORDER BY rn ROWS BETWEEN 23 PRECEDING AND 8 FOLLOWING))
            WHERE n = 32 AND total = 32""", "dense", extra=_SEQ_ROWS),
    "w36_last_window": q(
        f"""SELECT site, 32::BIGINT AS steps, {rr(x_sum='sum(CASE WHEN back > 8 THEN coalesce(f, 0) ELSE 0 END) + sum(clock) + 8', last_known='coalesce(max(f) FILTER (WHERE back = 9), 0)')}
            FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY rn DESC) AS back FROM feat) WHERE back <= 32 GROUP BY site""", "dense", extra=_SEQ_ROWS),
    "w37_windows_for_distance": q(
        f"SELECT DISTINCT site, point, {rr(distance_km='distance_km')}, array_to_string(windows, ',') AS windows, transfer_h FROM wb", "wb"),
    "d17_basin_mean_inflow": q(f"SELECT site, ts, {rr(basin_inflow='avg(discharge)')} FROM arrived GROUP BY 1, 2", "arrived"),
    "d20_ref_year_mean_temp": q(f"SELECT site, point, {rr(mean_temp_k='mean_temp_k')} FROM point_dim", "point_dim"),
    "j02_ewm_mean": q(
        f"""SELECT n.site, n.station, n.ts, {rr(8, upstream='n.upstream', ewm_15='CASE WHEN e.n >= 3 THEN v END')} FROM n
            LEFT JOIN e ON e.site = n.site AND e.station = n.station AND e.rn = n.rn""", "upstream",
        extra={"n": "SELECT *, row_number() OVER (PARTITION BY site, station ORDER BY ts) AS rn FROM upstream", "e": ewm_sql("n", "site, station", 15, "upstream", "v")}),
    "j03_snow_scan": q(
        f"SELECT site, point, date_trunc('day', ts) AS ts, {rr(melt='sum(melt)', stock_max='max(snow_stock)', snow='sum(snow)')} FROM runoff GROUP BY 1, 2, 3", "runoff"),
}
