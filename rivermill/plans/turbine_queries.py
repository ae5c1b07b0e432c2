"""Scalar functions, turbine conversion and forecast tables on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermill.functions import columns as fn
from rivermill.functions.sql import register_functions
from rivermill.operators import forecast as fc
from rivermill.operators import turbine as tb
from rivermill.operators import weather as wx
from rivermill.plans import tables as t
from rivermill.plans.oracle import SEASON, same
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.shape import rounded

NOW = "2024-01-30 20:00:00"


def h01(s, d):
    k = F.col("c_custkey")
    km = fn.haversine_km(F.lit(43.0), F.lit(1.0), (k % 900) / 10 - 45, (k % 1700) / 10 - 85)
    return rounded(t.table(s, d, "customer").select("c_custkey", km.alias("km")))


def h02(s, d):
    w = t.dense_weather(s, d)
    means = wx.reference_temperature(w, ["site", "point"])
    rows = w.join(means, ["site", "point"])
    return rounded(rows.select("site", "point", "ts", fn.et0(F.col("lat"), F.col("ts"), F.col("mean_temp_k"), F.lit(0.9)).alias("et0")))


def h03(s, d):
    rows = t.weather_raw(s, d).join(t.basins(s, d), "site")
    temp = fn.basin_temperature(F.col("temp_c") + 273.15, F.col("alt_basin"), F.col("alt"))
    return rounded(rows.select("site", "point", "ts", temp.alias("temp")), 8)


def h04(s, d):
    x = F.col("l_quantity")
    return rounded(t.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.to_log(x).alias("log_q"), fn.from_log(fn.to_log(x) - 2).alias("back")))


def h05(s, d):
    ts = F.col("ts")
    hs, hc = fn.cyclic(F.hour(ts), 24)
    ds, dc = fn.cyclic(F.dayofyear(ts), 365)
    ms, mc = fn.cyclic(F.month(ts), 12)
    ss, sc = fn.cyclic(F.dayofyear(ts) - 172, 365)
    return rounded(t.readings(s, d).select(
        "event_id", hs.alias("hour_sin"), hc.alias("hour_cos"), ds.alias("doy_sin"), dc.alias("doy_cos"),
        ms.alias("month_sin"), mc.alias("month_cos"), ss.alias("season_sin"), sc.alias("season_cos")))


def h06(s, d):
    return t.table(s, d, "orders").select(fn.season(F.col("o_orderdate")).alias("season")).groupBy("season").agg(F.count(F.lit(1)).alias("n"))


def h07(s, d):
    ts = F.col("o_orderdate").cast("timestamp") + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return t.table(s, d, "orders").select("o_orderkey", fn.paris_time(ts).alias("local_ts"))


def h08(s, d):
    ts = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(ts, "dd/MM/yyyy"))
    return t.table(s, d, "orders").select("o_orderkey", F.date_trunc("hour", fn.parse_utc(text)).alias("ts"))


def h09(s, d):
    coeffs = F.array(F.col("p_retailprice") / 100, F.lit(-0.05), F.lit(0.01))
    return rounded(t.table(s, d, "part").select("p_partkey", fn.polynomial(coeffs, F.col("p_size").cast("double")).alias("y")))


def _with_plant(s, d):
    """A merge join: the nested records take far more memory than their file, whose size would have them broadcast."""
    return t.inflow(s, d).join(t.registry(s, d).drop("site_order", "plant", "strategy").hint("merge"), "site")


_KEY = ("site", "l_orderkey", "l_linenumber", "ts", "flow")


def h10(s, d):
    rows = _with_plant(s, d).select(*_KEY, F.posexplode("groups").alias("i", "g"))
    return rounded(rows.select(*_KEY, "i", tb.head(F.col("g"), F.col("flow")).alias("head")))


def h11(s, d):
    rows = _with_plant(s, d).select(*_KEY, F.posexplode("groups").alias("i", "g"))
    return rounded(rows.select(*_KEY, "i", tb.efficiency(F.col("g"), F.col("flow") * 2).alias("efficiency")))


def h12(s, d):
    return rounded(_with_plant(s, d).select(*_KEY, tb.reserve_flow(F.col("ts")).alias("reserve")))


def h13(s, d):
    rows = _with_plant(s, d).withColumn("used", tb.dispatch(F.col("flow"), F.col("groups")))
    return rounded(rows.select(*_KEY, F.posexplode("used").alias("rank", "used")))


def h14(s, d):
    rows = tb.hydraulic_points(t.inflow(s, d), t.registry(s, d))
    return rounded(rows.select(*_KEY, "usable", "reserved", "power", "power_max", "head", "efficiency"))


def h15(s, d):
    flow = t.daily_upstream(s, d).withColumnRenamed("upstream", "flow").withColumn("flow_factor", F.lit(1.2))
    halves = t.transit(s, d).withColumn("hours", F.col("hours") / 2)
    return rounded(tb.turbine_time(flow, halves), 8)


def h17(s, d):
    return t.table(s, d, "documents").select("doc_id", F.md5(fn.slug(F.col("text"))).alias("slug_hash"), F.length(fn.slug(F.col("text"))).cast("long").alias("n"))


def h18(s, d):
    folded = fn.fold_text(F.col("text"))
    return t.table(s, d, "documents").select("doc_id", F.md5(folded).alias("folded_hash"), F.length(folded).cast("long").alias("n"))


def h21(s, d):
    from rivermill.sources.registry import WATERSHED_SCHEMA, basin_parameters

    doc = F.to_json(F.struct(
        F.struct(F.col("alt_basin").alias("altitude_moyenne_m"), "surface_km2").alias("bassin_versant"),
        F.struct(F.col("k_base").alias("K_base"), "exposition", "kc_unit").alias("parametres_calage"),
    ))
    docs = t.basins(s, d).select("site", F.from_json(doc, WATERSHED_SCHEMA).alias("w")).select("site", "w.*")
    return rounded(basin_parameters(docs))


def h22(s, d):
    return rounded(wx.normalise_weather(t.weather_raw(s, d), t.POINTS), 8)


def f05(s, d):
    rows = t.registry(s, d).where(F.size("groups") > 0).withColumn("ordered", tb.order_groups(F.col("groups")))
    return rows.select(
        "site", tb.best_priority(F.col("groups")).alias("best_priority"),
        F.array_join(F.transform("ordered", lambda g: F.coalesce(g["name"], F.lit("?"))), ",").alias("order"))


def g04(s, d):
    return rounded(_forecast_rows(s, d))


def _forecast_rows(s, d):
    factors = t.plants(s, d).select("site", "flow_factor")
    return fc.forecast_table(t.dense_hourly(s, d), t.stored_forecast(s, d), t.plant_transit(s, d), factors)


def forecast_points(s, d):
    points = fc.forecast_points(_forecast_rows(s, d), t.plants(s, d), NOW)
    return rounded(points.select("site", "ts", "lead_hours", "source", "flow", "usable", "reserved", "power", "power_max", "head", "efficiency"))


def j04(s, d):
    register_functions(s)
    t.table(s, d, "orders").createOrReplaceTempView("rm_orders")
    return rounded(s.sql(
        """SELECT o_orderkey, season_of(CAST(o_orderdate AS TIMESTAMP)) AS season,
                  haversine_km(43.0D, 1.0D, CAST(o_custkey % 90 AS DOUBLE), CAST(o_custkey % 180 AS DOUBLE)) AS km,
                  polynomial(array(1D, 0.5D, -0.01D), CAST(o_orderkey % 40 AS DOUBLE)) AS y FROM rm_orders"""))


QUERIES = {
    "f05_order_groups": f05, "g04_union_observed_forecast": g04, "h01_haversine": h01, "h02_et0": h02, "h03_bv_temperature": h03,
    "h04_log_transform": h04, "h05_cyclic_encodings": h05, "h06_season_of_month": h06, "h07_paris_time": h07, "h08_parse_dates": h08,
    "h09_polynomial": h09, "h10_head": h10, "h11_efficiency": h11, "h12_reserve_flow": h12, "h13_dispatch": h13,
    "h14_hydraulic_point": h14, "h15_turbine_time": h15, "h17_slug": h17, "h18_normalize": h18, "h21_bv_params": h21,
    "h22_kelvin_and_cumulate": h22, "j04_sql_functions": j04, "a13_forecast_points": forecast_points,
}

_PLANT = {"joined": "SELECT i.*, r.* EXCLUDE (site) FROM inflow i JOIN registry r ON r.site = i.site"}
_HEAD = """greatest(0, CASE WHEN {q} >= 0 AND {q} <= 20 THEN h0a - 0.05 * {q} ELSE h0b - 0.02 * {q} END)"""
_EFF = "greatest(0, e0 + e1 * ({q}) + e2 * ({q}) * ({q}))"
_RESERVE = """CASE WHEN reserve_summer IS NOT NULL THEN CASE WHEN month(ts) * 100 + day(ts) BETWEEN 601 AND 1031 THEN reserve_summer ELSE reserve_winter END
  ELSE coalesce(reserve_flow, 0) END"""
_RANKED = "SELECT *, row_number() OVER (PARTITION BY site ORDER BY priority, i) AS rank FROM groups"
# Dispatch written out: at most three groups per record.
_STEP = """SELECT a.*, g{n}.max_flow AS max_{n}, CASE WHEN g{n}.site IS NOT NULL THEN CASE WHEN least(rest_{m}, g{n}.max_flow) < g{n}.arm_flow THEN 0.0::DOUBLE
    ELSE least(rest_{m}, g{n}.max_flow) END END AS used_{n}, greatest(rest_{m} - coalesce(used_{n}, 0), 0) AS rest_{n}
  FROM {src} a LEFT JOIN ranked g{n} ON g{n}.site = a.site AND g{n}.rank = {n}"""


def _dispatch(start: str) -> dict[str, str]:
    return {
        "ranked": _RANKED, "s0": start,
        **{f"s{n}": _STEP.format(n=n, m=n - 1, src=f"s{n - 1}") for n in (1, 2, 3)},
    }


def _power(flow: str) -> str:
    """Sum over the three possible groups; head at total inflow, efficiency at the group's flow."""
    parts = []
    for n in (1, 2, 3):
        x = flow.format(n=n)
        eff = f"greatest(0, g{n}.e0 + g{n}.e1 * ({x}) + g{n}.e2 * ({x}) * ({x}))"
        head = f"greatest(0, CASE WHEN flow <= 20 THEN g{n}.h0a - 0.05 * flow ELSE g{n}.h0b - 0.02 * flow END)"
        parts.append(f"CASE WHEN g{n}.site IS NULL THEN 0 ELSE CASE WHEN g{n}.has_head THEN ({x}) * {eff} / 100 * {head} * 9.81 END END")
    return " + ".join(parts)


_HYDRO = f"""SELECT a.*, coalesce(used_1, 0) + coalesce(used_2, 0) + coalesce(used_3, 0) AS total, {_power('used_{n}')} AS power, {_power('max_{n}')} AS power_max,
   CASE WHEN n_groups = 0 THEN 0 WHEN g1.has_head THEN greatest(0, CASE WHEN flow <= 20 THEN g1.h0a - 0.05 * flow ELSE g1.h0b - 0.02 * flow END) END AS head,
   CASE WHEN n_groups = 0 THEN 0 ELSE greatest(0, g1.e0 + g1.e1 * used_1 + g1.e2 * used_1 * used_1) END AS efficiency
  FROM s3 a LEFT JOIN ranked g1 ON g1.site = a.site AND g1.rank = 1 LEFT JOIN ranked g2 ON g2.site = a.site AND g2.rank = 2
  LEFT JOIN ranked g3 ON g3.site = a.site AND g3.rank = 3"""
_HYDRO_COLS = f"{rr(3, usable='CASE WHEN n_groups = 0 THEN available ELSE total END', reserved='least(flow, reserve)')}, {rr(1, power='power', power_max='power_max')}, {rr(3, head='head')}, {rr(2, efficiency='efficiency')}"

_FORECAST = {
    "shift": "SELECT site, length(site) / 2.0 AS hours FROM basins",
    "known": "SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts DESC) AS back FROM dense WHERE flow IS NOT NULL",
    "anchor": "SELECT site, max(ts) AS last_ts, arg_max(flow, ts) AS last_flow, avg(flow) FILTER (WHERE back <= 24) AS m FROM known GROUP BY site",
    "plant": "SELECT b.site, r.* EXCLUDE (site), r.site AS plant_site FROM basins b JOIN registry r ON r.site_order = length(b.site) * 3",
    # Python and Spark's bround both round half to even.
    "out": """SELECT k.site, k.ts + to_hours(round_even(hours, 0)::INTEGER) AS utc, NULL::DOUBLE AS q_tree, NULL::DOUBLE AS q_sequence, NULL::DOUBLE AS q_stacked,
                k.flow * coalesce(flow_factor, 1) AS q_in, 'observed' AS source
              FROM known k JOIN shift s ON s.site = k.site JOIN plant p ON p.site = k.site WHERE back <= 48
              UNION ALL
              SELECT a.site, a.last_ts + to_hours(lead + round_even(hours, 0)::INTEGER), last_flow, m, (last_flow + m) / 2, (last_flow + m) / 2 * coalesce(flow_factor, 1), 'prediction'
              FROM anchor a JOIN shift s ON s.site = a.site JOIN plant p ON p.site = a.site, LATERAL (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8])::INTEGER AS lead)""",
    # The readings lie in January, one hour ahead of UTC in Paris.
    "fc": "SELECT * EXCLUDE (utc), utc + INTERVAL 1 HOUR AS ts FROM out",
}
_POINTS = """SELECT f.*, q_in AS flow, p.* EXCLUDE (site), f.site AS key_site FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) - 1 AS lead_hours
   FROM fc WHERE ts >= TIMESTAMP '{now}') f JOIN plant p ON p.site = f.site"""

_DISPATCH_POINTS = _dispatch(
    f"SELECT * EXCLUDE (site), plant_site AS site, greatest(flow - reserve, 0) AS available, available AS rest_0 FROM (SELECT *, {_RESERVE} AS reserve FROM ({_POINTS.format(now=NOW)}))"
)

ORACLE = {
    "f05_order_groups": q(
        "SELECT site, min(priority)::INTEGER AS best_priority, string_agg(coalesce(name, '?'), ',' ORDER BY priority, i) AS \"order\" FROM groups GROUP BY site", "groups"),
    "g04_union_observed_forecast": q(f"SELECT site, ts, {same(6, 'q_tree', 'q_sequence', 'q_stacked', 'q_in')}, source FROM fc", "dense", "basins", "registry", extra=_FORECAST),
    "h01_haversine": f"""SELECT c_custkey, {rr(km='''2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - 43.0) / 2), 2) + cos(radians(43.0)) * cos(radians(lat)) * pow(sin(radians(lon - 1.0) / 2), 2)))''')}
        FROM (SELECT c_custkey, (c_custkey % 900) / 10.0::DOUBLE - 45 AS lat, (c_custkey % 1700) / 10.0::DOUBLE - 85 AS lon FROM customer)""",
    "h02_et0": q(f"SELECT site, point, ts, {rr(et0='et0')} FROM wr", "wr"),
    "h03_bv_temperature": q(
        f"SELECT w.site, point, ts, {rr(8, temp='temp_c + 273.15 - 273.15 - (alt_basin - alt) * 0.0065')} FROM weather_raw w JOIN basins b ON b.site = w.site", "weather_raw", "basins"),
    "h04_log_transform": f"SELECT l_orderkey, l_linenumber, {rr(log_q='ln(1 + l_quantity)', back='greatest(0, exp(ln(1 + l_quantity) - 2) - 1)')} FROM lineitem",
    "h05_cyclic_encodings": f"""SELECT event_id, {rr(hour_sin='sin(2 * pi() * hour(ts) / 24)', hour_cos='cos(2 * pi() * hour(ts) / 24)', doy_sin='sin(2 * pi() * dayofyear(ts) / 365)',
        doy_cos='cos(2 * pi() * dayofyear(ts) / 365)', month_sin='sin(2 * pi() * month(ts) / 12)', month_cos='cos(2 * pi() * month(ts) / 12)',
        season_sin='sin(2 * pi() * (dayofyear(ts) - 172) / 365)', season_cos='cos(2 * pi() * (dayofyear(ts) - 172) / 365)')} FROM events""",
    "h06_season_of_month": f"SELECT {SEASON} AS season, count(*) AS n FROM (SELECT o_orderdate AS ts FROM orders) GROUP BY 1",
    "h07_paris_time": """SELECT o_orderkey, ts + CASE WHEN ts >= make_timestamp(year(ts), 3, 31 - (dayofweek(make_date(year(ts), 3, 31)))::INTEGER, 1, 0, 0)
           AND ts < CASE WHEN year(ts) < 1996 THEN make_timestamp(year(ts), 9, 30 - (dayofweek(make_date(year(ts), 9, 30)))::INTEGER, 1, 0, 0)
                    ELSE make_timestamp(year(ts), 10, 31 - (dayofweek(make_date(year(ts), 10, 31)))::INTEGER, 1, 0, 0) END THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS local_ts
        FROM (SELECT o_orderkey, o_orderdate + to_hours((o_orderkey % 24)::INTEGER) AS ts FROM orders)""",
    "h08_parse_dates": "SELECT o_orderkey, date_trunc('hour', CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE date_trunc('day', o_orderdate) END) AS ts FROM orders",
    "h09_polynomial": f"SELECT p_partkey, {rr(y='p_retailprice / 100 - 0.05 * p_size + 0.01 * p_size * p_size')} FROM part",
    "h10_head": q(
        f"""SELECT g.site, l_orderkey, l_linenumber, ts, flow + 0.0 AS flow, (i - 1)::INTEGER AS i, {rr(head='CASE WHEN has_head THEN ' + _HEAD.format(q='flow') + ' END')}
            FROM inflow f JOIN groups g ON g.site = f.site""", "inflow", "groups"),
    "h11_efficiency": q(
        f"SELECT g.site, l_orderkey, l_linenumber, ts, flow, (i - 1)::INTEGER AS i, {rr(efficiency=_EFF.format(q='flow * 2'))} FROM inflow f JOIN groups g ON g.site = f.site", "inflow", "groups"),
    "h12_reserve_flow": q(f"SELECT site, l_orderkey, l_linenumber, ts, flow, {rr(reserve=_RESERVE)} FROM joined", "inflow", "registry", extra=_PLANT),
    "h13_dispatch": q(
        f"""SELECT site, l_orderkey, l_linenumber, ts, flow, 0::INTEGER AS rank, {rr(used='used_1')} FROM s3 WHERE n_groups >= 1
            UNION ALL SELECT site, l_orderkey, l_linenumber, ts, flow, 1, {rr(used='used_2')} FROM s3 WHERE n_groups >= 2
            UNION ALL SELECT site, l_orderkey, l_linenumber, ts, flow, 2, {rr(used='used_3')} FROM s3 WHERE n_groups >= 3""", "inflow", "groups",
        extra={**_PLANT, **_dispatch("SELECT *, flow AS rest_0 FROM joined")}),
    "h14_hydraulic_point": q(
        f"SELECT site, l_orderkey, l_linenumber, ts, flow, {_HYDRO_COLS} FROM ({_HYDRO})", "inflow", "groups",
        extra={**_PLANT, **_dispatch(f"SELECT *, greatest(flow - reserve, 0) AS available, available AS rest_0 FROM (SELECT *, {_RESERVE} AS reserve FROM joined)")}),
    "h15_turbine_time": q(
        f"""SELECT u.site, u.station, u.ts + to_hours(round_even(coalesce(t.hours / 2, 0), 0)::INTEGER) AS turbine_ts, {rr(8, turbine_flow='upstream * 1.2::DOUBLE')}
            FROM (SELECT *, {SEASON} AS season FROM upstream) u LEFT JOIN transit t ON t.site = u.site AND t.station = u.station AND t.season = u.season""", "upstream", "transit"),
    "h17_slug": """SELECT doc_id, md5(x) AS slug_hash, length(x) AS n FROM (SELECT doc_id,
        regexp_replace(translate(lower(text), 'àâäéèêëîïôöùûüç ', 'aaaeeeeiioouuuc_'), '[^\\p{L}\\p{N}_]', '', 'g') AS x FROM documents)""",
    "h18_normalize": """SELECT doc_id, md5(x) AS folded_hash, length(x) AS n FROM (SELECT doc_id, regexp_replace(strip_accents(lower(text)), '[^\\x00-\\x7F]', '', 'g') AS x FROM documents)""",
    "h21_bv_params": q(f"SELECT site, {same(6, 'alt_basin', 'surface_km2', 'k_base', 'exposition', 'kc_unit')} FROM basins", "basins"),
    "h22_kelvin_and_cumulate": q(f"SELECT site, point, ts, {same(8, 'lat', 'lon', 'alt', 'precip_cum_mm', 'temp_k')} FROM weather_norm", "weather_norm"),
    "j04_sql_functions": f"""SELECT o_orderkey, {SEASON} AS season, {rr(km='''2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - 43.0) / 2), 2) + cos(radians(43.0)) * cos(radians(lat)) * pow(sin(radians(lon - 1.0) / 2), 2)))''',
        y='1 + 0.5 * x - 0.01 * x * x')} FROM (SELECT o_orderkey, o_orderdate AS ts, (o_custkey % 90)::DOUBLE AS lat, (o_custkey % 180)::DOUBLE AS lon, (o_orderkey % 40)::DOUBLE AS x FROM orders)""",
    "a13_forecast_points": q(
        f"SELECT key_site AS site, ts, lead_hours::INTEGER AS lead_hours, source, {rr(flow='flow')}, {_HYDRO_COLS} FROM ({_HYDRO})", "dense", "basins", "groups",
        extra={**_FORECAST, **_DISPATCH_POINTS}),
}
