"""Sources and sinks: each query writes landing or store files from the driver's tables and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermill.operators import evaluate as ev
from rivermill.operators import forecast as fc
from rivermill.plans import tables as t
from rivermill.plans.oracle import kge_sql, same
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.shape import rounded
from rivermill.plans.turbine_queries import _DISPATCH_POINTS, _FORECAST, _HYDRO, _HYDRO_COLS, _forecast_rows
from rivermill.session import fresh_path
from rivermill.sources import flow as fl
from rivermill.sources import registry as rg
from rivermill.sources import tables as st
from rivermill.sources import weather as wx

NOW = "2024-01-30 20:00:00"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
PAGE = 500


def _station_hours(s, d):
    flow = F.when(F.hour("ts") % 5 != 0, F.col("flow"))
    means = t.readings(s, d).groupBy("station", F.date_trunc("hour", "ts").alias("ts")).agg((F.avg("flow") / 7).alias("flow"))
    return means.withColumn("flow", flow)


def a01(s, d):
    path = fresh_path(s, "flow-csv")
    fl.write_flow_csv(_station_hours(s, d), path)
    return rounded(fl.read_flow_csv(s, path), 3)


def a02(s, d):
    path = fresh_path(s, "prepared")
    st.write_prepared(t.dense_hourly(s, d), path)
    return rounded(st.read_prepared(s, path, ["click", "view"]))


def a03(s, d):
    path = fresh_path(s, "prepared-csv")
    frame = t.dense_hourly(s, d).select("ts", "flow", (F.col("flow") / 3).alias("third"), "site")
    st.export_csv(frame, path)
    back = st.import_csv(s, path, "ts TIMESTAMP, flow DOUBLE, third DOUBLE, site STRING")
    return rounded(back.groupBy("site").agg(F.count(F.lit(1)).alias("n_rows"), F.count("flow").alias("n_flow"), F.sum("third").alias("third")), 2)


def a04(s, d):
    path = fresh_path(s, "flow-append")
    hours = _station_hours(s, d)
    cut = F.lit("2024-01-15").cast("timestamp")
    fl.write_flow_csv(hours.where(F.col("ts") < cut), path)
    fl.write_flow_csv(hours.where(F.col("ts") >= cut), path, mode="append")
    back = fl.read_flow_csv(s, path)
    return back.groupBy("station").agg(F.count(F.lit(1)).alias("n_rows"), F.count("flow").alias("n_flow"), F.max("ts").alias("last_ts"))


def a05(s, d):
    """Pages of at most 500 readings per station."""
    obs = t.readings(s, d).select(
        "station", F.floor(F.col("event_id") / PAGE).alias("page"),
        F.struct(F.date_format("ts", ISO).alias("date_obs"), (F.col("flow") * 1000).alias("resultat_obs")).alias("o"))
    pages = obs.groupBy("station", "page").agg(F.collect_list("o").alias("data"))
    path = fresh_path(s, "pages")
    pages.withColumn("next", F.concat(F.lit("page="), F.col("page") + 1)).drop("page").write.json(path)
    return rounded(fl.read_observation_pages(s, path).select("station", "ts", (F.col("litres") / 1000).alias("flow")))


def a06(s, d):
    wanted = t.nation_orders(s, d).groupBy("station").agg(F.min("ts").cast("date").alias("start_day"), F.max("ts").cast("date").alias("end_day"))
    chunks = fl.range_chunks(wanted)
    day = t.nation_orders(s, d).select("station", F.to_date("ts").alias("day"), "flow")
    first = wanted.select("station", "start_day")
    at = day.join(first, "station").withColumn("chunk", F.floor(F.datediff("day", "start_day") / fl.CHUNK_DAYS).cast("int"))
    sums = at.groupBy("station", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("day").alias("lo"), F.max("day").alias("hi"))
    inside = chunks.join(sums, ["station", "chunk"])
    return inside.select(
        "station", "chunk", F.col("from_day").cast("timestamp").alias("from_ts"), F.col("to_day").cast("timestamp").alias("to_ts"), "n",
        ((F.col("lo") >= F.col("from_day")) & (F.col("hi") <= F.col("to_day"))).alias("within"))


def a07(s, d):
    point = F.struct(F.date_format("ts", ISO).alias("t"), (F.col("flow") * 1000).alias("v"))
    docs = t.readings(s, d).groupBy("station", F.floor(F.col("event_id") / PAGE).alias("page")).agg(F.collect_list(point).alias("data"))
    empty = docs.select("station").distinct().select("station", F.lit(None).cast("struct<data:array<struct<t:string,v:double>>>").alias("series"))
    path = fresh_path(s, "series")
    docs.select("station", F.struct("data").alias("series")).unionByName(empty).write.json(path)
    return rounded(fl.read_series(s, path))


def a08(s, d):
    """One payload per point and week; every fifth hour has a missing value."""
    raw = t.weather_raw(s, d)
    hour = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.when(F.hour("ts") % 5 != 0, F.col("temp_c")).alias("temperature_2m"), F.col("precip_mm").alias("precipitation"))
    docs = raw.groupBy("site", "point", F.date_trunc("week", "ts").alias("week")).agg(
        F.first("lat").alias("latitude"), F.first("lon").alias("longitude"), F.first("alt").alias("elevation"), F.collect_list(hour).alias("h"))
    docs = docs.select("site", "point", "latitude", "longitude", "elevation", F.struct(
        F.col("h.time").alias("time"), F.col("h.temperature_2m").alias("temperature_2m"), F.col("h.precipitation").alias("precipitation")).alias("hourly"))
    path = fresh_path(s, "weather-json")
    docs.write.option("ignoreNullFields", False).json(path)
    return rounded(wx.read_weather(s, path))


def a09(s, d):
    row = F.struct(
        F.concat(F.lit("ST"), F.col("s_suppkey")).alias("code_station"), (F.col("s_suppkey") % 90).cast("double").alias("latitude_station"),
        (F.col("s_suppkey") % 180).cast("double").alias("longitude_station"), F.col("s_acctbal").alias("altitude_ref_alti_station"))
    docs = t.table(s, d, "supplier").groupBy(F.floor(F.col("s_suppkey") / 100).alias("page")).agg(F.collect_list(row).alias("data"))
    path = fresh_path(s, "stations")
    docs.select("data").write.json(path)
    wanted = t.table(s, d, "part").select(F.concat(F.lit("ST"), F.col("p_partkey") % 150).alias("station"))
    return rg.station_places(rg.read_stations(s, path), wanted)


def _site_documents(s, d):
    reg = t.registry(s, d)

    def group(g):
        return F.struct(
            g["name"].alias("nom_groupe"), g["priority"].alias("priorite"), g["arm_flow"].alias("debit_armement_turbine"),
            g["max_flow"].alias("debit_max"), g["efficiency"].alias("rendement"),
            F.to_json(F.transform(g["head"], lambda h: h["coeffs"])).alias("chute_disponible_polynome"),
            F.transform(g["head"], lambda h: F.array(h["q_min"], h["q_max"])).alias("chute_disponible_seuils"))

    summer = F.when(F.col("summer_from").isNotNull(), F.array(
        F.array(F.floor(F.col("summer_from") / 100).cast("int"), F.col("summer_from") % 100),
        F.array(F.floor(F.col("summer_to") / 100).cast("int"), F.col("summer_to") % 100)))
    return reg.select(
        F.col("site").alias("dossier"), F.col("plant").alias("centrale"), F.col("strategy").alias("flex_strategy"),
        F.col("flow_factor").alias("facteur_debit"), F.col("ref_station").alias("station_vigicrue_reference"),
        F.col("upstream_stations").alias("stations_vigicrue_amont"), F.col("reserve_flow").alias("debit_non_turbinable"),
        F.col("reserve_summer").alias("q_non_turbinable_ete"), F.col("reserve_winter").alias("q_non_turbinable_hiver"),
        summer.alias("periode_ete"), F.transform("groups", group).alias("groupes"))


def a10(s, d):
    path = fresh_path(s, "registry")
    _site_documents(s, d).write.json(path)
    sites = rg.read_sites(s, path, multi_line=False)
    g = sites.select("site", "strategy", "summer_from", F.posexplode("groups").alias("i", "g"))
    return rounded(g.select(
        "site", "strategy", "summer_from", "i", F.col("g.name").alias("name"), F.col("g.arm_flow").alias("arm_flow"), F.col("g.max_flow").alias("max_flow"),
        F.size("g.head").cast("long").alias("segments"), F.col("g.head")[1]["q_max"].alias("q_max_2"), F.col("g.head")[1]["coeffs"][0].alias("c_2")))


def a11(s, d):
    watersheds = t.table(s, d, "supplier").select(
        F.concat(F.lit("P"), F.col("s_suppkey") * 3).alias("dossier"),
        F.struct(F.col("s_acctbal").alias("altitude_moyenne_m"), F.lit(100.0).alias("surface_km2")).alias("bassin_versant"))
    path = fresh_path(s, "watersheds")
    watersheds.write.json(path)
    return rg.discover_sites(t.registry(s, d), rg.read_watersheds(s, path, multi_line=False)).select("site", "plant")


def _written_forecast(s, d):
    path = fresh_path(s, "forecast")
    table = _forecast_rows(s, d)
    st.write_forecast(table, path, "2024-01-30")
    st.write_forecast(table.withColumn("q_in", F.col("q_in") + 1), path, "2024-01-31")
    return s.read.parquet(path)


def a12(s, d):
    rows = _written_forecast(s, d)
    return rounded(rows.select("site", "ts", "q_stacked", "q_in", "source", F.date_format(F.col("run_date").cast("date"), "yyyy-MM-dd").alias("run_date")))


def _documents(s, d):
    return fc.forecast_documents(_forecast_rows(s, d), t.plants(s, d), NOW)


def a13(s, d):
    path = fresh_path(s, "documents")
    docs = _documents(s, d)
    st.write_documents(docs, path)
    back = s.read.schema(docs.schema).json(path)
    rows = back.select("site", F.explode("points").alias("p"))
    return rounded(rows.select("site", "p.lead_hours", "p.target_datetime", "p.flow.inflow", "p.flow.usable", "p.power"))


def a14(s, d):
    path = fresh_path(s, "archive")
    docs = _documents(s, d)
    st.archive_documents(docs, path, "2024-02-01 00:20:00")
    st.archive_documents(docs, path, "2024-02-01 00:20:00")  # a retry doubles nothing
    st.archive_documents(docs.where(F.col("site") == "view"), path, "2024-02-01 01:20:00")
    back = s.read.schema(docs.schema.add("issued_at", "timestamp").add("year", "string").add("month", "string").add("day", "string").add("hour", "string")).json(path)
    return back.select("site", "year", "month", "day", "issued_at", F.size("points").cast("long").alias("n_points"))


def a15(s, d):
    path = fresh_path(s, "test-predictions")
    wide = t.scored(s, d).groupBy("site", "ts", "lead").agg(
        F.first("y").alias("q_observed"),
        F.max(F.when(F.col("model") == "persistence", F.col("p"))).alias("q_persistence"),
        F.max(F.when(F.col("model") == "day_mean", F.col("p"))).alias("q_day_mean"))
    st.write_test_predictions(wide, path)
    return rounded(s.read.parquet(path), 9)


def _models(s, d):
    sc = ev.score(t.scored(s, d), ["site", "model", "lead"])
    return sc.select("site", F.col("lead").alias("horizon"), F.when(F.col("model") == "persistence", 1).otherwise(2).alias("version"), "kge")


def a16(s, d):
    return rounded(fc.served_models(_models(s, d)))


def a17(s, d):
    return rounded(fc.lookup_forecast(_written_forecast(s, d), _models(s, d), "click"))


QUERIES = {
    "a01_scan_flow_csv": a01, "a02_scan_prepared": a02, "a03_sink_prepared": a03, "a04_sink_flow_csv": a04, "a05_ingest_obs_pages": a05,
    "a06_ingest_series_chunks": a06, "a07_ingest_series_points": a07, "a08_ingest_weather_json": a08, "a09_station_referential": a09,
    "a10_scan_site_registry": a10, "a11_discover_sites": a11, "a12_sink_forecast_table": a12, "a13_sink_forecast_doc": a13,
    "a14_archive_forecasts": a14, "a15_sink_test_predictions": a15, "a16_registry_read": a16, "a17_lookup_forecast": a17,
}

_HOURS = {"sh": "SELECT station, date_trunc('hour', ts) AS ts, CASE WHEN hour(ts) % 5 <> 0 THEN flow / 7 END AS flow FROM (SELECT station, date_trunc('hour', ts) AS ts, avg(flow) AS flow FROM readings GROUP BY 1, 2)"}

ORACLE = {
    "a01_scan_flow_csv": q(f"SELECT station, ts, {rr(3, flow='flow')} FROM sh", "readings", extra=_HOURS),
    "a02_scan_prepared": q(f"SELECT site, ts, {rr(flow='flow')} FROM dense WHERE site IN ('click', 'view')", "dense"),
    "a03_sink_prepared": q(f"SELECT site, count(*) AS n_rows, count(flow) AS n_flow, {rr(2, third='sum(round(flow / 3, 3))')} FROM dense GROUP BY site", "dense"),
    "a04_sink_flow_csv": q("SELECT station, count(*) AS n_rows, count(flow) AS n_flow, max(ts) AS last_ts FROM sh GROUP BY 1", "readings", extra=_HOURS),
    "a05_ingest_obs_pages": q(f"SELECT station, ts, {rr(flow='flow')} FROM readings", "readings"),
    "a06_ingest_series_chunks": q(
        """SELECT station, chunk::INTEGER AS chunk, s + to_days(chunk::INTEGER * 180) AS from_ts, least(s + to_days(chunk::INTEGER * 180 + 179), e) AS to_ts, count(*) AS n, true AS within
           FROM (SELECT o.station, x.s, x.e, date_diff('day', x.s, o.ts) // 180 AS chunk FROM nation_orders o
                 JOIN (SELECT station, min(ts) AS s, max(ts) AS e FROM nation_orders GROUP BY 1) x ON x.station = o.station) GROUP BY station, chunk, s, e""", "nation_orders"),
    "a07_ingest_series_points": q(f"SELECT station, ts, {rr(3, flow='flow')} FROM readings", "readings"),
    "a08_ingest_weather_json": q(f"SELECT site, point, ts, {same(6, 'lat', 'lon', 'alt', 'temp_c', 'precip_mm')} FROM weather_raw WHERE hour(ts) % 5 <> 0", "weather_raw"),
    "a09_station_referential": """SELECT DISTINCT 'ST' || s_suppkey AS station, (s_suppkey % 90)::DOUBLE AS lat, (s_suppkey % 180)::DOUBLE AS lon, s_acctbal AS alt
        FROM supplier JOIN part ON p_partkey % 150 = s_suppkey""",
    "a10_scan_site_registry": q(
        f"""SELECT g.site, strategy, CASE WHEN reserve_summer IS NOT NULL THEN 601 END AS summer_from, (i - 1)::INTEGER AS i, name, {same(6, 'arm_flow', 'max_flow')},
              CASE WHEN has_head THEN 2 END::BIGINT AS segments, CASE WHEN has_head THEN 40.0::DOUBLE END AS q_max_2, {rr(c_2='CASE WHEN has_head THEN h0b END')}
            FROM groups g JOIN registry r ON r.site = g.site""", "groups"),
    "a11_discover_sites": q("SELECT site, plant FROM registry WHERE site IN (SELECT 'P' || (s_suppkey * 3) FROM supplier)", "registry"),
    "a12_sink_forecast_table": q(
        f"""SELECT site, ts, {same(6, 'q_stacked', 'q_in')}, source, '2024-01-30' AS run_date FROM fc
            UNION ALL SELECT site, ts, {rr(q_stacked='q_stacked', q_in='q_in + 1')}, source, '2024-01-31' FROM fc""", "dense", "basins", "registry", extra=_FORECAST),
    "a13_sink_forecast_doc": q(
        f"SELECT site, lead_hours, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS target_datetime, {rr(3, inflow='flow')}, usable, power FROM (SELECT key_site AS site, ts, lead_hours::INTEGER AS lead_hours, flow, {_HYDRO_COLS} FROM ({_HYDRO}))",
        "dense", "basins", "groups", extra={**_FORECAST, **_DISPATCH_POINTS}),
    "a14_archive_forecasts": q(
        f"""SELECT p.site, '2024' AS year, CASE WHEN h = 23 THEN '01' ELSE '02' END AS month, CASE WHEN h = 23 THEN '31' ELSE '01' END AS day,
              CASE WHEN h = 23 THEN TIMESTAMP '2024-01-31 23:20:00' ELSE TIMESTAMP '2024-02-01 00:20:00' END AS issued_at, n AS n_points
            FROM (SELECT site, count(*) AS n FROM fc WHERE ts >= TIMESTAMP '{NOW}' GROUP BY site) p, LATERAL (SELECT unnest([23, 0]) AS h) WHERE h = 23 OR p.site = 'view'""",
        "dense", "basins", "registry", extra=_FORECAST),
    "a15_sink_test_predictions": q(f"SELECT site, ts, lead, {rr(9, q_observed='y', q_persistence='persistence', q_day_mean='day_mean')} FROM forecasts", "forecasts"),
    "a16_registry_read": q(f"SELECT site, lead AS horizon, 2 AS version, {rr(kge=kge_sql()['kge'])} FROM pairs WHERE model = 'day_mean' GROUP BY 1, 2", "pairs"),
    "a17_lookup_forecast": q(f"SELECT site, ts, {rr(q_stacked='q_stacked', q_in='q_in + 1')} FROM fc WHERE site = 'click' AND source = 'prediction'", "dense", "basins", "registry", extra=_FORECAST),
}
