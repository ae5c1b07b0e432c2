"""Filters, joins, set operations, bucket aggregates and quality checks on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermill.functions.blocks import diff
from rivermill.operators import forecast as fc
from rivermill.operators import prepare as pr
from rivermill.operators import quality as ql
from rivermill.operators import splits as sp
from rivermill.operators import turbine as tb
from rivermill.operators import upstream as us
from rivermill.plans import tables as t
from rivermill.plans.oracle import SEASON, kge_sql, same
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.shape import rounded

START, END = "2024-01-08 00:00:00", "2024-01-20 12:00:00"
NOW = "2024-01-30 20:00:00"


def _early(df, keep: bool):
    """Stored part (before the 20th) and new part of the readings."""
    limit = F.lit("2024-01-20").cast("timestamp")
    return df.where(F.col("ts") < limit) if keep else df.where(F.col("ts") >= limit)


def b01(s, d):
    return rounded(pr.time_range(t.dense_hourly(s, d), START, END))


def b02_live(s, d):
    return rounded(pr.live_window(t.dense_hourly(s, d), "2024-01-20 00:00:00", t.H, 5))


def b02_frozen(s, d):
    return rounded(pr.last_days(t.daily(s, d), 90))


def b03(s, d):
    weather = t.weather_raw(s, d).where(F.col("point") == 1).select("site", "ts", "temp_c")
    return rounded(pr.from_first_flow(weather, _early(t.hourly(s, d), False), START))


def b04(s, d):
    return pr.default_strategy(t.registry(s, d)).select("site", "strategy", "ref_station")


def b05(s, d):
    return rounded(sp.split_train_test(t.hourly(s, d), t.HOURLY).select("site", "ts", "flow", "rn", "role"))


def b06(s, d):
    return rounded(sp.split_fit_val_test(t.hourly(s, d), t.HOURLY).select("site", "ts", "flow", "rn", "role"))


def b07(s, d):
    folds = sp.time_series_folds(t.hourly(s, d), t.HOURLY, 5, t.H)
    return folds.select("site", "ts", "rn", "fold", "role")


def b08(s, d):
    return rounded(sp.split_reference_current(t.dense_hourly(s, d), 7))


def _lagged(s, d):
    ax = t.HOURLY
    split = ax.split(t.dense_hourly(s, d), back=8)
    w = ax.window()
    return ax.core(
        split.withColumns({"lag_8": F.lag("flow", 8).over(w), "change_3": diff(F.col("flow"), w, 3)})
    )


def b09(s, d):
    return rounded(sp.drop_incomplete(_lagged(s, d), ["lag_8", "change_3"]))


def b10(s, d):
    return rounded(sp.keep_tail(_lagged(s, d), ["lag_8", "change_3"], t.H, t.HOURLY))


def b11(s, d):
    from rivermill.operators.sequences import sequence_stations

    return sequence_stations(t.daily_upstream(s, d), t.transit(s, d), t.H)


def b12(s, d):
    tail = pr.tail_rows(t.dense_hourly(s, d), 48)
    return rounded(sp.from_now(tail, NOW))


def _attempts(s, d):
    return t.table(s, d, "nation").join(
        t.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).where(F.col("n_nationkey") % 2 == 0).select(
        F.col("r_name").alias("site"),
        F.expr("timestamp'2001-07-01' + make_interval(0, 0, 0, n_nationkey)").alias("attempt_ts"),
    )


def b13(s, d):
    models = t.table(s, d, "region").where(F.col("r_regionkey") > 0).select(F.col("r_name").alias("site"))
    spans = pr.history_span(t.nation_orders(s, d))
    return fc.training_eligibility(spans, models, _attempts(s, d), "2001-07-29 12:00:00")


def b14(s, d):
    return tb.missing_fields(t.registry(s, d)).select(
        "site", F.array_join("missing", ",").alias("missing"), F.size("missing").cast("long").alias("n_missing")
    )


def b15(s, d):
    known = t.table(s, d, "supplier").select(F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("site"))
    pending = t.registry(s, d).join(known, "site", "left_anti")
    return tb.missing_fields(pending).where(F.size("missing") > 0).select("site", F.array_join("missing", ",").alias("missing"))


def c01(s, d):
    per_station = t.readings(s, d).groupBy("site", "station", F.date_trunc("hour", "ts").alias("ts")).agg(
        F.avg("flow").alias("q")
    )
    def station(i, name):
        return per_station.where(F.col("station").endswith(f"-{i}")).select("site", "ts", F.col("q").alias(name))
    return rounded(pr.align_sources([station(0, "flow"), station(1, "upstream_1"), station(2, "upstream_2")], ["site", "ts"]))


def _station_flow(s, d):
    return t.table(s, d, "lineitem").groupBy(
        F.concat(F.lit("ST"), (F.col("l_suppkey") % 50).cast("string")).alias("station")
    ).agg(F.avg("l_quantity").alias("flow"), F.count(F.lit(1)).alias("n"))


def c02(s, d):
    return rounded(pr.upstream_flow(t.registry(s, d), _station_flow(s, d)))


def c03(s, d):
    return rounded(pr.reference_flow(t.registry(s, d), _station_flow(s, d)))


def c04(s, d):
    return rounded(us.seasonal_shift(t.daily_upstream(s, d), t.transit(s, d), t.STATIONS_DAILY, t.H), 8)


def c05(s, d):
    frame = t.dense_hourly(s, d)
    preds = sp.drop_incomplete(_lagged(s, d), ["lag_8", "change_3"]).select(
        "site", "ts", (F.col("lag_8") + F.col("change_3") / 2).alias("prediction")
    )
    return rounded(frame.join(preds, ["site", "ts"], "left"))


def _new_batch(s, d):
    return _early(t.hourly(s, d), False).select("site", "ts", (F.col("flow") * 2).alias("flow"), (F.col("flow") / 10).alias("temp"))


def _overlapping(s, d):
    return t.hourly(s, d).where(F.col("ts") < F.lit("2024-01-22").cast("timestamp"))


def c06(s, d):
    return rounded(pr.replace_on_key(_overlapping(s, d), _new_batch(s, d), ["site", "ts"]))


def c07(s, d):
    points = t.readings(s, d).select("station", "ts", "flow", "event_id")
    stored = _early(points.where(F.col("event_id") % 2 == 0), True)
    return pr.newer_points(points, stored)


def _folders(s, d):
    k = F.col("s_suppkey")
    return t.table(s, d, "supplier").select(
        F.concat(F.lit("Site_"), F.array(F.lit("Hot"), F.lit("Large"), F.lit("Red"), F.lit("Small"))[(k % 4).cast("int")],
                 F.lit(" "), k.cast("string"), F.lit("_G"), (k % 3 + 1).cast("string")).alias("folder")
    )


def _mapping(s, d):
    k = F.col("p_partkey")
    return t.table(s, d, "part").where(k % 29 == 0).select(
        F.concat(F.lit("P"), k.cast("string")).alias("site"),
        F.concat(F.lit("Site_Hot "), (k % 200).cast("string"), F.lit("_G"), (k % 200 % 3 + 1).cast("string")).alias("mapped"),
    )


def c08(s, d):
    return tb.match_folders(t.registry(s, d), _folders(s, d), _mapping(s, d))


def c09(s, d):
    sites = t.readings(s, d).groupBy("station").agg(F.max("point").alias("n_points")).select(
        F.col("station").alias("site"), (F.col("n_points") - 1).alias("n_points")
    )
    weather = t.readings(s, d).where(F.col("event_id") % 3 == 0).select(F.col("station").alias("site"), "ts")
    return pr.missing_weather(sites, weather, "2024-01-15 10:00:00", 1, 2).select("site")


def c10(s, d):
    from rivermill.operators.evaluate import compare_models

    sc = t.scored(s, d).where(F.col("lead") == t.H)
    production = sc.where((F.col("model") == "persistence") & (F.col("site") != "view"))
    return rounded(compare_models(sc.where(F.col("model") == "day_mean"), production))


def c11(s, d):
    rows = t.nation_orders(s, d).select("site", "station", "ts")
    return us.transit_hours(rows, t.transit(s, d), t.H).groupBy("site", "station", "season", "hours").agg(F.count(F.lit(1)).alias("n"))


def d01(s, d):
    return rounded(t.hourly(s, d))


def d02(s, d):
    obs = t.readings(s, d).select("station", "ts", (F.col("flow") * 1000).alias("litres"))
    stored = _early(obs, True).select("station", F.date_trunc("hour", "ts").alias("ts"))
    return rounded(pr.closed_hours(obs, stored))


def d03(s, d):
    return rounded(pr.history_span(t.readings(s, d)))


def _sources(s, d):
    src = F.when(F.col("event_id") % 2 == 0, "archive").otherwise("live")
    return t.readings(s, d).select("station", src.alias("source"), F.date_trunc("day", "ts").alias("ts"))


def d18(s, d):
    return pr.latest_source(_sources(s, d), "archive")


def d19(s, d):
    return pr.last_stored(t.readings(s, d).select("station", "ts"))


def d21(s, d):
    return pr.distinct_stations(t.registry(s, d)).withColumn("position", F.col("position").cast("long"))


def f01(s, d):
    return rounded(pr.tail_rows(t.dense_hourly(s, d), 48, until="2024-01-29 12:00:00"))


def f03(s, d):
    from pyspark.sql import Window

    w = Window.partitionBy("site").orderBy(F.desc("flow"), "ts")
    rows = t.hourly(s, d).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 5)
    return rounded(rows)


def f04(s, d):
    return rounded(pr.last_observed(t.dense_hourly(s, d)))


def f06(s, d):
    late = F.when(F.col("ts") >= F.lit("2024-01-02").cast("timestamp"), F.col("lat") + F.col("temp_c"))
    return rounded(pr.first_valid(t.weather_raw(s, d).withColumn("seen", late), "seen", ["site", "point"]))


def g01(s, d):
    raw = t.weather_raw(s, d).select("site", "point", "ts", "temp_c", "precip_mm")
    forecast = _early(raw, False).select(
        "site", "point", "ts", F.when(F.hour("ts") % 3 != 0, F.col("temp_c") + 1).alias("temp_c"), "precip_mm"
    )
    return rounded(pr.union_prefer_last(raw, forecast, ["site", "point", "ts"], ["temp_c", "precip_mm"]))


def g02(s, d):
    once = pr.replace_on_key(_overlapping(s, d), _new_batch(s, d), ["site", "ts"])
    twice = pr.replace_on_key(once, _new_batch(s, d), ["site", "ts"])
    return rounded(twice.groupBy("site").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("flow").alias("flow"), F.count("temp").alias("n_temp")))


def g03(s, d):
    points = t.readings(s, d).select("station", "ts", "flow", "event_id")
    stored = _early(points, True)
    late = points.where(F.col("ts") >= F.lit("2024-01-18").cast("timestamp"))
    return pr.append_points(late, stored)


def _uses(s, d):
    return pr.distinct_stations(t.registry(s, d)).join(t.registry(s, d).select("site", "site_order"), "site").select("site", "site_order", "station")


def g06(s, d):
    existing = t.table(s, d, "supplier").where((F.col("s_suppkey") < 50) & (F.col("s_suppkey") % 2 == 0)).select(
        F.concat(F.lit("ST"), F.col("s_suppkey").cast("string")).alias("station"),
        F.concat(F.lit("P"), (F.col("s_suppkey") + 50).cast("string")).alias("owner"),
    )
    return pr.station_owner(_uses(s, d), existing)


def w01(s, d):
    return rounded(t.dense_hourly(s, d))


def _stored_rows(s, d):
    """Readings as stored rows: some negative, some missing, some moved back in time, some doubled."""
    ts = F.when(F.col("event_id") % 97 == 0, F.col("ts") - F.make_interval(hours=F.lit(3))).otherwise(F.col("ts"))
    flow = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 501 == 0, -F.col("flow")).otherwise(F.col("flow"))
    cut = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-14").cast("timestamp")
    return (
        t.readings(s, d)
        .where(~((F.col("site") == "view") & F.col("ts").between(*cut)))
        .select("site", F.col("event_id").alias("seq"), F.date_trunc("minute", ts).alias("ts"), flow.alias("flow"),
                F.when(F.col("site") != "error", F.col("flow")).alias("temp"))
    )


def l01(s, d):
    facts = ql.contract_facts(_stored_rows(s, d), others=("temp",), block=5000)
    return rounded(facts.select("site", "n_rows", "n_target", "n_unsorted", "n_duplicates", "n_negative"))


def l02(s, d):
    facts = ql.contract_facts(_stored_rows(s, d), others=("temp",), block=5000)
    return rounded(facts.select("site", "missing_share", "span_days", "n_gaps", "max_gap_hours", "n_dead_columns"))


def l03(s, d):
    rep = ql.contract_report(_stored_rows(s, d), strict=True, others=("temp",))
    return rep.select("site", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "ok")


def l04(s, d):
    sites = t.readings(s, d).select("site").distinct().unionByName(
        t.table(s, d, "region").select(F.col("r_name").alias("site"))
    )
    rep = ql.contract_report(_stored_rows(s, d), sites=sites, others=("temp",))
    return rep.select("site", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "ok")


QUERIES = {
    "b01_time_range_filter": b01, "b02_live_window": b02_live, "b02_frozen_window": b02_frozen,
    "b03_raise_start_to_first_flow": b03, "b04_strategy_filter": b04, "b05_split_train_test": b05,
    "b06_split_fit_val_test": b06, "b07_time_series_folds": b07, "b08_split_reference_current": b08,
    "b09_drop_incomplete_rows": b09, "b10_keep_future_tail": b10, "b11_select_seq_cols": b11,
    "b12_truncate_from_now": b12, "b13_training_eligibility": b13, "b14_required_fields": b14,
    "b15_pending_onboarding": b15, "c01_align_sources": c01, "c02_upstream_lookup": c02,
    "c03_reference_lookup": c03, "c04_seasonal_transit_join": c04, "c05_prediction_realign": c05,
    "c06_replace_on_key": c06, "c07_highwater_join": c07, "c08_source_folder_match": c08,
    "c09_missing_weather": c09, "c10_candidate_vs_production": c10, "c11_season_transit_lookup": c11,
    "d01_hourly_mean": d01, "d02_hourly_mean_closed": d02, "d03_history_span": d03, "d18_latest_obs": d18,
    "d19_last_stored_ts": d19, "d21_distinct_stations": d21, "f01_tail_n": f01, "f03_top_flood_peaks": f03,
    "f04_last_observed": f04, "f06_first_valid": f06, "g01_union_keep_last": g01, "g02_upsert_history": g02,
    "g03_append_points": g03, "g06_station_dedup": g06, "w01_densify_hourly": w01, "l01_contract_errors": l01,
    "l02_contract_warnings": l02, "l03_contract_strict": l03, "l04_contract_report": l04,
}

_NUMBERED = {
    "numbered": """SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn, count(*) OVER (PARTITION BY site) AS n FROM hourly"""
}
_LAGGED = {
    "lagged": """SELECT site, ts, flow, lag(flow, 8) OVER w AS lag_8, flow - lag(flow, 3) OVER w AS change_3
                 FROM dense WINDOW w AS (PARTITION BY site ORDER BY ts)"""
}
_MISSING = """array_to_string(list_filter([
  CASE WHEN strategy <> 'DEFAULT' THEN 'strategy' END,
  CASE WHEN strategy = 'DEFAULT' AND ref_station IS NULL THEN 'ref_station' END,
  CASE WHEN strategy = 'DEFAULT' AND upstream_stations IS NULL THEN 'upstream_stations' END,
  CASE WHEN flow_factor IS NULL THEN 'flow_factor' END,
  CASE WHEN n_groups = 0 THEN 'groups' END], lambda x: x IS NOT NULL) || coalesce(g.fields, []), ',')"""
_GROUP_FIELDS = {
    "per_group": """SELECT site, i, unnest(list_filter([
          CASE WHEN arm_flow IS NULL THEN 'groups[' || coalesce(name, '?') || '].arm_flow' END,
          CASE WHEN NOT has_head THEN 'groups[' || coalesce(name, '?') || '].head' END], lambda x: x IS NOT NULL)) AS field FROM groups""",
    "g": "SELECT site, list(field ORDER BY i, field) AS fields FROM per_group GROUP BY site",
}
_STORED = {
    "stored": """SELECT site, event_id AS seq,
       date_trunc('minute', CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 3 HOUR ELSE ts END) AS ts,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 501 = 0 THEN -flow ELSE flow END AS flow,
       CASE WHEN site <> 'error' THEN flow END AS temp
     FROM readings WHERE NOT (site = 'view' AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-14')""",
    "prev": "SELECT *, lag(ts) OVER (PARTITION BY site ORDER BY seq) AS previous FROM stored",
    "facts": """SELECT site, count(*) AS n_rows, count(flow) AS n_target,
       count(*) FILTER (WHERE ts < previous) AS n_unsorted, count(*) - count(DISTINCT ts) AS n_duplicates,
       count(*) FILTER (WHERE flow < 0) AS n_negative, 1 - count(flow) / count(*)::DOUBLE AS missing_share,
       epoch(max(ts) - min(ts)) / 86400 AS span_days,
       count(*) FILTER (WHERE ts - previous > INTERVAL 24 HOUR) AS n_gaps,
       max(CASE WHEN ts - previous > INTERVAL 24 HOUR THEN epoch(ts - previous) / 3600 END) AS max_gap_hours,
       CASE WHEN count(temp) = 0 THEN 1 ELSE 0 END::BIGINT AS n_dead_columns FROM prev GROUP BY site""",
}
_ERR = """[CASE WHEN n_rows = 0 THEN 'empty' END, CASE WHEN n_unsorted > 0 THEN 'not_sorted' END, CASE WHEN n_duplicates > 0 THEN 'duplicate_ts' END,
  CASE WHEN n_target = 0 THEN 'target_all_missing' END, CASE WHEN n_negative > 0 THEN 'negative_flow' END]"""
_WARN = """[CASE WHEN missing_share > 0.1 THEN 'missing_target' END, CASE WHEN span_days < 180 THEN 'short_history' END,
  CASE WHEN n_gaps > 0 THEN 'long_gaps' END, CASE WHEN n_dead_columns > 0 THEN 'dead_columns' END]"""


def _clean(listed: str) -> str:
    return f"array_to_string(list_filter({listed}, lambda x: x IS NOT NULL), ',')"


_NEW = "SELECT site, ts, flow * 2 AS flow, flow / 10 AS temp FROM hourly WHERE ts >= TIMESTAMP '2024-01-20'"
_UPSERT = {
    "fresh": _NEW,
    "old": "SELECT * FROM hourly WHERE ts < TIMESTAMP '2024-01-22'",
    "merged": """SELECT o.site, o.ts, o.flow, NULL::DOUBLE AS temp FROM old o
                 WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.site = o.site AND f.ts = o.ts)
                 UNION ALL SELECT site, ts, flow, temp FROM fresh""",
}
_STATION_LIST = {
    "listed": """SELECT site, site_order, station, row_number() OVER (PARTITION BY site ORDER BY ord) - 1 AS position FROM (
       SELECT site, site_order, station, min(ord) AS ord FROM (
         SELECT site, site_order, ref_station AS station, 0 AS ord FROM registry WHERE ref_station IS NOT NULL
         UNION ALL SELECT site, site_order, upstream_stations[1], 1 FROM registry WHERE upstream_stations IS NOT NULL
         UNION ALL SELECT site, site_order, upstream_stations[2], 2 FROM registry WHERE len(upstream_stations) > 1) GROUP BY 1, 2, 3)"""
}
_STFLOW = {"sf": "SELECT 'ST' || (l_suppkey % 50) AS station, avg(l_quantity) AS flow, count(*) AS n FROM lineitem GROUP BY 1"}
_FLOW = rr(flow="flow")

ORACLE = {
    "b01_time_range_filter": q(f"SELECT site, ts, {_FLOW} FROM dense WHERE ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'", "dense"),
    "b02_live_window": q(f"SELECT site, ts, {_FLOW} FROM dense WHERE ts BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-20 08:00:00'", "dense"),
    "b02_frozen_window": q(
        f"""SELECT d.site, ts, {_FLOW} FROM daily d JOIN (SELECT site, max(ts) AS m FROM daily GROUP BY site) x ON x.site = d.site
            WHERE ts >= m - INTERVAL 90 DAY""", "daily"),
    "b03_raise_start_to_first_flow": q(
        f"""SELECT w.site, w.ts, {rr(temp_c='temp_c')} FROM weather_raw w
            JOIN (SELECT site, greatest(min(ts), TIMESTAMP '{START}') AS s FROM hourly WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY site) f
              ON f.site = w.site WHERE point = 1 AND w.ts >= s""", "weather_raw", "hourly"),
    "b04_strategy_filter": q("SELECT site, strategy, ref_station FROM registry WHERE strategy = 'DEFAULT'", "registry"),
    "b05_split_train_test": q(f"SELECT site, ts, {_FLOW}, rn, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS role FROM numbered", "hourly", extra=_NUMBERED),
    "b06_split_fit_val_test": q(
        f"""SELECT site, ts, {_FLOW}, rn, CASE WHEN rn <= floor(n * 0.8) THEN 'fit'
            WHEN rn <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS role FROM numbered""", "hourly", extra=_NUMBERED),
    "b07_time_series_folds": q(
        """SELECT site, ts, rn, fold, CASE WHEN rn - 1 >= s THEN 'val' ELSE 'train' END AS role FROM (
             SELECT *, n - (5 - fold) * (n // 6) AS s, n // 6 AS size FROM numbered, LATERAL (SELECT unnest([0, 1, 2, 3, 4]) AS fold))
           WHERE (rn - 1 >= s AND rn - 1 < s + size) OR rn - 1 < s - 8""", "hourly", extra=_NUMBERED),
    "b08_split_reference_current": q(
        f"""SELECT d.site, ts, {_FLOW}, CASE WHEN ts >= m - INTERVAL 7 DAY THEN 'current' ELSE 'reference' END AS part
            FROM dense d JOIN (SELECT site, max(ts) AS m FROM dense GROUP BY site) x ON x.site = d.site""", "dense"),
    "b09_drop_incomplete_rows": q(f"SELECT site, ts, {same(6, 'flow', 'lag_8', 'change_3')} FROM lagged WHERE lag_8 IS NOT NULL AND change_3 IS NOT NULL", "dense", extra=_LAGGED),
    "b10_keep_future_tail": q(
        f"""SELECT site, ts, {same(6, 'flow', 'lag_8', 'change_3')} FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts DESC) AS back FROM lagged)
            WHERE back <= 8 OR (lag_8 IS NOT NULL AND change_3 IS NOT NULL)""", "dense", extra=_LAGGED),
    "b11_select_seq_cols": q(
        """SELECT *, greatest(max(max_hours) OVER (PARTITION BY site) * 4, 24.0, 48.0)::BIGINT AS seq_len FROM (
             SELECT u.site, u.station, n_values, max_hours FROM (SELECT site, station, count(upstream) AS n_values FROM upstream GROUP BY 1, 2) u
             JOIN (SELECT site, station, max(hours) AS max_hours FROM transit GROUP BY 1, 2) t ON t.site = u.site AND t.station = u.station
             WHERE n_values > 100)""", "upstream", "transit"),
    "b12_truncate_from_now": q(
        f"""SELECT site, ts, {_FLOW}, (row_number() OVER (PARTITION BY site ORDER BY ts) - 1)::INTEGER AS lead_hours FROM (
              SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts DESC) AS back FROM dense WHERE flow IS NOT NULL)
            WHERE back <= 48 AND ts >= TIMESTAMP '{NOW}'""", "dense"),
    "b13_training_eligibility": q(
        """SELECT s.site, span_days, span_days >= 365 AND (r.r_name IS NULL OR a.last IS NULL
               OR floor(epoch(TIMESTAMP '2001-07-29 12:00:00' - a.last) / 86400) >= 7) AS eligible
           FROM (SELECT site, epoch(max(ts) - min(ts)) / 86400 AS span_days FROM nation_orders GROUP BY site) s
           LEFT JOIN (SELECT r_name FROM region WHERE r_regionkey > 0) r ON r.r_name = s.site
           LEFT JOIN (SELECT r_name AS site, max(TIMESTAMP '2001-07-01' + to_days(n_nationkey)) AS last FROM nation
                      JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0 GROUP BY 1) a ON a.site = s.site""", "nation_orders"),
    "b14_required_fields": q(
        f"SELECT site, missing, CASE WHEN missing = '' THEN 0 ELSE len(string_split(missing, ',')) END::BIGINT AS n_missing FROM (SELECT r.site, {_MISSING} AS missing FROM registry r LEFT JOIN g ON g.site = r.site)",
        "groups", extra=_GROUP_FIELDS),
    "b15_pending_onboarding": q(
        f"""SELECT site, missing FROM (SELECT r.site, {_MISSING} AS missing FROM registry r LEFT JOIN g ON g.site = r.site
            WHERE r.site NOT IN (SELECT 'P' || s_suppkey FROM supplier)) WHERE missing <> ''""", "groups", extra=_GROUP_FIELDS),
    "c01_align_sources": q(
        f"""SELECT site, ts, {rr(flow="avg(flow) FILTER (WHERE station LIKE '%-0')", upstream_1="avg(flow) FILTER (WHERE station LIKE '%-1')", upstream_2="avg(flow) FILTER (WHERE station LIKE '%-2')")}
            FROM (SELECT site, station, date_trunc('hour', ts) AS ts, flow FROM readings) GROUP BY 1, 2""", "readings"),
    "c02_upstream_lookup": q(
        f"""SELECT u.site, position::INTEGER AS position, u.station, CASE WHEN n_codes = 1 THEN 'upstream' ELSE 'upstream_' || u.station END AS label, {_FLOW}, n
            FROM (SELECT site, unnest(upstream_stations) AS station, generate_subscripts(upstream_stations, 1) - 1 AS position, len(upstream_stations) AS n_codes FROM registry) u
            JOIN sf ON sf.station = u.station""", "registry", extra=_STFLOW),
    "c03_reference_lookup": q(f"SELECT site, sf.station, {_FLOW}, n FROM registry JOIN sf ON sf.station = ref_station", "registry", extra=_STFLOW),
    "c04_seasonal_transit_join": q(
        f"""SELECT r.site, r.station, r.ts, shift_steps, {rr(8, upstream='u.upstream')}
            FROM (SELECT *, ts - to_days(shift_steps::INTEGER) AS moved
                  FROM (SELECT a.site, a.station, a.ts, greatest(8, coalesce(t.hours, 8)::BIGINT) AS shift_steps
                        FROM (SELECT *, {SEASON} AS season FROM upstream) a
                        LEFT JOIN transit t ON t.site = a.site AND t.station = a.station AND t.season = a.season)) r
            LEFT JOIN upstream u ON u.site = r.site AND u.station = r.station AND u.ts = r.moved""", "upstream", "transit"),
    "c05_prediction_realign": q(
        f"SELECT site, ts, {_FLOW}, {rr(prediction='CASE WHEN lag_8 IS NOT NULL AND change_3 IS NOT NULL THEN lag_8 + change_3 / 2 END')} FROM lagged", "dense", extra=_LAGGED),
    "c06_replace_on_key": q(f"SELECT site, ts, {same(6, 'flow', 'temp')} FROM merged", "hourly", extra=_UPSERT),
    "c07_highwater_join": q(
        """SELECT r.station, r.ts, r.flow, r.event_id FROM readings r LEFT JOIN (
             SELECT station, max(ts) AS last FROM readings WHERE event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-20' GROUP BY 1) s ON s.station = r.station
           WHERE last IS NULL OR r.ts > last""", "readings"),
    "c08_source_folder_match": q(
        """SELECT r.site, CASE WHEN m.mapped IS NOT NULL THEN f.folder WHEN c.n = 1 THEN c.only END AS folder,
             CASE WHEN m.mapped IS NOT NULL THEN 0 ELSE coalesce(c.n, 0) END AS candidates,
             CASE WHEN m.mapped IS NOT NULL THEN CASE WHEN f.folder IS NULL THEN 'unresolved' ELSE 'mapped' END
                  WHEN c.n = 1 THEN 'matched' ELSE 'unresolved' END AS status
           FROM registry r LEFT JOIN mapping m ON m.site = r.site LEFT JOIN folders f ON f.folder = m.mapped
           LEFT JOIN (SELECT g.site, count(DISTINCT folder) AS n, min(folder) AS only FROM (SELECT site, lower(name) AS g FROM groups WHERE name IS NOT NULL) g
                      JOIN registry r ON r.site = g.site JOIN folders f ON contains(lower(f.folder), lower(r.plant)) AND ends_with(lower(f.folder), '_' || g.g)
                      GROUP BY g.site) c ON c.site = r.site""", "groups",
        extra={
            "folders": "SELECT 'Site_' || ['Hot', 'Large', 'Red', 'Small'][s_suppkey % 4 + 1] || ' ' || s_suppkey || '_G' || (s_suppkey % 3 + 1) AS folder FROM supplier",
            "mapping": "SELECT 'P' || p_partkey AS site, 'Site_Hot ' || (p_partkey % 200) || '_G' || (p_partkey % 200 % 3 + 1) AS mapped FROM part WHERE p_partkey % 29 = 0",
        }),
    "c09_missing_weather": q(
        """SELECT station AS site FROM readings GROUP BY 1 HAVING max(point) - 1 > 0 AND station NOT IN (
             SELECT station FROM readings WHERE event_id % 3 = 0 AND ts BETWEEN TIMESTAMP '2024-01-15 09:00:00' AND TIMESTAMP '2024-01-15 12:00:00')""", "readings"),
    "c10_candidate_vs_production": q(
        f"""SELECT site, {rr(kge_candidate='kc', kge_production='kp')},
              CASE WHEN site = 'view' THEN 'first_training' WHEN kc > kp THEN 'promote' ELSE 'keep' END AS decision
            FROM (SELECT site, {kge_sql('y', 'day_mean')['kge']} AS kc, CASE WHEN site <> 'view' THEN {kge_sql('y', 'persistence')['kge']} END AS kp
                  FROM forecasts WHERE lead = 8 AND y IS NOT NULL AND day_mean IS NOT NULL AND (site = 'view' OR persistence IS NOT NULL) GROUP BY site)""", "forecasts"),
    "c11_season_transit_lookup": q(
        f"""SELECT a.site, a.station, a.season, coalesce(t.hours, 8.0::DOUBLE) AS hours, count(*) AS n FROM (SELECT *, {SEASON} AS season FROM nation_orders) a
            LEFT JOIN transit t ON t.site = a.site AND t.station = a.station AND t.season = a.season GROUP BY 1, 2, 3, 4""", "nation_orders", "transit"),
    "d01_hourly_mean": q(f"SELECT site, ts, {_FLOW} FROM hourly", "hourly"),
    "d02_hourly_mean_closed": q(
        f"""SELECT h.station, h.ts, {_FLOW} FROM (SELECT station, date_trunc('hour', ts) AS ts, avg(flow) AS flow FROM readings GROUP BY 1, 2) h
            JOIN (SELECT station, date_trunc('hour', max(ts)) AS open_hour,
                         date_trunc('hour', max(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-20')) AS last FROM readings GROUP BY 1) b ON b.station = h.station
            WHERE h.ts < open_hour AND (last IS NULL OR h.ts > last)""", "readings"),
    "d03_history_span": q(f"SELECT site, {rr(span_days='(floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400')} FROM readings GROUP BY site", "readings"),
    "d18_latest_obs": q(
        """SELECT station, greatest(coalesce(a, l), coalesce(l, a)) AS latest_ts, CASE WHEN a IS NULL OR l > a THEN 'live' ELSE 'archive' END AS source
           FROM (SELECT station, max(date_trunc('day', ts)) FILTER (WHERE event_id % 2 = 0) AS a, max(date_trunc('day', ts)) FILTER (WHERE event_id % 2 = 1) AS l
                 FROM readings GROUP BY 1)""", "readings"),
    "d19_last_stored_ts": q("SELECT station, max(ts) AS last_ts FROM readings GROUP BY 1", "readings"),
    "d21_distinct_stations": q("SELECT site, position, station FROM listed", "registry", extra=_STATION_LIST),
    "f01_tail_n": q(
        f"""SELECT site, ts, {_FLOW} FROM dense WHERE flow IS NOT NULL AND ts <= TIMESTAMP '2024-01-29 12:00:00'
            QUALIFY row_number() OVER (PARTITION BY site ORDER BY ts DESC) <= 48""", "dense"),
    "f03_top_flood_peaks": q(
        f"SELECT site, ts, {_FLOW}, rank FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY flow DESC, ts)::INTEGER AS rank FROM hourly) WHERE rank <= 5", "hourly"),
    "f04_last_observed": q(f"SELECT site, {rr(last_flow='arg_max(flow, ts)')}, max(ts) AS last_ts FROM dense WHERE flow IS NOT NULL GROUP BY site", "dense"),
    "f06_first_valid": q(f"SELECT site, point, {rr(seen='arg_min(lat + temp_c, ts)')} FROM weather_raw WHERE ts >= TIMESTAMP '2024-01-02' GROUP BY 1, 2", "weather_raw"),
    "g01_union_keep_last": q(
        f"""SELECT site, point, ts, {rr(temp_c="CASE WHEN ts >= TIMESTAMP '2024-01-20' AND hour(ts) % 3 <> 0 THEN temp_c + 1 ELSE temp_c END", precip_mm='precip_mm')} FROM weather_raw""", "weather_raw"),
    "g02_upsert_history": q(f"SELECT site, count(*) AS n_rows, {rr(flow='sum(flow)')}, count(temp) AS n_temp FROM merged GROUP BY site", "hourly", extra=_UPSERT),
    "g03_append_points": q(
        """SELECT station, ts, flow, event_id FROM readings WHERE ts < TIMESTAMP '2024-01-20'
           UNION ALL SELECT r.station, r.ts, r.flow, r.event_id FROM readings r
           JOIN (SELECT station, max(ts) AS last FROM readings WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1) s ON s.station = r.station
           WHERE r.ts > last AND r.ts >= TIMESTAMP '2024-01-18'""", "readings"),
    "g06_station_dedup": q(
        """SELECT l.site, l.station, coalesce(e.owner, f.first_site) AS owner,
             CASE WHEN coalesce(e.owner, f.first_site) <> l.site THEN 'linked' WHEN e.owner IS NOT NULL THEN 'existing' ELSE 'new' END AS status
           FROM listed l JOIN (SELECT station, arg_min(site, site_order) AS first_site FROM listed GROUP BY 1) f ON f.station = l.station
           LEFT JOIN (SELECT 'ST' || s_suppkey AS station, 'P' || (s_suppkey + 50) AS owner FROM supplier WHERE s_suppkey < 50 AND s_suppkey % 2 = 0) e ON e.station = l.station""",
        "registry", extra=_STATION_LIST),
    "w01_densify_hourly": q(f"SELECT site, ts, {_FLOW} FROM dense", "dense"),
    "l01_contract_errors": q("SELECT site, n_rows, n_target, n_unsorted, n_duplicates, n_negative FROM facts", "readings", extra=_STORED),
    "l02_contract_warnings": q(f"SELECT site, {same(6, 'missing_share', 'span_days')}, n_gaps, {same(6, 'max_gap_hours')}, n_dead_columns FROM facts", "readings", extra=_STORED),
    "l03_contract_strict": q(
        f"SELECT site, errors, '' AS warnings, errors = '' AS ok FROM (SELECT site, {_clean(_ERR + ' || ' + _WARN)} AS errors FROM facts)", "readings", extra=_STORED),
    "l04_contract_report": q(
        f"""SELECT site, errors, warnings, errors = '' AS ok FROM (SELECT site, {_clean(_ERR)} AS errors, {_clean(_WARN)} AS warnings FROM facts)
            UNION ALL SELECT r_name, 'empty', '', false FROM region""", "readings", extra=_STORED),
}
