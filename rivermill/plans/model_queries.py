"""Training, stacking and registry rules on the driver's tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from rivermill.functions.ordered import exact_quantiles
from rivermill.operators import evaluate as ev
from rivermill.operators import forecast as fc
from rivermill.operators import layout as ly
from rivermill.operators import models as ml
from rivermill.operators import prepare as pr
from rivermill.operators import quality as ql
from rivermill.operators import sequences as sq
from rivermill.operators import splits as sp
from rivermill.plans import tables as t
from rivermill.plans.oracle import SEASON, kge_sql
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.prepare_queries import _stored_rows, _STORED
from rivermill.plans.shape import rounded
from rivermill.session import materialise

LAGS = [f"lag_{n}" for n in (7, 8, 12, 14, 16, 24, 32)]
MATRIX = [*LAGS, "trend_rel"]
HOURLY_COLUMNS = ["lag_8", "lag_12", "lag_16", "lag_24", "lag_32", "trend_rel", "recession_log_8"]
QUICK = {"maxIter": 5, "maxDepth": 3}
SEQ, FOLDS = 24, 6


def k01(s, d):
    rows = ml.feature_matrix(t.daily(s, d), t.DAILY, t.H, MATRIX)
    vec = VectorAssembler(inputCols=MATRIX, outputCol="features").transform(rows)
    cells = vector_to_array("features")
    return rounded(vec.select("site", "ts", "label", F.size(cells).cast("long").alias("width"), F.aggregate(cells, F.lit(0.0), lambda a, v: a + v).alias("total")))


def k02(s, d):
    rows = ml.future_matrix(t.daily(s, d), t.DAILY, t.H, MATRIX)
    return rounded(rows.select("site", "ts", "flow", *MATRIX), 8)


WIDE = {
    "flow": ["lag_8", "lag_12", "lag_24", "trend_rel"],
    "weather": ["temp", "precip", "ground_rain", "et0", "temp_24h", "snow_stock", "melt", "melt_24h", "net_inflow", "discharge"],
    "upstream": ["upstream_lag_8", "upstream_lag_20", "upstream_gradient_24h", "upstream_ratio"],
}


def _sources(s, d, only=None, future=False):
    flow, above = t.dense_hourly(s, d), t.hourly_upstream(s, d)
    if future:
        flow, above = ml.extend_future(flow, t.HOURLY, t.H), ml.extend_future(above, t.HOURLY_UPSTREAM, t.H)
    flow = materialise(flow, "hourly")
    transit = t.hourly_transit(s, d)
    return flow, ly.matrix_sources(
        flow, t.dense_weather(s, d), t.basins(s, d), above, transit, t.H, t.HOURLY, t.POINTS, t.HOURLY_UPSTREAM, only)


def _slots(rows, names, *keep):
    cells = F.transform(vector_to_array("features"), lambda v, i: F.struct(F.array(*map(F.lit, names))[i].alias("slot"), v.alias("value")))
    return rounded(rows.select("site", "ts", *keep, F.explode(cells).alias("cell")).select("site", "ts", *keep, "cell.slot", "cell.value"), 9)


def k01_wide(s, d):
    """Every slot of every row with a known flow; the complete ones are the training rows."""
    flow, sources = _sources(s, d, WIDE)
    layout = ly.fit_layout(sources)
    known = flow.where(F.col("flow").isNotNull()).select("site", "ts", F.log1p("flow").alias("label"))
    return _slots(ly.wide_matrix(layout, sources, known), layout.names(), "label", "complete")


def k02_wide(s, d):
    """The layout fitted on the past, applied to the rows up to the end of the forecast."""
    layout = ly.fit_layout(_sources(s, d, WIDE)[1])
    flow, sources = _sources(s, d, WIDE, future=True)
    return _slots(ly.future_rows(layout, sources, t.HOURLY, flow, t.H), layout.names(), "complete")


def _rows(s, d):
    feats = ml.feature_matrix(materialise(t.dense_hourly(s, d), "hourly"), t.HOURLY, t.H, HOURLY_COLUMNS)
    return materialise(feats, "matrix")


def k03(s, d):
    _, scores = ml.fit_final(_rows(s, d), t.HOURLY, HOURLY_COLUMNS, QUICK)
    return scores


def k04(s, d):
    ranked = ml.feature_importances(_rows(s, d), HOURLY_COLUMNS, trees=10)
    chosen = ml.choose_features(ranked, top=5)
    rows = [(c, v, c in chosen) for c, v in ranked]
    return s.createDataFrame(rows, "feature STRING, importance DOUBLE, chosen BOOLEAN")


def k05(s, d):
    grid = [{"maxIter": 3, "maxDepth": 2}, {"maxIter": 3, "maxDepth": 4}]
    return ml.search(_rows(s, d), t.HOURLY, HOURLY_COLUMNS, grid, 3, t.H)


def k06(s, d):
    return ml.out_of_fold(_rows(s, d), t.HOURLY, HOURLY_COLUMNS, 3, t.H, QUICK)


def _windows(s, d, stride=1):
    return materialise(sq.sliding_sequences(t.dense_hourly(s, d), t.HOURLY, SEQ, t.H, stride=stride), "windows")


def k07(s, d):
    oof = ml.out_of_fold_sequences(_windows(s, d), t.HOURLY, FOLDS, t.H, t.H)
    return oof.select("site", "ts", "fold", F.posexplode("seq").alias("lead", "prediction"))


def _weather_wide(s, d):
    points = [1, 2, 3]
    wide = t.dense_weather(s, d).groupBy("site", "ts").pivot("point", points).agg(F.first("temp_k").alias("temp"), F.first("precip_cum_mm").alias("precip"))
    return wide


WEATHER = [f"{p}_{n}" for p in (1, 2, 3) for n in ("temp", "precip")]


def _naive_frame(s, d, future=False):
    """Stand-in base models: log flow 8 h before as tree prediction, log day mean as sequence prediction."""
    dense = t.dense_hourly(s, d)
    dense = ml.extend_future(dense, t.HOURLY, t.H) if future else dense
    seq = ml.day_mean_log(dense, t.HOURLY, t.H)
    ax = t.HOURLY
    w = ax.window()
    frame = ax.core(ax.split(seq, back=t.H).withColumn("oof", F.log1p(F.lag("flow", t.H).over(w))))
    return materialise(frame.join(_weather_wide(s, d), ["site", "ts"], "left"), "frame")


def k08(s, d):
    meta = ml.meta_features(_naive_frame(s, d), t.HOURLY, t.H, WEATHER)
    return rounded(meta.drop("y"))


def k09(s, d):
    q90 = exact_quantiles(t.hourly(s, d).withColumn("v", F.log1p("flow")), ["site"], "v", {"q90": 0.9})
    return rounded(ml.meta_features(_naive_frame(s, d, True), t.HOURLY, t.H, WEATHER, q90, live=True).drop("y"))


def _meta(s, d):
    return materialise(ml.meta_features(_naive_frame(s, d), t.HOURLY, t.H, WEATHER), "meta")


def k10(s, d):
    _, scores = ml.fit_stacking(_meta(s, d), t.HOURLY, t.H, WEATHER)
    return scores


def k11(s, d):
    _, scores = ml.fit_step_trees(_meta(s, d), t.HOURLY, 2, WEATHER, {"maxIter": 3, "maxDepth": 2})
    return scores


def k12(s, d):
    stack, holdout = ml.fit_before_holdout(_meta(s, d), t.HOURLY, t.H, WEATHER)
    return rounded(ev.score_per_lead(ml.test_predictions(holdout, stack, t.H)))


def k13(s, d):
    """Trees and windows predict the next hours; the ridge fitted on the stand-in models combines them."""
    dense = materialise(t.dense_hourly(s, d), "hourly")
    rows = _rows(s, d)
    trees, _ = ml.fit_final(rows, t.HOURLY, HOURLY_COLUMNS, QUICK)
    future = ml.future_matrix(dense, t.HOURLY, t.H, HOURLY_COLUMNS)
    oof = trees.transform(future).select("site", "ts", F.col("prediction").alias("oof"))
    model = ml.fit_sequence_model(_windows(s, d), t.H)
    last = sq.last_window(ml.extend_future(dense, t.HOURLY, t.H), t.HOURLY, SEQ, t.H)
    anchor = pr.last_observed(dense).select("site", F.col("last_ts").alias("ts"))
    seq = ml.predict_sequences(model, last.join(anchor, "site"))
    frame = ml.extend_future(dense, t.HOURLY, t.H).join(oof, ["site", "ts"], "left").join(seq, ["site", "ts"], "left")
    frame = materialise(frame.join(_weather_wide(s, d), ["site", "ts"], "left"), "frame")
    meta = _meta(s, d)
    stack, _ = ml.fit_stacking(meta, t.HOURLY, t.H, WEATHER)
    q90 = ml.target_q90(ml.known_targets(meta))
    live = ml.meta_features(frame, t.HOURLY, t.H, WEATHER, q90, live=True)
    return ml.predict_future(live, stack, t.HOURLY, t.H)


def _decisions(s, d):
    sc = t.scored(s, d).where(F.col("lead") == t.H)
    production = sc.where((F.col("model") == "persistence") & (F.col("site") != "view"))
    return ev.compare_models(sc.where(F.col("model") == "day_mean"), production)


def k14(s, d):
    registry = t.basins(s, d).where(F.col("site") != "view").select(
        "site", F.lit(t.H).alias("horizon"), F.length("site").alias("version"), F.lit(0.5).alias("kge"))
    return rounded(fc.promote(registry, _decisions(s, d), t.H, "2024-02-01 06:00:00", "run-1"))


def k15(s, d):
    return ml.evaluation_window(sp.split_train_test(t.hourly(s, d), t.HOURLY))


def k16(s, d):
    rows = t.hourly(s, d)
    stored = ml.fingerprint(rows.where((F.col("site") != "view") | (F.col("ts") < F.lit("2024-01-20").cast("timestamp"))))
    return ml.reusable(stored.where(F.col("site") != "click"), rows)


def k17(s, d):
    train = _windows(s, d).where(F.col("ts") < F.lit("2024-01-25").cast("timestamp"))
    return rounded(ml.sequence_statistics(train))


def k18(s, d):
    rows = _rows(s, d)
    model, _ = ml.fit_final(rows, t.HOURLY, HOURLY_COLUMNS, QUICK)
    return ml.permutation_importance(model, rows, HOURLY_COLUMNS)


def k19(s, d):
    sites = t.basins(s, d).select("site").unionByName(t.table(s, d, "region").select(F.col("r_name").alias("site")))
    rows = _stored_rows(s, d).where("site IN ('click', 'view', 'error')").unionByName(
        t.readings(s, d).where("site NOT IN ('click', 'view', 'error')").select("site", F.col("event_id").alias("seq"), "ts", "flow", F.col("flow").alias("temp")))
    contract = ql.contract_report(rows, others=("temp",))
    eligible = pr.history_span(t.readings(s, d)).select("site", (F.col("span_days") >= 29).alias("eligible"))
    return ml.batch_outcomes(sites, contract, eligible, _decisions(s, d))


QUERIES = {
    "k01_wide_matrix": k01_wide, "k02_wide_future": k02_wide,
    "k01_feature_matrix": k01, "k02_future_matrix": k02, "k03_tree_regressor": k03, "k04_feature_selection": k04, "k05_hyperparameter_search": k05,
    "k06_out_of_fold": k06, "k07_sequence_regressor": k07, "k08_meta_features": k08, "k09_meta_features_live": k09, "k10_ridge_stacking": k10,
    "k11_per_step_trees": k11, "k12_predict_test": k12, "k13_predict_future": k13, "k14_model_promotion": k14, "k15_evaluation_window": k15,
    "k16_stale_cache_rule": k16, "k17_standardise_sequences": k17, "k18_feature_importance": k18, "k19_batch_run": k19,
}

_MATRIX_SQL = {
    "mat": """SELECT *, (lag_7 - lag_8) / (lag_8 + 1e-3) AS trend_rel FROM flow_lag""",
}
_SUM = " + ".join(MATRIX)
_FULL = " AND ".join(f"{c} IS NOT NULL" for c in MATRIX)
_FUTURE = {
    "ext": "SELECT site, ts, flow FROM daily UNION ALL SELECT site, m + to_days(k::INTEGER), NULL FROM (SELECT site, max(ts) AS m FROM daily GROUP BY site), LATERAL (SELECT unnest(range(1, 9)) AS k)",
    "lg": "SELECT site, ts, flow, " + ", ".join(f"lag(flow, {c[4:]}) OVER w AS {c}" for c in LAGS) + ", row_number() OVER (PARTITION BY site ORDER BY ts DESC) AS back FROM ext WINDOW w AS (PARTITION BY site ORDER BY ts)",
    "mat": "SELECT *, (lag_7 - lag_8) / (lag_8 + 1e-3) AS trend_rel FROM lg",
}


def _meta_sql(live: bool) -> dict[str, str]:
    future = "SELECT site, ts, flow FROM dense"
    if live:
        future += " UNION ALL SELECT site, m + to_hours(k::INTEGER), NULL FROM (SELECT site, max(ts) AS m FROM dense GROUP BY site), LATERAL (SELECT unnest(range(1, 9)) AS k)"
    trees = ", ".join(f"ln(1 + CASE WHEN room THEN lag(flow, {8 - k}) OVER w END) AS tree_{k}" for k in range(1, 9))
    return {
        "ax": future,
        "num": "SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn, row_number() OVER (PARTITION BY site ORDER BY ts DESC) > 8 AS room FROM ax",
        "wide": "SELECT site, ts, " + ", ".join(f"max(temp_k) FILTER (WHERE point = {p}) AS t{p}, max(precip_cum_mm) FILTER (WHERE point = {p}) AS p{p}" for p in (1, 2, 3)) + " FROM weather GROUP BY 1, 2",
        "base": f"""SELECT n.site, n.ts, n.flow, rn, {trees}, ln(1 + avg(flow) OVER d) AS seq, avg(flow) OVER d AS dm,
             coalesce(CASE WHEN count(flow) OVER s >= 12 THEN regr_slope(flow, rn::DOUBLE) OVER s END, 0) AS trend,
             {', '.join(f'lead(ln(1 + flow), {k}) OVER w AS y_{k}' for k in range(1, 9))},
             {', '.join(f'coalesce(lag(t{p}, 8) OVER w, 0) AS temp_{p}, coalesce(lag(p{p}, 8) OVER w, 0) AS precip_{p}' for p in (1, 2, 3))}, room
           FROM num n LEFT JOIN wide x ON x.site = n.site AND x.ts = n.ts
           WINDOW w AS (PARTITION BY n.site ORDER BY rn), d AS (PARTITION BY n.site ORDER BY rn ROWS 23 PRECEDING), s AS (PARTITION BY n.site ORDER BY rn ROWS 71 PRECEDING)""",
    }


def _wide_sql(future: bool) -> str:
    """Cells by name, the features a member has at all, rows whose members are all there and know all they have."""
    ahead = lambda keys: f" UNION ALL SELECT {keys}, m + to_hours(k::INTEGER), NULL FROM (SELECT {keys}, max(ts) AS m FROM {{}} GROUP BY ALL), LATERAL (SELECT unnest(range(1, 9)) AS k)" if future else ""
    doy = "2 * pi() * (dayofyear(ts) - 172) / 365"
    flow = {**{c: c for c in ("lag_8", "lag_12", "lag_24")}, "trend_rel": "(lag_8 - lag_12) / (lag_8 + 1e-3)", "season_sin": f"sin({doy})", "season_cos": f"cos({doy})"}
    weather = {c: c for c in WIDE["weather"]}
    above = {"upstream_lag_8": "up", "upstream_lag_20": "lag_up_12", "upstream_gradient_24h": "up - lag_up_24", "upstream_ratio": "up / (lag_8 + 1e-6)"}

    def long(kind: str, cols: dict[str, str], table: str, place: str) -> str:
        cells = ", ".join(f"{{'f': '{n}', 'v': ({e})::DOUBLE}}" for n, e in cols.items())
        return f"SELECT '{kind}' AS kind, site, ts, {place} AS place, c.f AS f, c.v AS v FROM (SELECT *, unnest([{cells}]) AS c FROM {table})"

    extra = {
        "ax": "SELECT site, ts, flow FROM dense" + ahead("site").format("dense"),
        "fl": "SELECT *, lag(flow, 8) OVER w AS lag_8, lag(flow, 12) OVER w AS lag_12, lag(flow, 24) OVER w AS lag_24, row_number() OVER (PARTITION BY site ORDER BY ts DESC) AS back FROM ax WINDOW w AS (PARTITION BY site ORDER BY ts)",
        "sh": "SELECT site, station, date_trunc('hour', ts) AS ts, avg(flow) AS upstream FROM readings GROUP BY 1, 2, 3",
        "sd": "SELECT a.site, a.station, a.ts, upstream FROM (SELECT site, station, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM sh GROUP BY 1, 2) a LEFT JOIN sh ON sh.site = a.site AND sh.station = a.station AND sh.ts = a.ts",
        "st": "SELECT site, station, ts, upstream FROM sd" + ahead("site, station").format("sd"),
        "tr": "SELECT DISTINCT site, station, unnest([{'season': 'winter', 'hours': point * 3.0 + 6}, {'season': 'spring', 'hours': point * 1.0}]) AS t FROM readings",
        "rcv": f"SELECT st.site, st.station, st.ts, st.ts - to_hours(greatest(8, coalesce(t.hours, 8)::BIGINT)::INTEGER) AS src FROM (SELECT *, {SEASON} AS season FROM st) st LEFT JOIN tr ON tr.site = st.site AND tr.station = st.station AND t.season = st.season",
        "up": "SELECT *, lag(up, 12) OVER w AS lag_up_12, lag(up, 24) OVER w AS lag_up_24, dense_rank() OVER (PARTITION BY site ORDER BY station) - 1 AS place FROM (SELECT r.site, r.station, r.ts, b.upstream AS up, lag_8 FROM rcv r LEFT JOIN st b ON b.site = r.site AND b.station = r.station AND b.ts = r.src LEFT JOIN fl ON fl.site = r.site AND fl.ts = r.ts) WINDOW w AS (PARTITION BY site, station ORDER BY ts)",
        "we": "SELECT *, CASE WHEN high THEN sum(melt) OVER (PARTITION BY site, point ORDER BY rn ROWS 23 PRECEDING) END AS melt_24h, dense_rank() OVER (PARTITION BY site ORDER BY point) - 1 AS place FROM arrived",
        "cells": " UNION ALL ".join([
            long("flow", flow, "fl", "0"), long("weather", weather, "we", "place"), long("upstream", above, "up", "place"),
            "SELECT 'basin', site, ts, 0, 'basin_inflow', avg(discharge) FROM arrived GROUP BY site, ts"]),
        "have": "SELECT kind, site, place, f, count(v) > 0 AS has FROM cells GROUP BY ALL",
        "need": "SELECT site, count(DISTINCT (kind, place)) AS n FROM have GROUP BY site",
        "whole": "SELECT c.site, c.ts, count(DISTINCT (c.kind, c.place)) AS n, bool_and(v IS NOT NULL OR NOT has) AS known FROM cells c JOIN have h ON h.kind = c.kind AND h.site = c.site AND h.place = c.place AND h.f = c.f GROUP BY 1, 2",
        "chosen": "SELECT fl.site, fl.ts, flow, back, coalesce(known AND w.n = need.n, FALSE) AS complete FROM fl LEFT JOIN whole w ON w.site = fl.site AND w.ts = fl.ts LEFT JOIN need ON need.site = fl.site",
        "slots": "SELECT DISTINCT kind, place, f, CASE WHEN kind IN ('weather', 'upstream') THEN f || '_' || (place + 1) ELSE f END AS slot FROM have",
    }
    keep, rows = ("complete", "complete OR back <= 8") if future else (rr(9, label="ln(1 + flow)") + ", complete", "flow IS NOT NULL")
    return q(
        f"""SELECT r.site, r.ts, {keep}, slot, {rr(9, value="coalesce(v, 0)")} FROM (SELECT * FROM chosen WHERE {rows}) r CROSS JOIN slots s
            LEFT JOIN cells c ON c.site = r.site AND c.ts = r.ts AND c.kind = s.kind AND c.place = s.place AND c.f = s.f""", "dense", "readings", "arrived", extra=extra)


_TREES = {f"tree_{k}": f"tree_{k}" for k in range(1, 9)}
_SEQS = {f"seq_{k}": "seq" for k in range(1, 9)}
_REST = {
    "divergence": "coalesce(tree_8 - seq, 0)", "q_now_log": "ln(1 + flow)", "month_sin": "sin(2 * pi() * month(ts) / 12)", "month_cos": "cos(2 * pi() * month(ts) / 12)",
    "flood": "CASE WHEN ln(1 + flow) > q90 THEN 1 ELSE 0 END", "trend": "trend",
}


def _quoted(live: bool) -> str:
    zero = (lambda e: f"coalesce({e}, 0)") if live else (lambda e: e)
    cols = {**{n: zero(e) for n, e in _TREES.items()}, **{n: zero(e) for n, e in _SEQS.items()}, **_REST}
    weather = ", ".join(f'round({n}_{p}, 6) + 0.0 AS "{p}_{n}_lag"' for p in (1, 2, 3) for n in ("temp", "precip"))
    return rr(**cols) + ", " + weather


_DECIDE = f"""SELECT site, CASE WHEN site = 'view' THEN 'first_training' WHEN kc > kp THEN 'promote' ELSE 'keep' END AS decision, kc
  FROM (SELECT site, {kge_sql('y', 'day_mean')['kge']} AS kc, {kge_sql('y', 'persistence')['kge']} AS kp
        FROM forecasts WHERE lead = 8 AND y IS NOT NULL AND day_mean IS NOT NULL AND (site = 'view' OR persistence IS NOT NULL) GROUP BY site)"""
_ALL_TREES = " AND ".join(f"tree_{k} IS NOT NULL" for k in range(1, 9))

ORACLE = {
    "k01_wide_matrix": _wide_sql(False),
    "k02_wide_future": _wide_sql(True),
    "k01_feature_matrix": q(
        f"SELECT site, ts, {rr(label='ln(1 + flow)', total=_SUM)}, {len(MATRIX)}::BIGINT AS width FROM mat WHERE flow IS NOT NULL AND {_FULL}", "flow_lag", extra=_MATRIX_SQL),
    "k02_future_matrix": q(
        f"SELECT site, ts, {rr(8, flow='flow', **{c: f'coalesce({c}, 0)' for c in MATRIX})} FROM mat WHERE back <= 8 OR ({_FULL})", "daily", extra=_FUTURE),
    "k08_meta_features": q(
        f"SELECT b.site, ts, {_quoted(False)} FROM base b JOIN lim ON lim.site = b.site WHERE room AND seq IS NOT NULL AND {_ALL_TREES}", "dense", "weather",
        extra={**_meta_sql(False), "lim": "SELECT site, quantile_cont(v, 0.9) AS q90 FROM (" + " UNION ALL ".join(
            f"SELECT site, y_{k} AS v FROM base WHERE room AND seq IS NOT NULL AND {_ALL_TREES}" for k in range(1, 9)) + ") GROUP BY site"}),
    "k09_meta_features_live": q(
        f"SELECT b.site, ts, {_quoted(True)} FROM base b JOIN lim ON lim.site = b.site JOIN (SELECT site AS s2, max(ts) AS m FROM dense WHERE flow IS NOT NULL GROUP BY site) l ON s2 = b.site AND m = ts",
        "dense", "weather", extra={**_meta_sql(True), "lim": "SELECT site, quantile_cont(ln(1 + flow), 0.9) AS q90 FROM hourly GROUP BY site"}),
    "k14_model_promotion": q(
        f"""SELECT site, 8 AS horizon, CASE WHEN site = 'view' THEN 1 ELSE length(site) + 1 END::INTEGER AS version, {rr(kge='kc')}, TIMESTAMP '2024-02-01 06:00:00' AS promoted_at, 'run-1' AS run_id
            FROM ({_DECIDE}) WHERE decision <> 'keep'""", "forecasts"),
    "k15_evaluation_window": q(
        """SELECT site, count(*) AS n_rows, count(*) FILTER (WHERE rn <= floor(n * 0.8)) AS n_train, count(*) FILTER (WHERE rn > floor(n * 0.8)) AS n_test,
             min(ts) FILTER (WHERE rn > floor(n * 0.8)) AS test_start, max(ts) AS test_end
           FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn, count(*) OVER (PARTITION BY site) AS n FROM hourly) GROUP BY site""", "hourly"),
    "k16_stale_cache_rule": q(
        "SELECT site, count(*) AS n_rows, max(ts) AS last_ts, CASE WHEN site IN ('click', 'view') THEN 'compute' ELSE 'reuse' END AS action FROM hourly GROUP BY site", "hourly"),
    "k17_standardise_sequences": q(
        f"""SELECT input::INTEGER AS input, {rr(mean='avg(v)', std='stddev_pop(v)')} FROM (
              SELECT unnest([0, 1, 2, 3, 4, 5]) AS input, unnest([CASE WHEN k.k > 24 THEN 0 ELSE f END, hs, hc, ds, dc, CASE WHEN k.k > 24 THEN 1 ELSE 0 END]) AS v
              FROM win JOIN feat ON feat.site = win.site JOIN (SELECT unnest(range(1, 33)) AS k) k ON feat.rn = win.rn - 24 + k.k) GROUP BY 1""", "dense",
        extra={
            "feat": """SELECT site, ts, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn, ln(1 + flow)::FLOAT::DOUBLE AS f, sin(2 * pi() * hour(ts) / 24)::FLOAT::DOUBLE AS hs,
                         cos(2 * pi() * hour(ts) / 24)::FLOAT::DOUBLE AS hc, sin(2 * pi() * dayofyear(ts) / 365)::FLOAT::DOUBLE AS ds, cos(2 * pi() * dayofyear(ts) / 365)::FLOAT::DOUBLE AS dc FROM dense""",
            "win": """SELECT site, rn, ts FROM (SELECT site, ts, rn, count(f) OVER (PARTITION BY site ORDER BY rn ROWS BETWEEN 23 PRECEDING AND 8 FOLLOWING) AS n FROM feat)
                      WHERE n = 32 AND ts < TIMESTAMP '2024-01-25'""",
        }),
    "k19_batch_run": q(
        f"""SELECT site, CASE WHEN ok IS NULL THEN 'no_data' WHEN NOT ok THEN 'contract_broken' WHEN NOT eligible THEN 'not_due' ELSE decision END AS outcome FROM (
              SELECT r.site, CASE WHEN r.site IN ('click', 'view', 'error') THEN f.n_unsorted = 0 AND f.n_duplicates = 0 AND f.n_target > 0 AND f.n_negative = 0 ELSE dup = 0 END AS ok,
                     days >= 29 AS eligible, decision
              FROM (SELECT site, count(*) - count(DISTINCT ts) AS dup, (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400 AS days FROM readings GROUP BY site) r
              LEFT JOIN facts f ON f.site = r.site LEFT JOIN ({_DECIDE}) x ON x.site = r.site)
            UNION ALL SELECT r_name, 'no_data' FROM region""", "readings", "forecasts", extra=_STORED),
}
