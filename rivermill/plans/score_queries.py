"""Scores, quantiles, weights, drift and alerts on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermill.functions.blocks import diff
from rivermill.functions.columns import null_safe
from rivermill.operators import drift as dr
from rivermill.operators import evaluate as ev
from rivermill.plans import tables as t
from rivermill.plans.oracle import SEASON, kge_sql
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.shape import rounded
from rivermill.session import materialise


def d04(s, d):
    return rounded(ev.score(t.scored(s, d), ["site", "model"]))


def d05(s, d):
    y, p = F.col("y"), F.col("p")
    # A third "model" without spread shows the guard.
    rows = t.scored(s, d)
    flat = rows.where(F.col("model") == "day_mean").withColumns({"model": F.lit("flat"), "p": F.lit(50.0)})
    out = rows.unionByName(flat).groupBy("site", "model", "lead").agg(ev.kge_loss(y, p).alias("loss"))
    return rounded(out.withColumn("kge", 1 - F.col("loss")))


def d06(s, d):
    rows = t.scored(s, d)
    out = rows.groupBy("site", "model").agg(ev.kge_m3s(F.log1p("y"), F.log1p("p")).alias("kge"))
    return rounded(out)


def d07(s, d):
    return rounded(ev.score_per_lead(t.scored(s, d)))


def d08(s, d):
    return rounded(ev.score_by_regime(t.scored(s, d), t.H))


def d09(s, d):
    return rounded(ev.score_by_season(t.scored(s, d), t.H))


def d10(s, d):
    return rounded(ev.metric_cube(t.scored(s, d)))


def _priced(s, d):
    return t.table(s, d, "lineitem").select(F.col("l_returnflag").alias("site"), F.col("l_extendedprice").alias("flow"))


def d11(s, d):
    return rounded(ev.flow_quantiles(_priced(s, d)), 4)


def d11_hourly(s, d):
    return rounded(ev.flow_quantiles(t.hourly(s, d), reference=t.readings(s, d)))


def d12(s, d):
    return rounded(ev.flow_weights(t.dense_hourly(s, d).where(F.col("flow").isNotNull())).select("site", "ts", "flow", "weight"))


def d13(s, d):
    return rounded(ev.skill_vs_persistence(t.scored(s, d), t.H))


def d14(s, d):
    return rounded(ev.error_distribution(t.scored(s, d), t.H))


def d15(s, d):
    return rounded(ev.flood_quality(t.scored(s, d), t.H))


def h16(s, d):
    x = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value") / 7)
    return t.table(s, d, "events").select("event_id", null_safe(x).alias("x"))


def h19(s, d):
    scored = t.scored(s, d)
    rows = ev.score_by_season(scored, t.H).withColumns({"kind": F.lit("season"), "slice": F.col("season")})
    rows = rows.select("site", "kind", "model", "slice", "kge").unionByName(
        ev.score_by_regime(scored, t.H).select("site", F.lit("regime").alias("kind"), "model", F.col("regime").alias("slice"), "kge")
    )
    per_model = rows.groupBy("site", "kind", "model").agg(
        F.map_from_entries(F.collect_list(F.struct("slice", "kge"))).alias("slices")
    )
    nested = per_model.groupBy("site", "kind").agg(
        F.map_from_entries(F.collect_list(F.struct("model", "slices"))).alias("scores")
    )
    return rounded(ev.flatten_metrics(nested))


def j01(s, d):
    """KGE of the last week, at every hour."""
    ax = t.HOURLY
    rows = t.scored(s, d).where((F.col("model") == "persistence") & (F.col("lead") == t.H))
    w = ax.window().rowsBetween(-167, 0)
    parts = ev.kge_parts(F.col("y"), F.col("p"), over=w)
    out = ax.split(rows, back=167).withColumns({"kge": ev.if_enough(parts["n"], parts["kge"]), "n": parts["n"]})
    return rounded(ax.core(out).select("site", "ts", "kge", "n"))


def _drift_long(s, d):
    from rivermill.operators.splits import split_reference_current

    ax = t.HOURLY
    split = ax.split(t.dense_hourly(s, d), back=1)
    w = ax.window()
    df = ax.core(split.withColumns({"step": diff(F.col("flow"), w, 1), "late": F.when(F.dayofmonth("ts") > 25, F.col("flow") * 3).otherwise(F.col("flow"))}))
    cols = ["flow", "step", "late"]
    parts = split_reference_current(materialise(df, "drift-input"), 5)
    return dr.unpivot_columns(parts.select("site", "part", *cols), ["site", "part"], cols)


def l05(s, d):
    return rounded(dr.column_drift(_drift_long(s, d), ["site", "column"]).select("site", "column", "n_reference", "n_current", "ks", "p_value", "drifted"))


def l06(s, d):
    return rounded(dr.dataset_drift(dr.column_drift(_drift_long(s, d), ["site", "column"]), 0.3))


def l07(s, d):
    out = dr.column_drift(_drift_long(s, d), ["site", "column"], "wasserstein")
    return rounded(out.select("site", "column", "wasserstein", "wasserstein_normed", "drifted", "statistic"))


def l07_wide(s, d):
    """All numeric order-line columns, first years against the last, per return flag."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    part = F.when(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"), "reference").otherwise("current")
    rows = t.table(s, d, "lineitem").select(F.col("l_returnflag").alias("site"), part.alias("part"), *cols)
    long = dr.unpivot_columns(rows, ["site", "part"], cols)
    return rounded(dr.column_drift(long, ["site", "column"], "wasserstein").select("site", "column", "ks", "wasserstein_normed", "drifted_ks", "drifted_distance", "statistic"))


def l08(s, d):
    df = t.dense_hourly(s, d).withColumn("late", F.when(F.dayofmonth("ts") > 25, F.col("flow") * 3).otherwise(F.col("flow")))
    short = t.table(s, d, "events").where(F.col("ts") >= F.lit("2024-01-30").cast("timestamp")).select(
        F.concat(F.lit("new-"), "event_type").alias("site"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts"), F.col("value").alias("flow"), F.col("value").alias("late"))
    return rounded(dr.drift_report(df.unionByName(short), ["flow", "late"], 5))


def _gauges(s, d):
    versions = ev.score(t.scored(s, d), ["site", "model"]).select("site", F.when(F.col("model") == "persistence", 1).otherwise(2).alias("version"), "kge")
    drift = dr.dataset_drift(dr.column_drift(_drift_long(s, d), ["site", "column"]), 0.3).withColumn("run_date", F.lit("2024-01-31"))
    return dr.gauges(versions, drift)


def l09(s, d):
    return rounded(_gauges(s, d))


def l10(s, d):
    return dr.alerts(_gauges(s, d))


QUERIES = {
    "d04_kge": d04, "d05_kge_loss": d05, "d06_kge_m3s_guarded": d06, "d07_kge_per_step": d07, "d08_kge_by_regime": d08,
    "d09_kge_by_season": d09, "d10_metric_cube": d10, "d11_flow_quantiles": d11, "d11_flow_quantiles_reference": d11_hourly,
    "d12_flow_weights": d12, "d13_skill_vs_persistence": d13, "d14_error_distribution": d14, "d15_flood_quality": d15,
    "h16_nan_safe": h16, "h19_flatten_metrics": h19, "j01_rolling_kge": j01, "l05_ks_drift": l05, "l06_dataset_drift": l06,
    "l07_wasserstein_drift": l07, "l07_wide_drift": l07_wide, "l08_drift_report": l08, "l09_metric_gauges": l09, "l10_alert_rules": l10,
}

K = kge_sql()
_ALL = rr(**K)
_LOG = kge_sql("ln(1 + y)", "ln(1 + p)")
_M3S = kge_sql("exp(ln(1 + y)) - 1", "exp(ln(1 + p)) - 1")


def _guard(**exprs: str) -> str:
    return rr(**{n: f"CASE WHEN count(*) >= 10 THEN {e} END" for n, e in exprs.items()})


_QUANT = """SELECT site, quantile_cont(flow, 0.15) AS p15, quantile_cont(flow, 0.25) AS p25, quantile_cont(flow, 0.5) AS p50,
  quantile_cont(flow, 0.33) AS q33, quantile_cont(flow, 0.9) AS q90, quantile_cont(flow, 0.99) AS q99 FROM {src} GROUP BY site"""
_REF = "SELECT site, max(flow) / (quantile_cont(flow, 0.99) + 1e-6) AS ratio FROM {src} GROUP BY site"
_START = """CASE WHEN ratio > 3 THEN 15 WHEN ratio > 2 THEN 25 ELSE 50 END AS start_pct"""
_QSTART = "CASE WHEN ratio > 3 THEN p15 WHEN ratio > 2 THEN p25 ELSE p50 END"

_DRIFT = {
    "feat": """SELECT site, ts, flow, flow - lag(flow) OVER (PARTITION BY site ORDER BY ts) AS step, CASE WHEN day(ts) > 25 THEN flow * 3 ELSE flow END AS late FROM dense""",
    "parts": """SELECT f.*, ts >= m - INTERVAL 5 DAY AS cur FROM feat f JOIN (SELECT site, max(ts) AS m FROM dense GROUP BY site) x ON x.site = f.site""",
    "long": """SELECT site, 'flow' AS col, cur, flow AS v FROM parts WHERE flow IS NOT NULL UNION ALL
               SELECT site, 'step', cur, step FROM parts WHERE step IS NOT NULL UNION ALL SELECT site, 'late', cur, late FROM parts WHERE late IS NOT NULL""",
}
_CDF = {
    "cnt": "SELECT site, col, v, count(*) FILTER (WHERE NOT cur) AS a, count(*) FILTER (WHERE cur) AS b FROM long GROUP BY 1, 2, 3",
    "cdf": """SELECT site, col, v, sum(a) OVER w / sum(a) OVER g AS fa, sum(b) OVER w / sum(b) OVER g AS fb, lead(v) OVER w - v AS dv, sum(a) OVER g AS na, sum(b) OVER g AS nb
              FROM cnt WINDOW w AS (PARTITION BY site, col ORDER BY v), g AS (PARTITION BY site, col)""",
    "spread": "SELECT site, col, greatest(stddev_pop(v), 0.001) AS sd FROM long WHERE NOT cur GROUP BY 1, 2",
    "stat": """SELECT c.site, c.col, max(na)::BIGINT AS n_reference, max(nb)::BIGINT AS n_current, max(abs(fa - fb)) AS ks,
                 sum(abs(fa - fb) * coalesce(dv, 0)) AS w, sum(abs(fa - fb) * coalesce(dv, 0)) / any_value(sd) AS wn
               FROM cdf c JOIN spread s ON s.site = c.site AND s.col = c.col GROUP BY 1, 2""",
    "terms": """SELECT s.*, sqrt(n_reference * n_current / (n_reference + n_current)::DOUBLE) * ks AS lam FROM stat s WHERE n_current > 0""",
    "pv": """SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101),
               lambda k: 2.0 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * lam * lam))))) END AS p FROM terms""",
}

ORACLE = {
    "d04_kge": q(f"SELECT site, model, {_ALL}, count(*) AS n FROM pairs GROUP BY 1, 2", "pairs"),
    "d05_kge_loss": q(
        f"""SELECT site, model, lead, {rr(loss='loss', kge='1 - loss')} FROM (
              SELECT site, model, lead, CASE WHEN count(*) < 2 THEN 2.0 WHEN stddev_pop(y) < 1e-6 OR stddev_pop(p) < 1e-6 THEN 1 + abs(avg(p) / (avg(y) + 1e-6) - 1)
                ELSE sqrt(pow(corr(y, p) - 1, 2) + pow(stddev_pop(p) / stddev_pop(y) - 1, 2) + pow(avg(p) / (avg(y) + 1e-6) - 1, 2)) END AS loss
              FROM (SELECT * FROM pairs UNION ALL SELECT site, ts, 'flat', lead, y, 50.0 FROM pairs WHERE false
                    UNION ALL SELECT site, ts, 'flat', lead, y, 50.0::DOUBLE FROM scored WHERE model = 'day_mean' AND y IS NOT NULL) GROUP BY 1, 2, 3)""", "pairs"),
    "d06_kge_m3s_guarded": q(f"SELECT site, model, {rr(kge=_M3S['kge'])} FROM pairs GROUP BY 1, 2", "pairs"),
    "d07_kge_per_step": q(
        f"SELECT site, model, lead, {_guard(**_LOG, rmse='sqrt(avg(pow(p - y, 2)))')} FROM pairs GROUP BY 1, 2, 3", "pairs"),
    "d08_kge_by_regime": q(f"SELECT site, model, regime, {_guard(kge=K['kge'], beta=K['beta'])}, count(*) AS n FROM regimes WHERE lead = 8 GROUP BY 1, 2, 3", "regimes"),
    "d09_kge_by_season": q(
        f"SELECT site, model, season, {_guard(kge=K['kge'], beta=K['beta'])}, count(*) AS n FROM (SELECT *, {SEASON} AS season FROM pairs WHERE lead = 8) GROUP BY 1, 2, 3", "pairs"),
    "d10_metric_cube": q(
        f"""SELECT site, model, CASE WHEN grouping(lead) = 0 THEN 'lead' WHEN grouping(regime) = 0 THEN 'regime' WHEN grouping(season) = 0 THEN 'season' ELSE 'all' END AS slice_kind,
              coalesce(lead::VARCHAR, regime, season, 'all') AS slice, {_guard(**K)}, count(*) AS n
            FROM (SELECT *, {SEASON} AS season FROM regimes) GROUP BY GROUPING SETS ((site, model), (site, model, lead), (site, model, regime), (site, model, season))""", "regimes"),
    "d11_flow_quantiles": q(
        f"SELECT q.site, {_START}, {rr(4, q_start=_QSTART, q33='q33', q90='q90', q99='q99')} FROM q JOIN r ON r.site = q.site",
        extra={"priced": "SELECT l_returnflag AS site, l_extendedprice AS flow FROM lineitem", "q": _QUANT.format(src="priced"), "r": _REF.format(src="priced")}),
    "d11_flow_quantiles_reference": q(
        f"SELECT q.site, {_START}, {rr(q_start=_QSTART, q33='q33', q90='q90', q99='q99')} FROM q JOIN r ON r.site = q.site", "hourly",
        extra={"q": _QUANT.format(src="hourly"), "r": _REF.format(src="readings")}),
    "d12_flow_weights": q(
        f"""SELECT site, ts, {rr(flow='flow', weight='''CASE WHEN flow > q99 THEN 1 + 4 * least((flow - q99) / (q99 - q90 + 1e-6), 3) * 6
               WHEN flow > q90 THEN 1 + 4 * least((flow - q90) / (q99 - q90 + 1e-6), 2) * 2
               WHEN flow > qs THEN 1 + 4 * least((flow - qs) / (q90 - qs + 1e-6), 1) ELSE 1.4 END''')}
            FROM (SELECT h.*, q.*  EXCLUDE (site), {_QSTART} AS qs FROM hourly h JOIN q ON q.site = h.site JOIN r ON r.site = h.site)""", "hourly",
        extra={"q": _QUANT.format(src="hourly"), "r": _REF.format(src="hourly")}),
    "d13_skill_vs_persistence": q(
        f"""SELECT site, model, count(p) AS n, {rr(mse='avg(pow(y - p, 2))', mse_persistence='avg(pow(y - q_now, 2))', kge_persistence=kge_sql('y', 'q_now')['kge'],
                skill='1 - avg(pow(y - p, 2)) / (avg(pow(y - q_now, 2)) + 1e-9)')}
            FROM (SELECT site, 'persistence' AS model, y, persistence AS p, persistence AS q_now FROM forecasts WHERE lead = 8
                  UNION ALL SELECT site, 'day_mean', y, day_mean, persistence FROM forecasts WHERE lead = 8)
            WHERE y IS NOT NULL AND q_now IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 10 AND count(p) >= 10""", "forecasts"),
    "d14_error_distribution": q(
        f"""SELECT site, model, {rr(**{f'p{n}': f'quantile_cont(abs(y - p), {n / 100})' for n in (25, 50, 75, 90, 99)})}, count(*) AS n
            FROM pairs WHERE lead = 8 GROUP BY 1, 2 HAVING count(*) >= 10""", "pairs"),
    "d15_flood_quality": q(
        f"""SELECT site, model, count(*) AS n, {rr(kge=K['kge'], bias_pct='(avg(p) - avg(y)) / avg(y) * 100', over_pct='avg((p > y)::INTEGER) * 100', under_pct='avg((p < y)::INTEGER) * 100')}
            FROM regimes WHERE lead = 8 AND regime = 'flood' GROUP BY 1, 2 HAVING count(*) >= 10""", "regimes"),
    "h16_nan_safe": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN round(value / 7, 4) END AS x FROM events",
    "h19_flatten_metrics": q(
        f"""SELECT site, 'season_' || season || '_' || model AS metric, {rr(kge=K['kge'])} FROM (SELECT *, {SEASON} AS season FROM pairs WHERE lead = 8) GROUP BY site, season, model HAVING count(*) >= 10
            UNION ALL SELECT site, 'regime_' || regime || '_' || model, {rr(kge=K['kge'])} FROM regimes WHERE lead = 8 GROUP BY site, regime, model HAVING count(*) >= 10""", "regimes"),
    "j01_rolling_kge": q(
        f"""SELECT site, ts, {rr(kge="CASE WHEN n >= 10 THEN 1 - sqrt(pow(r - 1, 2) + pow(sp / (sy + 1e-6) - 1, 2) + pow(mp / (my + 1e-6) - 1, 2)) END")}, n
            FROM (SELECT site, ts, corr(yy, pp) OVER w AS r, stddev_pop(pp) OVER w AS sp, stddev_pop(yy) OVER w AS sy, avg(pp) OVER w AS mp, avg(yy) OVER w AS my, count(yy) OVER w AS n
                  FROM (SELECT site, ts, CASE WHEN p IS NOT NULL THEN y END AS yy, CASE WHEN y IS NOT NULL THEN p END AS pp FROM scored WHERE model = 'persistence' AND lead = 8)
                  WINDOW w AS (PARTITION BY site ORDER BY ts ROWS 167 PRECEDING))""", "scored"),
    "l05_ks_drift": q(
        f"SELECT site, col AS \"column\", n_reference, n_current, {rr(ks='ks', p_value='p')}, p < 0.05 AS drifted FROM pv", "dense", extra={**_DRIFT, **_CDF}),
    "l06_dataset_drift": q(
        f"""SELECT site, count(*) AS n_columns, count(*) FILTER (WHERE p < 0.05) AS n_drifted, {rr(share='avg((p < 0.05)::INTEGER)')}, avg((p < 0.05)::INTEGER) >= 0.3 AS dataset_drift
            FROM pv GROUP BY site""", "dense", extra={**_DRIFT, **_CDF}),
    "l07_wasserstein_drift": q(
        f"SELECT site, col AS \"column\", {rr(wasserstein='w', wasserstein_normed='wn')}, wn > 0.1 AS drifted, 'wasserstein' AS statistic FROM pv", "dense", extra={**_DRIFT, **_CDF}),
    "l07_wide_drift": q(
        f"SELECT site, col AS \"column\", {rr(ks='ks', wasserstein_normed='wn')}, p < 0.05 AS drifted_ks, wn > 0.1 AS drifted_distance, 'wasserstein' AS statistic FROM pv",
        extra={"long": " UNION ALL ".join(
            f"SELECT l_returnflag AS site, '{c}' AS col, l_shipdate >= TIMESTAMP '2000-01-01' AS cur, {c} AS v FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")), **_CDF}),
    "l08_drift_report": q(
        f"""SELECT s.site, count(p) AS n_columns, count(*) FILTER (WHERE p < 0.05) AS n_drifted, {rr(share='avg((p < 0.05)::INTEGER)')}, avg((p < 0.05)::INTEGER) >= 0.4 AS dataset_drift, false AS skipped
            FROM (SELECT DISTINCT site FROM dense) s JOIN pv ON pv.site = s.site WHERE col <> 'step' GROUP BY s.site
            UNION ALL SELECT DISTINCT 'new-' || event_type, NULL, NULL, NULL, NULL, true FROM events WHERE ts >= TIMESTAMP '2024-01-30'""", "dense", extra={**_DRIFT, **_CDF}),
    "l09_metric_gauges": q(
        f"""SELECT k.site, {rr(kge='kge', share='share')}, dataset_drift FROM (SELECT site, {K['kge']} AS kge FROM pairs WHERE model = 'day_mean' GROUP BY site) k
            JOIN (SELECT site, avg((p < 0.05)::INTEGER) AS share, avg((p < 0.05)::INTEGER) >= 0.3 AS dataset_drift FROM pv GROUP BY site) d ON d.site = k.site""",
        "pairs", extra={**_DRIFT, **_CDF}),
    "l10_alert_rules": q(
        f"""SELECT site, 'model_quality_low' AS alert FROM (SELECT site, {K['kge']} AS kge FROM pairs WHERE model = 'day_mean' GROUP BY site) WHERE kge < 0.5
            UNION ALL SELECT site, 'input_drift' FROM (SELECT site, avg((p < 0.05)::INTEGER) AS share FROM pv GROUP BY site) WHERE share >= 0.3""",
        "pairs", extra={**_DRIFT, **_CDF}),
}
