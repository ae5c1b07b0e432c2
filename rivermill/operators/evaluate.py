"""Forecast scoring: Kling-Gupta efficiency and friends, by site, model, lead, regime and season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from rivermill.functions.blocks import Axis, rolling
from rivermill.functions.columns import EPS, from_log, season
from rivermill.functions.ordered import exact_quantiles

MIN_PAIRS = 10


def correlation(y: Column, p: Column, on=lambda agg: agg) -> Column:
    """Pearson correlation; NULL without spread (the built-in fails there in ANSI mode)."""
    return F.try_divide(on(F.covar_pop(y, p)), on(F.stddev_pop(y)) * on(F.stddev_pop(p)))


def _pair(y: Column, p: Column) -> tuple[Column, Column]:
    both = y.isNotNull() & p.isNotNull()
    return F.when(both, y), F.when(both, p)


def kge_parts(y: Column, p: Column, over: WindowSpec | None = None) -> dict[str, Column]:
    """kge, r, alpha, beta and n over complete pairs (population spread); aggregates, or windows with `over`."""
    y, p = _pair(y, p)

    def on(agg: Column) -> Column:
        return agg if over is None else agg.over(over)

    r = correlation(y, p, on)
    alpha = on(F.stddev_pop(p)) / (on(F.stddev_pop(y)) + EPS)
    beta = on(F.avg(p)) / (on(F.avg(y)) + EPS)
    score = 1 - F.sqrt(F.pow(r - 1, 2) + F.pow(alpha - 1, 2) + F.pow(beta - 1, 2))
    return {"kge": score, "r": r, "alpha": alpha, "beta": beta, "n": on(F.count(y))}


def kge(y: Column, p: Column) -> Column:
    return kge_parts(y, p)["kge"]


def kge_loss(y: Column, p: Column) -> Column:
    """1 - KGE with guards: too few pairs 2.0, no spread only the bias, undefined correlation as 0."""
    y, p = _pair(y, p)
    n, sy, sp = F.count(y), F.stddev_pop(y), F.stddev_pop(p)
    beta = F.avg(p) / (F.avg(y) + EPS)
    r = F.coalesce(correlation(y, p), F.lit(0.0))
    full = F.sqrt(F.pow(r - 1, 2) + F.pow(F.try_divide(sp, sy) - 1, 2) + F.pow(beta - 1, 2))
    flat = (sy < EPS) | (sp < EPS)
    return F.when(n < 2, 2.0).when(flat, 1 + F.abs(beta - 1)).otherwise(full)


def kge_m3s(y_log: Column, p_log: Column) -> Column:
    """KGE in m3/s from log targets; NULL when the observed spread is only rounding noise."""
    y, p = _pair(F.expm1(y_log), from_log(p_log))
    steady = F.stddev_pop(y) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(F.avg(y)))
    return F.when((F.count(y) >= 2) & ~steady, kge(y, p))


def if_enough(n: Column, x: Column, least: int = MIN_PAIRS) -> Column:
    return F.when(n >= least, x)


def naive_forecasts(df: DataFrame, axis: Axis, horizon: int, value: str = "flow") -> DataFrame:
    """Persistence and day-mean forecasts for leads 1..horizon, one row per (site, ts, model, lead)."""
    w = axis.window()
    q = F.col(value)
    split = axis.split(df.select(*axis.keys, axis.ts, value), back=axis.steps_per_day + horizon)
    day_mean = rolling(F.avg, q, w, axis.steps_per_day, 1)
    split = split.withColumn("_mean", day_mean)
    rows = []
    for lead in range(1, horizon + 1):
        for name, col in (("persistence", q), ("day_mean", F.col("_mean"))):
            rows.append(F.struct(F.lit(name).alias("model"), F.lit(lead).alias("lead"), F.lag(col, lead).over(w).alias("p")))
    wide = axis.core(split.withColumn("forecasts", F.array(*rows)))
    return wide.select(*axis.keys, axis.ts, q.alias("y"), F.inline("forecasts"))


def flow_thresholds(df: DataFrame, value: str = "y", keys: tuple[str, ...] = ("site",)) -> DataFrame:
    return exact_quantiles(df, list(keys), value, {"q33": 0.33, "q90": 0.90})


def regime(y: Column) -> Column:
    return F.when(y <= F.col("q33"), "low").when(y <= F.col("q90"), "normal").when(y > F.col("q90"), "flood")


def observed(scored: DataFrame) -> DataFrame:
    """Each observed value once, from the long table of forecasts."""
    return scored.where((F.col("model") == "persistence") & (F.col("lead") == 1)).select("site", "ts", "y")


def with_regime(scored: DataFrame) -> DataFrame:
    limits = flow_thresholds(observed(scored))
    return scored.join(limits, "site").withColumn("regime", regime(F.col("y")))


def score(scored: DataFrame, keys: list[str]) -> DataFrame:
    return scored.groupBy(*keys).agg(*[c.alias(n) for n, c in kge_parts(F.col("y"), F.col("p")).items()])


def score_per_lead(scored: DataFrame) -> DataFrame:
    """KGE on log flow and RMSE in m3/s per lead."""
    y, p = _pair(F.col("y"), F.col("p"))
    parts = kge_parts(F.log1p(y), F.log1p(p))
    rmse = F.sqrt(F.avg(F.pow(p - y, 2)))
    return scored.groupBy("site", "model", "lead").agg(
        *[if_enough(parts["n"], parts[c]).alias(c) for c in ("kge", "r", "alpha", "beta")],
        if_enough(parts["n"], rmse).alias("rmse"),
    )


def score_by(scored: DataFrame, label: str) -> DataFrame:
    parts = kge_parts(F.col("y"), F.col("p"))
    return (
        scored.where(F.col(label).isNotNull())
        .groupBy("site", "model", label)
        .agg(
            if_enough(parts["n"], parts["kge"]).alias("kge"),
            if_enough(parts["n"], parts["beta"]).alias("beta"),
            parts["n"].alias("n"),
        )
    )


def score_by_regime(scored: DataFrame, lead: int) -> DataFrame:
    return score_by(with_regime(scored.where(F.col("lead").isin(1, lead))).where(F.col("lead") == lead), "regime")


def score_by_season(scored: DataFrame, lead: int) -> DataFrame:
    rows = scored.where(F.col("lead") == lead).where(F.col("y").isNotNull())
    return score_by(rows.withColumn("season", season(F.col("ts"))), "season")


def metric_cube(scored: DataFrame) -> DataFrame:
    """Whole, per lead, per regime and per season in one pass of grouping sets."""
    rows = with_regime(scored).withColumn("season", season(F.col("ts"))).where(F.col("y").isNotNull())
    s, m = F.col("site"), F.col("model")
    sets = [[s, m], [s, m, F.col("lead")], [s, m, F.col("regime")], [s, m, F.col("season")]]
    parts = kge_parts(F.col("y"), F.col("p"))
    kind = (
        F.when(F.grouping("lead") == 0, "lead")
        .when(F.grouping("regime") == 0, "regime")
        .when(F.grouping("season") == 0, "season")
        .otherwise("all")
    )
    cube = rows.groupingSets(sets, s, m, "lead", "regime", "season").agg(
        kind.alias("slice_kind"),
        *[if_enough(parts["n"], parts[c]).alias(c) for c in ("kge", "r", "alpha", "beta")],
        parts["n"].alias("n"),
    )
    label = F.coalesce(F.col("lead").cast("string"), "regime", "season", F.lit("all"))
    return cube.select("site", "model", "slice_kind", label.alias("slice"), "kge", "r", "alpha", "beta", "n")


def flow_quantiles(df: DataFrame, value: str = "flow", keys: tuple[str, ...] = ("site",), reference: DataFrame | None = None) -> DataFrame:
    """q90, q99 and the start of the weighting zone, whose percentile follows the extreme ratio of the reference."""
    keys = list(keys)
    probs = {"_p15": 0.15, "_p25": 0.25, "_p50": 0.50, "q33": 0.33, "q90": 0.90, "q99": 0.99}
    if reference is None:
        limits = exact_quantiles(df, keys, value, {**probs, "_peak": 1.0}).withColumn("_ref99", F.col("q99"))
    else:
        extremes = exact_quantiles(reference, keys, value, {"_ref99": 0.99, "_peak": 1.0})
        limits = exact_quantiles(df, keys, value, probs).join(extremes, keys)
    ratio = F.col("_peak") / (F.col("_ref99") + EPS)
    pct = F.when(ratio > 3, 15).when(ratio > 2, 25).otherwise(50)
    start = F.when(ratio > 3, F.col("_p15")).when(ratio > 2, F.col("_p25")).otherwise(F.col("_p50"))
    return limits.select(*keys, pct.alias("start_pct"), start.alias("q_start"), "q33", "q90", "q99")


def flow_weights(df: DataFrame, value: str = "flow", strength: float = 4.0, keys: tuple[str, ...] = ("site",)) -> DataFrame:
    """Training weight by flow zone: normal, rising, flood, extreme."""
    q = F.col(value)

    def above(limit: str, lo: str, hi: str, top: float) -> Column:
        x = F.greatest(F.lit(0.0), q - F.col(limit)) / (F.col(hi) - F.col(lo) + EPS)
        return F.least(x, F.lit(top))

    weight = (
        F.when(q > F.col("q99"), 1 + strength * above("q99", "q90", "q99", 3.0) * 6)
        .when(q > F.col("q90"), 1 + strength * above("q90", "q90", "q99", 2.0) * 2)
        .when(q > F.col("q_start"), 1 + strength * above("q_start", "q_start", "q90", 1.0))
        .when(q.isNotNull(), F.lit(1 + 0.1 * strength))
    )
    return df.join(flow_quantiles(df, value, keys), list(keys)).withColumn("weight", weight)


def skill_vs_persistence(scored: DataFrame, lead: int) -> DataFrame:
    """Error of each model against "the flow stays as it is"."""
    at = scored.where(F.col("lead") == lead)
    base = at.where(F.col("model") == "persistence").select("site", "ts", F.col("p").alias("q_now"))
    rows = at.join(base, ["site", "ts"]).where(F.col("q_now").isNotNull() & F.col("y").isNotNull())
    y, p = _pair(F.col("y"), F.col("p"))
    sums = rows.groupBy("site", "model").agg(
        F.count(p).alias("n"),
        F.count(F.lit(1)).alias("_base"),
        F.avg(F.pow(y - p, 2)).alias("mse"),
        F.avg(F.pow(F.col("y") - F.col("q_now"), 2)).alias("mse_persistence"),
        kge(F.col("y"), F.col("q_now")).alias("kge_persistence"),
    )
    enough = (F.col("_base") > MIN_PAIRS) & (F.col("n") >= MIN_PAIRS)
    return (
        sums.where(enough)
        .withColumn("skill", 1 - F.col("mse") / (F.col("mse_persistence") + 1e-9))
        .drop("_base")
    )


def error_distribution(scored: DataFrame, lead: int) -> DataFrame:
    rows = scored.where(F.col("lead") == lead).select("site", "model", F.abs(F.col("y") - F.col("p")).alias("ae"))
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
    counts = rows.groupBy("site", "model").agg(F.count("ae").alias("n")).where(F.col("n") >= MIN_PAIRS)
    return exact_quantiles(rows, ["site", "model"], "ae", probs).join(counts, ["site", "model"])


def flood_quality(scored: DataFrame, lead: int) -> DataFrame:
    """KGE, bias and share of over- and under-estimation above q90 of the observed flow."""
    rows = with_regime(scored.where(F.col("lead").isin(1, lead))).where(
        (F.col("lead") == lead) & (F.col("regime") == "flood") & F.col("p").isNotNull()
    )
    y, p = F.col("y"), F.col("p")
    return (
        rows.groupBy("site", "model")
        .agg(
            F.count(y).alias("n"),
            kge(y, p).alias("kge"),
            (F.try_divide(F.avg(p) - F.avg(y), F.avg(y)) * 100).alias("bias_pct"),
            (F.avg((p > y).cast("double")) * 100).alias("over_pct"),
            (F.avg((p < y).cast("double")) * 100).alias("under_pct"),
        )
        .where(F.col("n") >= MIN_PAIRS)
    )


def flatten_metrics(results: DataFrame) -> DataFrame:
    """Nested {model: {slice: kge}} documents as flat named rows."""
    from rivermill.functions.columns import slug

    models = results.select("site", "kind", F.explode("scores").alias("model", "slices"))
    cells = models.select("site", "kind", "model", F.explode("slices").alias("slice", "kge"))
    name = F.concat_ws("_", "kind", slug(F.col("slice")), slug(F.col("model")))
    return cells.where(F.col("kge").isNotNull()).select("site", name.alias("metric"), "kge")


def compare_models(candidate: DataFrame, production: DataFrame) -> DataFrame:
    """Same holdout rows for both, strict improvement promotes; sites without production train first."""
    keys = ["site", "ts", "lead"]
    joined = candidate.select(*keys, "y", F.col("p").alias("p_new")).join(
        production.select(*keys, F.col("p").alias("p_old")), keys, "left"
    )
    known = production.select("site").distinct().withColumn("has_old", F.lit(True))
    both = F.col("p_new").isNotNull() & F.col("p_old").isNotNull()
    first = F.col("has_old").isNull()
    y = F.when(both | first, F.col("y"))
    scores = (
        joined.join(known, "site", "left")
        .groupBy("site")
        .agg(
            kge(y, F.when(both | first, F.col("p_new"))).alias("kge_candidate"),
            kge(y, F.when(both, F.col("p_old"))).alias("kge_production"),
            F.max(F.coalesce("has_old", F.lit(False))).alias("_old"),
        )
    )
    decision = (
        F.when(~F.col("_old"), "first_training")
        .when(F.col("kge_candidate") > F.col("kge_production"), "promote")
        .otherwise("keep")
    )
    return scores.withColumn("decision", decision).drop("_old")
