"""Training and stacking on Spark ML: one pooled model over all sites, scores still per site."""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis, rolling
from rivermill.functions.columns import cyclic, from_log
from rivermill.functions.ordered import exact_quantiles
from rivermill.operators.evaluate import flow_weights, kge_loss, kge_m3s
from rivermill.operators.flow import flow_features
from rivermill.operators.ridge import Ridge, moments, solve, total
from rivermill.operators.sequences import lead_matrix, trend_slope, weather_lag_block
from rivermill.operators.splits import drop_incomplete, fold_roles, keep_tail, numbered, split_fit_val_test
from rivermill.session import materialise

# Columns always kept by the selection, and the slow ones of which only three may stay.
FORCED = ("lag_24", "lag_36", "max_seen_30d")
SLOW = ("reserve_base", "saturation", "reserve_medium")
TREE_PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "all"}
SEED = 42


def extend_future(df: DataFrame, axis: Axis, horizon: int) -> DataFrame:
    """Adds the next `horizon` rows of each series with missing values."""
    last = df.groupBy(*axis.keys).agg(F.max(axis.ts).alias("_last"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    rows = last.withColumn("_k", ahead).select(
        *axis.keys, F.timestamp_seconds(F.unix_seconds("_last") + F.col("_k") * axis.step).alias(axis.ts)
    )
    return df.unionByName(rows, allowMissingColumns=True)


def model_columns(df: DataFrame) -> list[str]:
    """Features known `horizon` steps ahead; the running maximum holds the current flow and stays out."""
    skip = ("site", "ts", "flow", "q95_year", "max_seen_30d", "decline_vs_max")
    return [c for c in df.columns if c not in skip]


def feature_matrix(df: DataFrame, axis: Axis, horizon: int, columns: list[str] | None = None) -> DataFrame:
    """Training rows: complete features and a known target, label on a log scale."""
    feats = flow_features(df, axis, horizon)
    columns = columns or model_columns(feats)
    rows = drop_incomplete(feats.where(F.col("flow").isNotNull()), columns)
    return rows.select("site", "ts", "flow", F.log1p("flow").alias("label"), *columns)


def future_matrix(df: DataFrame, axis: Axis, horizon: int, columns: list[str] | None = None) -> DataFrame:
    """The same features with the last `horizon` rows kept in any case, missing cells as 0."""
    feats = flow_features(extend_future(df, axis, horizon), axis, horizon)
    columns = columns or model_columns(feats)
    rows = keep_tail(feats, columns, horizon, axis)
    return rows.select("site", "ts", "flow", *columns).na.fill(0.0, subset=columns)


def with_weights(rows: DataFrame) -> DataFrame:
    return flow_weights(rows).drop("start_pct", "q_start", "q33", "q90", "q99")


def fit_trees(rows: DataFrame, columns: list[str], params: dict | None = None, validation: str | None = None) -> PipelineModel:
    """Weighted boosted trees on the log flow; with `validation` (a boolean column) they stop early."""
    trees = GBTRegressor(featuresCol="features", labelCol="label", weightCol="weight", seed=SEED, **{**TREE_PARAMS, **(params or {})})
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    return Pipeline(stages=[*_assembled(columns), trees]).fit(rows)


def _assembled(columns: list[str]) -> list[VectorAssembler]:
    """No stage where the rows carry a vector already (`columns` is then its name, `features`)."""
    return [] if columns == ["features"] else [VectorAssembler(inputCols=columns, outputCol="features")]


def fit_final(rows: DataFrame, axis: Axis, columns: list[str], params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """Final trees on the fit slice, early stopping on the validation slice; also per-slice scores."""
    split = materialise(with_weights(split_fit_val_test(rows, axis)), "fit-rows")
    model = fit_trees(split.where("role <> 'test'").withColumn("is_val", F.col("role") == "val"), columns, params, "is_val")
    scored = model.transform(split).groupBy("site", "role").agg(
        (1 - kge_loss(F.expm1("label"), from_log(F.col("prediction")))).alias("kge"), F.count(F.lit(1)).alias("n")
    )
    return model, scored


def out_of_fold(rows: DataFrame, axis: Axis, columns: list[str], k: int, gap: int, params: dict | None = None) -> DataFrame:
    """Each validation part predicted by trees fitted on earlier rows only; every fold is written out, so a
    lost executor costs one fold at most."""
    base = materialise(numbered(with_weights(rows), axis).withColumn("_folds", fold_roles(k, gap)), "folds")

    def part(fold: int, role: str) -> DataFrame:
        return base.where(F.exists("_folds", lambda f: (f["fold"] == fold) & (f["role"] == role)))

    done = []
    for fold in range(k):
        model = fit_trees(part(fold, "train"), columns, params)
        preds = model.transform(part(fold, "val")).select("site", "ts", F.lit(fold).alias("fold"), "label", F.col("prediction").alias("oof"))
        done.append(materialise(preds, f"oof-{fold}"))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def search(rows: DataFrame, axis: Axis, columns: list[str], grid: list[dict], k: int, gap: int) -> DataFrame:
    """Mean (1 - KGE) over the time folds for every entry of `grid`."""
    scores = None
    for i, params in enumerate(grid):
        oof = out_of_fold(rows, axis, columns, k, gap, params)
        loss = oof.groupBy("fold").agg(kge_loss(F.expm1("label"), from_log(F.col("oof"))).alias("loss"))
        row = loss.agg(F.avg("loss").alias("loss")).select(F.lit(i).alias("candidate"), F.lit(str(params)).alias("params"), "loss")
        scores = row if scores is None else scores.unionByName(row)
    return scores


def feature_importances(rows: DataFrame, columns: list[str], trees: int = 20) -> list[tuple[str, float]]:
    forest = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=5, seed=SEED)
    model = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), forest]).fit(rows)
    return list(zip(columns, [float(v) for v in model.stages[-1].featureImportances.toArray()]))


def slot_importances(matrix: DataFrame, names: list[str], trees: int = 20) -> list[tuple[str, float]]:
    """Importance of every slot of `features`, by name."""
    forest = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=5, seed=SEED)
    return list(zip(names, [float(v) for v in forest.fit(matrix).featureImportances.toArray()]))


def slice_features(matrix: DataFrame, names: list[str], chosen: list[str]) -> DataFrame:
    """`features` cut down to the chosen slots, in their order."""
    at = {name: i for i, name in enumerate(names)}
    cut = VectorSlicer(inputCol="_all", outputCol="features", indices=[at[c] for c in chosen])
    return cut.transform(matrix.withColumnRenamed("features", "_all")).drop("_all")


def choose_features(importances: list[tuple[str, float]], top: int = 50, slow_limit: int = 3) -> list[str]:
    """The most important columns, at most three slow ones, and the forced ones."""
    ranked = [c for c, _ in sorted(importances, key=lambda x: -x[1])][:top]
    names = [c for c, _ in importances]
    slow = [c for c in ranked if re.sub(r"_\d+$", "", c) in SLOW]
    quick = [c for c in ranked if c not in slow]
    forced = [c for c in FORCED if c in names and c not in ranked]
    return quick + slow[:slow_limit] + forced


def permutation_importance(model: PipelineModel, rows: DataFrame, columns: list[str], bucket_rows: int = 1000) -> DataFrame:
    """KGE lost when one column is shuffled. Rows are dealt into random buckets of about `bucket_rows` and
    the values move one place on inside a bucket, so no task orders the whole table."""
    n = max(1, rows.count() // bucket_rows)
    dealt = rows.withColumn("_deal", F.xxhash64("site", "ts"))
    w = Window.partitionBy("_bucket").orderBy("_order")
    dealt = dealt.withColumns({"_bucket": F.pmod("_deal", F.lit(n)), "_order": F.xxhash64("_deal", F.lit(SEED))})
    first = Window.partitionBy("_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = dealt.withColumns({f"_p_{c}": F.coalesce(F.lead(c).over(w), F.first(c).over(first)) for c in columns})
    cases = dealt.withColumn("_case", F.explode(F.array(F.lit(""), *[F.lit(c) for c in columns])))
    swapped = cases.select(
        "_case", "label", *[F.when(F.col("_case") == c, F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    loss = model.transform(swapped).groupBy("_case").agg(kge_loss(F.expm1("label"), from_log(F.col("prediction"))).alias("loss"))
    loss = loss.withColumn("_key", F.lit(1))
    base = loss.where(F.col("_case") == "").select("_key", F.col("loss").alias("_base"))
    return loss.where(F.col("_case") != "").join(base, "_key").select(F.col("_case").alias("feature"), (F.col("loss") - F.col("_base")).alias("kge_drop"))


def sequence_statistics(windows: DataFrame) -> DataFrame:
    """Mean and population spread of every input over all steps of the given (training) windows."""
    cells = windows.select(F.explode("x").alias("row")).select(F.posexplode("row").alias("input", "v"))
    return cells.groupBy("input").agg(F.avg(F.col("v").cast("double")).alias("mean"), F.stddev_pop(F.col("v").cast("double")).alias("std"))


def flatten_windows(windows: DataFrame) -> DataFrame:
    return windows.withColumn("flat", F.flatten("x").cast("array<double>"))


def first_targets(horizon: int) -> Column:
    return F.slice("y", 1, horizon)


def fit_sequence_model(windows: DataFrame, horizon: int, penalty: float = 0.01) -> Ridge:
    """Direct multi-step regression on flattened windows: all leads from one pass; `penalty` per row."""
    m = total(moments(flatten_windows(windows), F.col("flat"), first_targets(horizon)))
    return solve(m, ["flat"], horizon, penalty * m.n, "seq")


def out_of_fold_sequences(windows: DataFrame, axis: Axis, k: int, gap: int, horizon: int, penalty: float = 0.01) -> DataFrame:
    """Each validation window predicted by a model, and a scaling, of earlier windows only: (site, ts, fold, y, seq).

    Windows with the same roles in all folds are summed up once; a fold's training sum is the sum of those, so one pass
    over the windows fits all folds.
    """
    base = materialise(flatten_windows(numbered(windows, axis)).withColumn("_folds", fold_roles(k, gap)), "sequence-folds")
    in_training = F.transform(F.filter("_folds", lambda f: f["role"] == "train"), lambda f: f["fold"].cast("string"))
    parts = moments(base, F.col("flat"), first_targets(horizon), F.array_join(in_training, ","))
    done = None
    for fold in range(k):
        m = total(parts, lambda part: str(fold) in part.split(","))
        held = base.where(F.exists("_folds", lambda f: (f["fold"] == fold) & (f["role"] == "val"))).withColumn("fold", F.lit(fold))
        own = solve(m, ["flat"], horizon, penalty * m.n, "seq").transform(held).select("site", "ts", "fold", "y", "seq")
        done = own if done is None else done.unionByName(own)
    return materialise(done, "sequence-oof")


def predict_sequences(model: Ridge, windows: DataFrame) -> DataFrame:
    return model.transform(flatten_windows(windows)).select("site", "ts", "seq")


def meta_columns(horizon: int, weather: list[str]) -> list[str]:
    return [
        *[f"tree_{k}" for k in range(1, horizon + 1)],
        *[f"seq_{k}" for k in range(1, horizon + 1)],
        "divergence", "q_now_log", "month_sin", "month_cos", "flood", "trend",
        *[f"{c}_lag" for c in weather],
    ]


def meta_features(frame: DataFrame, axis: Axis, horizon: int, weather: list[str], q90: DataFrame | None = None, live: bool = False) -> DataFrame:
    """Inputs of the stacking model, one row per anchor time.

    `frame(site, ts, flow, oof, seq, <weather>)`: `oof` is the tree prediction of each row (log), `seq` the
    sequence prediction for the next steps (log array). Training rows need every prediction; `live` keeps the
    last observed row of each site with missing cells as 0 and the stored `q90(site, q90)`.
    """
    df = lead_matrix(frame, axis, "oof", horizon, "tree")
    df = lead_matrix(df.withColumn("_log", F.log1p("flow")).withColumnRenamed("_log", "log_flow"), axis, "log_flow", horizon, "y")
    df = trend_slope(df, axis)
    df = weather_lag_block(df, axis, weather, horizon) if weather else df
    if live:
        last = frame.where(F.col("flow").isNotNull()).groupBy("site").agg(F.max("ts").alias("ts"))
        df = df.join(last, ["site", "ts"])
    else:
        complete = F.lit(True)
        for name in ("tree", "seq"):
            complete = complete & F.col(name).isNotNull() & ~F.exists(F.coalesce(name, F.array().cast("array<double>")), lambda v: v.isNull())
        df = df.where(complete)
    if q90 is None:
        q90 = target_q90(df)
    df = df.join(q90, "site", "left")
    month_sin, month_cos = cyclic(F.month("ts"), 12)

    def cell(name: str, k: int) -> Column:
        v = F.get(name, F.lit(k - 1))
        return F.coalesce(v, F.lit(0.0)) if live else v

    log_now = F.log1p(F.greatest(F.col("flow"), F.lit(0.0)))
    return df.select(
        "site",
        "ts",
        *[cell("tree", k).alias(f"tree_{k}") for k in range(1, horizon + 1)],
        *[cell("seq", k).alias(f"seq_{k}") for k in range(1, horizon + 1)],
        F.coalesce(F.get("tree", F.lit(horizon - 1)) - F.get("seq", F.lit(horizon - 1)), F.lit(0.0)).alias("divergence"),
        log_now.alias("q_now_log"),
        month_sin.alias("month_sin"),
        month_cos.alias("month_cos"),
        F.when(log_now > F.col("q90"), 1.0).otherwise(0.0).alias("flood"),
        "trend",
        *[f"{c}_lag" for c in weather],
        "y",
    )


def target_q90(rows: DataFrame) -> DataFrame:
    """90th percentile of the log targets of each site."""
    targets = rows.select("site", F.explode("y").alias("v"))
    return exact_quantiles(targets, ["site"], "v", {"q90": 0.9})


def known_targets(meta: DataFrame) -> DataFrame:
    """Rows whose targets and inputs are all present."""
    ok = F.col("y").isNotNull() & ~F.exists(F.coalesce("y", F.array().cast("array<double>")), lambda v: v.isNull())
    return meta.where(ok & F.col("q_now_log").isNotNull())


def fit_ridge(rows: DataFrame, columns: list[str], horizon: int, alpha: float = 1.0, scale: tuple[list[float], list[float]] | None = None) -> Ridge:
    """Ridge with penalty `alpha` on standardised inputs, all leads at once."""
    return solve(total(moments(rows, F.array(*columns), first_targets(horizon))), columns, horizon, alpha, scale=scale)


def stack_parts(meta: DataFrame, axis: Axis, horizon: int, weather: list[str]) -> tuple[DataFrame, dict]:
    """Rows with their role in time, and the sums of every role."""
    split = materialise(split_fit_val_test(known_targets(meta), axis), "meta-rows")
    return split, moments(split, F.array(*meta_columns(horizon, weather)), first_targets(horizon), F.col("role"))


def fit_stacking(meta: DataFrame, axis: Axis, horizon: int, weather: list[str], alpha: float = 1.0) -> tuple[Ridge, DataFrame]:
    """The served model uses all rows; a second one on the fit slice gives honest scores per slice."""
    columns = meta_columns(horizon, weather)
    split, parts = stack_parts(meta, axis, horizon, weather)
    served = solve(total(parts), columns, horizon, alpha)
    probe = solve(total(parts, lambda role: role == "fit"), columns, horizon, alpha, scale=served.scale)
    pairs = probe.transform(split).select("site", "role", F.explode(F.arrays_zip(first_targets(horizon).alias("y"), "stacked")).alias("z"))
    scores = pairs.groupBy("site", "role").agg(kge_m3s(F.col("z.y"), F.col("z.stacked")).alias("kge"), F.count(F.lit(1)).alias("n"))
    return served, scores


def fit_before_holdout(meta: DataFrame, axis: Axis, horizon: int, weather: list[str], alpha: float = 1.0) -> tuple[Ridge, DataFrame]:
    """A model, scaling included, of all rows before each site's holdout, and the rows of the holdout."""
    split, parts = stack_parts(meta, axis, horizon, weather)
    return solve(total(parts, lambda role: role != "test"), meta_columns(horizon, weather), horizon, alpha), split.where("role = 'test'").drop("role", "rn", "n")


def fit_step_trees(meta: DataFrame, axis: Axis, horizon: int, weather: list[str], params: dict | None = None) -> tuple[list[PipelineModel], DataFrame]:
    """Independent boosted trees per lead, each with its own early stopping."""
    columns = meta_columns(horizon, weather)
    split = materialise(split_fit_val_test(known_targets(meta), axis).withColumn("weight", F.lit(1.0)), "meta-rows")
    fit_rows = split.where("role <> 'test'").withColumn("is_val", F.col("role") == "val")
    models, scored = [], split
    for k in range(horizon):
        model = fit_trees(fit_rows.withColumn("label", F.col("y")[k]), columns, params, "is_val")
        models.append(model)
        scored = model.transform(scored).withColumnRenamed("prediction", f"_p{k}").drop("features")
    pairs = scored.select("site", "role", F.explode(F.arrays_zip("y", F.array(*[f"_p{k}" for k in range(horizon)]).alias("p"))).alias("z"))
    return models, pairs.groupBy("site", "role").agg(kge_m3s(F.col("z.y"), F.col("z.p")).alias("kge"), F.count(F.lit(1)).alias("n"))


def test_predictions(meta: DataFrame, stack: Ridge, horizon: int) -> DataFrame:
    """Long form in m3/s: (site, ts, lead, model, y, p). A row with any missing lead is left out as a whole."""
    tree = F.array(*[f"tree_{k}" for k in range(1, horizon + 1)])
    seq = F.array(*[f"seq_{k}" for k in range(1, horizon + 1)])
    rows = stack.transform(known_targets(meta)).withColumns({"tree": tree, "seq": seq})
    step = F.posexplode(F.arrays_zip("y", "tree", "seq", "stacked")).alias("k", "z")
    long = rows.select("site", "ts", step).select(
        "site", "ts", (F.col("k") + 1).alias("lead"), F.expm1("z.y").alias("y"),
        *[from_log(F.col(f"z.{m}")).alias(m) for m in ("tree", "seq", "stacked")],
    )
    return long.unpivot(["site", "ts", "lead", "y"], ["tree", "seq", "stacked"], "model", "p")


def predict_future(live: DataFrame, stack: Ridge, axis: Axis, horizon: int) -> DataFrame:
    """Next `horizon` steps per site: (site, ts, q_tree, q_sequence, q_stacked) in m3/s."""
    tree = F.array(*[f"tree_{k}" for k in range(1, horizon + 1)])
    seq = F.array(*[f"seq_{k}" for k in range(1, horizon + 1)])
    rows = stack.transform(live).withColumns({"tree": tree, "seq": seq})
    step = F.posexplode(F.arrays_zip("tree", "seq", "stacked")).alias("k", "z")
    at = F.timestamp_seconds(F.unix_seconds("ts") + (F.col("k") + 1) * axis.step)
    return rows.select("site", "ts", step).select(
        "site", at.alias("ts"),
        from_log(F.col("z.tree")).alias("q_tree"), from_log(F.col("z.seq")).alias("q_sequence"), from_log(F.col("z.stacked")).alias("q_stacked"),
    )


def evaluation_window(split: DataFrame) -> DataFrame:
    """Rows per role and the span of the holdout, recorded beside the scores."""
    test = F.col("role") == "test"
    return split.groupBy("site").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(~test, 1).otherwise(0)).alias("n_train"),
        F.sum(F.when(test, 1).otherwise(0)).alias("n_test"),
        F.min(F.when(test, F.col("ts"))).alias("test_start"),
        F.max(F.when(test, F.col("ts"))).alias("test_end"),
    )


def fingerprint(rows: DataFrame) -> DataFrame:
    return rows.groupBy("site").agg(F.count(F.lit(1)).alias("n_rows"), F.max("ts").alias("last_ts"))


def reusable(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Whether stored predictions of a site still belong to the current rows (same count, same end)."""
    now = fingerprint(rows)
    old = stored.select("site", F.col("n_rows").alias("_n"), F.col("last_ts").alias("_t"))
    same = F.coalesce((F.col("n_rows") == F.col("_n")) & (F.col("last_ts") == F.col("_t")), F.lit(False))
    return now.join(old, "site", "left").select("site", "n_rows", "last_ts", F.when(same, "reuse").otherwise("compute").alias("action"))


def batch_outcomes(sites: DataFrame, contract: DataFrame, eligibility: DataFrame, decisions: DataFrame) -> DataFrame:
    """What happened to every site of a run; a site in trouble is a row, never an exception for the others."""
    joined = (
        sites.select("site")
        .join(contract.select("site", "ok"), "site", "left")
        .join(eligibility.select("site", "eligible"), "site", "left")
        .join(decisions.select("site", "decision"), "site", "left")
    )
    outcome = (
        F.when(F.col("ok").isNull(), "no_data")
        .when(~F.col("ok"), "contract_broken")
        .when(~F.coalesce("eligible", F.lit(False)), "not_due")
        .when(F.col("decision").isNull(), "no_candidate")
        .otherwise(F.col("decision"))
    )
    return joined.select("site", outcome.alias("outcome"))


def day_mean_log(df: DataFrame, axis: Axis, horizon: int) -> DataFrame:
    """A plain sequence prediction (log of the last day's mean for every lead), used as stand-in base model."""
    w = axis.window()
    mean = F.log1p(rolling(F.avg, F.col("flow"), w, axis.steps_per_day, 1))
    split = axis.split(df, back=axis.steps_per_day)
    return axis.core(split.withColumn("seq", F.array_repeat(mean, horizon)))
