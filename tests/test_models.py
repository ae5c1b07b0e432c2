import numpy as np
import pytest
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.operators import models as ml
from rivermill.operators import sequences as sq

HOURLY = Axis(("site",), 3600)


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(0)
    n, k, h, alpha = 300, 4, 2, 1.0
    x = rng.normal(size=(n, k)) * [1, 5, 0.2, 3] + [0, 2, 1, -4]
    y = x @ rng.normal(size=(k, h)) + rng.normal(size=(n, h))
    cols = [f"c{i}" for i in range(k)]
    rows = [(*map(float, x[i]), [float(v) for v in y[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in cols) + ", y ARRAY<DOUBLE>")
    stack = ml.fit_ridge(df, cols, h, alpha)
    xs = (x - x.mean(0)) / x.std(0)
    yc = y - y.mean(0)
    beta = np.linalg.solve(xs.T @ xs + alpha * np.eye(k), xs.T @ yc)
    for j, m in enumerate(stack.models):
        assert m.coefficients.toArray() == pytest.approx(beta[:, j], rel=1e-6)
    got = np.array([r.stacked for r in stack.transform(df).collect()])
    assert got == pytest.approx(xs @ beta + y.mean(0), rel=1e-6)


def test_selection_keeps_few_slow_columns_and_the_forced_ones():
    imp = [("lag_8", 0.3), ("reserve_base_1", 0.2), ("reserve_base_2", 0.15), ("saturation_1", 0.1), ("reserve_medium_1", 0.09), ("lag_24", 0.0), ("x", 0.05)]
    got = ml.choose_features(imp, top=6)
    assert [c for c in got if c.startswith(ml.SLOW)] == ["reserve_base_1", "reserve_base_2", "saturation_1"]
    assert "lag_24" in got and got[0] == "lag_8"


def test_out_of_fold_rows_never_see_their_future(spark, series):
    n, gap = 120, 4
    rows = series([float(i % 24 + 1) for i in range(n)]).withColumns({"label": F.log1p("flow"), "f": F.hour("ts").cast("double")})
    out = ml.out_of_fold(rows, HOURLY, ["f"], 3, gap, {"maxIter": 2, "maxDepth": 2})
    assert out.count() == 3 * (n // 4)
    assert out.where("oof IS NULL").isEmpty()
    first = out.agg(F.min("ts")).first()[0]
    assert (first.day - 1) * 24 + first.hour == n - 3 * (n // 4)


def test_windows_blank_the_future_target_and_skip_holes(series):
    values = [float(i) for i in range(60)]
    values[30] = None
    out = sq.sliding_sequences(series(values), Axis(("site",), 3600, block=16), 5, 2).orderBy("ts").collect()
    anchors = [(r.ts.day - 1) * 24 + r.ts.hour for r in out]
    want = [t for t in range(4, 58) if not (t - 4 <= 30 <= t + 2)]
    assert anchors == want
    x = np.array(out[0].x)
    assert x.shape == (7, 6)
    assert x[5:, 0].tolist() == [0, 0] and x[:, -1].tolist() == [0] * 5 + [1, 1]
    assert out[0].y == pytest.approx([np.log1p(5), np.log1p(6)])


def test_last_window_fills_holes_with_zero(series):
    values = [float(i) for i in range(40)] + [None, None]
    x = np.array(sq.last_window(series(values), HOURLY, 5, 2).first().x)
    assert x[:5, 0] == pytest.approx(np.log1p([35, 36, 37, 38, 39])) and x[5:, 0].tolist() == [0, 0]


def test_slope_of_a_line_and_too_few_values(series, ordered):
    got = ordered(sq.trend_slope(series([3.0 * i for i in range(100)]), Axis(("site",), 3600, block=40)), "trend")
    assert got[:11] == [0.0] * 11 and got[50] == pytest.approx(3.0) and got[99] == pytest.approx(3.0)


def test_lead_matrix_needs_all_steps(series, ordered):
    got = ordered(sq.lead_matrix(series([float(i) for i in range(6)]), Axis(("site",), 3600, block=4), "flow", 2), "leads")
    assert got == [[1, 2], [2, 3], [3, 4], [4, 5], None, None]


def test_permutation_hurts_the_used_column(spark):
    rng = np.random.default_rng(1)
    rows = [("a", i, float(v), float(rng.normal()), float(np.log1p(v))) for i, v in enumerate(rng.uniform(1, 50, 600))]
    df = spark.createDataFrame(rows, "site STRING, i INT, used DOUBLE, noise DOUBLE, label DOUBLE").withColumns(
        {"ts": F.timestamp_seconds(F.col("i") * 3600), "weight": F.lit(1.0)})
    model = ml.fit_trees(df, ["used", "noise"], {"maxIter": 3, "maxDepth": 3})
    got = {r.feature: r.kge_drop for r in ml.permutation_importance(model, df, ["used", "noise"], bucket_rows=100).collect()}
    assert got["used"] > 0.5 and abs(got["noise"]) < 0.05


def test_outcomes_name_every_site(spark):
    sites = spark.createDataFrame([(s,) for s in "abcde"], "site STRING")
    contract = spark.createDataFrame([("a", False), ("b", True), ("c", True), ("d", True)], "site STRING, ok BOOLEAN")
    due = spark.createDataFrame([("b", False), ("c", True), ("d", True)], "site STRING, eligible BOOLEAN")
    decisions = spark.createDataFrame([("d", "promote")], "site STRING, decision STRING")
    got = {r.site: r.outcome for r in ml.batch_outcomes(sites, contract, due, decisions).collect()}
    assert got == {"a": "contract_broken", "b": "not_due", "c": "no_candidate", "d": "promote", "e": "no_data"}


def test_stacking_end_to_end(spark, series):
    """Trees and day mean on a regular day cycle: the stack must not lose against its inputs."""
    rng = np.random.default_rng(3)
    values = [float(10 + 5 * np.sin(2 * np.pi * i / 24) + rng.normal(0, 0.3)) for i in range(400)]
    df = series(values)
    h = 3
    matrix = ml.feature_matrix(df, HOURLY, h, ["lag_3", "lag_6", "trend_rel"])
    assert matrix.columns == ["site", "ts", "flow", "label", "lag_3", "lag_6", "trend_rel"]
    model, scores = ml.fit_final(matrix, HOURLY, ["lag_3", "lag_6", "trend_rel"], {"maxIter": 5, "maxDepth": 3})
    assert {r.role for r in scores.collect()} == {"fit", "val", "test"}
    oof = model.transform(matrix).select("site", "ts", F.col("prediction").alias("oof"))
    frame = ml.day_mean_log(df, HOURLY, h).join(oof, ["site", "ts"], "left")
    meta = ml.meta_features(frame, HOURLY, h, [])
    assert set(ml.meta_columns(h, [])) <= set(meta.columns)
    stack, per_slice = ml.fit_stacking(meta, HOURLY, h, [])
    assert {r.role: r.kge > 0.8 for r in per_slice.collect()} == {"fit": True, "val": True, "test": True}
    long = ml.test_predictions(meta, stack, h)
    n = ml.known_targets(meta).count()
    assert long.count() == n * h * 3 and long.where("p < 0").isEmpty()
    mse = {r.model: r.mse for r in long.groupBy("model").agg(F.avg(F.pow(F.col("y") - F.col("p"), 2)).alias("mse")).collect()}
    assert mse["stacked"] <= mse["tree"] and mse["stacked"] <= mse["seq"]
    live = ml.meta_features(frame, HOURLY, h, [], ml.target_q90(ml.known_targets(meta)), live=True)
    ahead = ml.predict_future(live, stack, HOURLY, h).orderBy("ts").collect()
    assert len(ahead) == h and all(r.q_stacked >= 0 for r in ahead)
    assert (ahead[0].ts - df.agg(F.max("ts")).first()[0]).total_seconds() == 3600


def test_linear_sequence_model_learns_a_line(spark, series):
    df = series([float(np.expm1(1 + 0.01 * i)) for i in range(120)])
    windows = sq.sliding_sequences(df, HOURLY, 6, 2)
    models = ml.fit_sequence_model(windows, 2)
    joined = ml.predict_sequences(models, windows).join(windows.select("site", "ts", "y"), ["site", "ts"])
    for r in joined.collect():
        assert r.seq == pytest.approx(r.y, abs=0.05)


def test_search_scores_every_candidate(spark, series):
    rows = series([float(i % 24 + 1) for i in range(120)]).withColumns({"label": F.log1p("flow"), "f": F.hour("ts").cast("double")})
    got = ml.search(rows, HOURLY, ["f"], [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 8, "maxDepth": 4}], 2, 2).orderBy("candidate").collect()
    assert [r.candidate for r in got] == [0, 1] and got[1].loss < got[0].loss


def test_importances_and_step_trees_follow_the_signal(spark, series):
    rng = np.random.default_rng(8)
    n = 150
    x = rng.uniform(0, 3, n)
    df = series(x.tolist(), name="tree_1").withColumns(
        {"noise": F.rand(1), "label": F.col("tree_1") * 2, "y": F.array(F.col("tree_1") * 1.0)})
    ranked = dict(ml.feature_importances(df, ["tree_1", "noise"], trees=5))
    assert ranked["tree_1"] > 0.8 and sum(ranked.values()) == pytest.approx(1.0)
    others = {c: F.lit(0.0) for c in ml.meta_columns(1, []) if c != "tree_1"}
    meta = df.select("site", "ts", "tree_1", "y").withColumns({**others, "q_now_log": F.col("tree_1")})
    models, scores = ml.fit_step_trees(meta, HOURLY, 1, [], {"maxIter": 10, "maxDepth": 4})
    got = {r.role: (r.n, r.kge) for r in scores.collect()}
    assert len(models) == 1 and {k: v[0] for k, v in got.items()} == {"fit": 120, "val": 15, "test": 15}
    assert all(v[1] > 0.8 for v in got.values())
