import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.operators import models as ml
from rivermill.operators import ridge
from rivermill.operators import sequences as sq

HOURLY = Axis(("site",), 3600)


def closed_form(x, y, alpha):
    mean, spread = x.mean(0), x.std(0)
    spread[spread == 0] = 1
    xs = (x - mean) / spread
    beta = np.linalg.solve(xs.T @ xs + alpha * np.eye(x.shape[1]), xs.T @ (y - y.mean(0)))
    return beta, lambda new: ((new - mean) / spread) @ beta + y.mean(0)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n, d, h = 500, 6, 3
    x = rng.normal(size=(n, d)) * [1, 5, 0.2, 3, 1e-3, 1] + [0, 2, 1e6, -4, 0, 0]
    x[:, 5] = 7.5  # constant
    y = x[:, :5] @ rng.normal(size=(5, h)) + rng.normal(size=(n, h))
    rows = [(k % 3, [float(v) for v in x[k]], [float(v) for v in y[k]]) for k in range(n)]
    return x, y, spark.createDataFrame(rows, "part INT, x ARRAY<DOUBLE>, y ARRAY<DOUBLE>")


def test_equal_to_the_closed_form_for_any_partitions(data):
    x, y, df = data
    for p in (1, 7):
        m = ridge.total(ridge.moments(df.repartition(p), F.col("x"), F.col("y")))
        beta, predict = closed_form(x, y, 2.5)
        model = ridge.solve(m, ["x"], 3, 2.5)
        assert np.array([c.coefficients.toArray() for c in model.models]).T == pytest.approx(beta, rel=1e-8, abs=1e-10)
        got = {tuple(r.x): r.stacked for r in model.transform(df).collect()}
        assert np.array([got[tuple(v)] for v in x.tolist()]) == pytest.approx(predict(x), rel=1e-8)


def test_parts_add_up(data):
    x, y, df = data
    parts = ridge.moments(df, F.col("x"), F.col("y"), F.col("part"))
    assert set(parts) == {"0", "1", "2"}
    own = np.arange(len(x)) % 3 != 1
    both = ridge.solve(ridge.total(parts, lambda p: p != "1"), ["x"], 3, 1.0)
    assert np.array([c.coefficients.toArray() for c in both.models]).T == pytest.approx(closed_form(x[own], y[own], 1.0)[0], rel=1e-8, abs=1e-10)
    with pytest.raises(ValueError):
        ridge.total(parts, lambda p: False)


def test_incomplete_rows_count_for_nothing(spark):
    rows = [(float(k), [k * 2.0]) for k in range(9)]
    odd = [(None, [1.0]), (3.0, [None]), (float("nan"), [4.0]), (5.0, None)]
    frame = lambda r: spark.createDataFrame(r, "a DOUBLE, y ARRAY<DOUBLE>")
    a, b = (ridge.total(ridge.moments(frame(r), F.array("a"), F.col("y"))) for r in (rows, rows + odd))
    assert a.n == b.n == 9 and (a.products == b.products).all()


def test_saved_model_predicts_the_same(data, tmp_path):
    _, _, df = data
    model = ridge.solve(ridge.total(ridge.moments(df, F.col("x"), F.col("y"))), ["x"], 3, 1.0)
    model.write().overwrite().save(str(tmp_path / "m"))
    want, got = (m.transform(df).select("stacked").collect() for m in (model, ridge.Ridge.load(str(tmp_path / "m"))))
    assert want == got


def test_unchanged_rows_reuse_the_model_and_changed_ones_refit(data, tmp_path):
    _, _, df = data
    calls = []

    def fit(rows):
        calls.append(1)
        return ridge.solve(ridge.total(ridge.moments(rows, F.col("x"), F.col("y"))), ["x"], 3, 1.0)

    first, _ = ridge.fit_or_load(df, str(tmp_path), fit)
    second, reused = ridge.fit_or_load(df.repartition(5), str(tmp_path), fit)
    assert reused and len(calls) == 1 and [m.intercept for m in first.models] == [m.intercept for m in second.models]
    for changed in (df.limit(499), df.unionByName(df.limit(1)), df.withColumn("part", F.col("part") + 1), df.withColumnRenamed("part", "role")):
        assert not ridge.fit_or_load(changed, str(tmp_path), fit)[1]
    assert len(calls) == 5


def test_every_fold_is_fitted_on_its_own_past(spark, series):
    rng = np.random.default_rng(2)
    df = series([float(10 + 5 * np.sin(k / 4) + rng.normal(0, 0.5)) for k in range(150)])
    windows = sq.sliding_sequences(df, HOURLY, 6, 2)
    rows = windows.orderBy("ts").collect()
    x, y = (np.array([np.ravel(r[c]) for r in rows], float) for c in ("x", "y"))
    n, k, gap = len(rows), 3, 2
    got = {r.ts: (r.fold, r.seq) for r in ml.out_of_fold_sequences(windows, HOURLY, k, gap, 2, 0.05).collect()}
    size = n // (k + 1)
    assert len(got) == k * size
    for fold in range(k):
        start = n - (k - fold) * size
        past = slice(0, start - gap)
        _, predict = closed_form(x[past], y[past], 0.05 * (start - gap))
        for i in range(start, start + size):
            assert got[rows[i].ts][0] == fold and got[rows[i].ts][1] == pytest.approx(predict(x[i]), rel=1e-7)


def test_holdout_is_split_before_fitting(spark, series):
    h, rng = 2, np.random.default_rng(4)
    df = series([float(v) for v in rng.uniform(1, 9, 200)])
    rows = df.select("site", "ts", F.array(F.log1p("flow"), F.log1p("flow") * 2).alias("y"), F.log1p("flow").alias("q_now_log"))
    meta = rows.withColumns({c: F.lit(0.0) for c in ml.meta_columns(h, []) if c != "q_now_log"})
    spoiled = meta.withColumn("y", F.when(F.row_number().over(Window.partitionBy("site").orderBy("ts")) > 180, F.array(F.lit(1e6), F.lit(-1e6))).otherwise(F.col("y")))
    (a, kept), (b, spoiled_rows) = (ml.fit_before_holdout(m, HOURLY, h, []) for m in (meta, spoiled))
    assert kept.count() == 20 == spoiled_rows.count() and [m.intercept for m in a.models] == [m.intercept for m in b.models]

