from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.operators import layout as ly
from rivermill.operators import models as ml

HOURLY = Axis(("site",), 3600)


def hours(n):
    return [datetime(2026, 1, 1) + timedelta(hours=i) for i in range(n)]


T = hours(5)


def flow(spark):
    return spark.createDataFrame([(s, t, 1.0 + i) for s in "ab" for i, t in enumerate(T)], "site STRING, ts TIMESTAMP, flow DOUBLE")


def sources(spark, points):
    lag = flow(spark).withColumn("lag_1", F.col("flow") - 1)
    rows = [(s, p, t, float(10 * p + i), None if s == "b" else float(i)) for s, ps in points.items() for p in ps for i, t in enumerate(T)]
    weather = spark.createDataFrame(rows, "site STRING, point INT, ts TIMESTAMP, temp DOUBLE, snow DOUBLE")
    return [ly.Source("flow", lag, ("lag_1",)), ly.Source("weather", weather, ("temp", "snow"), "point")]


def vectors(df):
    return {(r.site, r.ts): list(map(float, r.features.toArray())) for r in df.collect()}


def test_slots_follow_the_members_of_the_data(spark):
    src = sources(spark, {"a": [1, 2, 3, 4], "b": [2]})
    layout = ly.fit_layout(src)
    assert layout.names() == ["lag_1", *[f"{f}_{p}" for p in (1, 2, 3, 4) for f in ("temp", "snow")]]
    got = vectors(ly.training_rows(layout, src, flow(spark)))
    assert len(got) == 10
    assert got["a", T[3]] == [3.0, 13.0, 3.0, 23.0, 3.0, 33.0, 3.0, 43.0, 3.0]
    # Site b has one point and no snow at all: absent slots are 0 and do not make its rows incomplete.
    assert got["b", T[3]] == [3.0, 23.0] + [0.0] * 7


def test_a_fourth_point_changes_the_result(spark):
    three, four = sources(spark, {"a": [1, 2, 3]}), sources(spark, {"a": [1, 2, 3, 4]})
    old = ly.fit_layout(three)
    assert len(old.names()) == 7 and len(ly.fit_layout(four).names()) == 9
    assert [(r["source"], r.site, r.member) for r in ly.unseen_members(old, four).collect()] == [("weather", "a", "4")]
    assert ly.unseen_members(old, three).isEmpty()
    assert vectors(ly.training_rows(old, four, flow(spark)))["a", T[0]] == vectors(ly.training_rows(old, three, flow(spark)))["a", T[0]]


def test_missing_cells_and_missing_rows_make_a_row_incomplete(spark):
    src = sources(spark, {"a": [1, 2], "b": [1]})
    holes = src[1].rows.where((F.col("point") == 1) | (F.col("ts") != F.lit(T[1])))
    holes = holes.withColumn("temp", F.when((F.col("site") != "b") | (F.col("ts") != F.lit(T[4])), F.col("temp")))
    src = [src[0], ly.Source("weather", holes, ("temp", "snow"), "point")]
    layout = ly.fit_layout(src)
    assert set(vectors(ly.training_rows(layout, src, flow(spark)))) == {
        (s, t) for s in "ab" for t in T if (s, t) not in {("a", T[1]), ("b", T[4])}}
    kept = ly.future_rows(layout, src, HOURLY, flow(spark), 2)
    assert {(r.site, r.ts) for r in kept.where("NOT complete").collect()} == {("b", T[4])}
    assert vectors(kept)["b", T[4]] == [4.0] + [0.0] * 4


def test_a_stored_layout_gives_the_same_vectors(spark, tmp_path):
    src = sources(spark, {"a": [1, 2], "b": [1, 5]})
    layout = ly.fit_layout(src)
    layout.save(str(tmp_path / "layout"))
    again = ly.Layout.load(spark, str(tmp_path / "layout"))
    assert again.names() == layout.names()
    assert vectors(ly.training_rows(again, src, flow(spark))) == vectors(ly.training_rows(layout, src, flow(spark)))


def test_empty_tables_give_empty_rows(spark):
    src = [ly.Source(s.name, s.rows.limit(0), s.features, s.member) for s in sources(spark, {"a": [1]})]
    layout = ly.fit_layout(src)
    assert layout.names() == ["lag_1", "temp", "snow"]
    assert ly.training_rows(layout, src, flow(spark)).isEmpty()


def test_trees_learn_from_a_slot_and_the_rules_choose_by_name(spark):
    rows = [("a", p, t, float(i * p), 1.0) for p in (1, 2) for i, t in enumerate(hours(200))]
    weather = spark.createDataFrame(rows, "site STRING, point INT, ts TIMESTAMP, reserve_base DOUBLE, saturation_diff_6 DOUBLE")
    series = weather.where("point = 1").select("site", "ts", F.pmod("reserve_base", F.lit(7.0)).alias("flow"))
    src = [ly.Source("flow", series.withColumn("lag_24", F.col("flow")), ("lag_24",)),
           ly.Source("weather", weather, ("reserve_base", "saturation_diff_6"), "point")]
    layout = ly.fit_layout(src)
    matrix = ly.training_rows(layout, src, series)
    ranked = ml.slot_importances(matrix, layout.names(), trees=5)
    assert max(ranked, key=lambda x: x[1])[0] == "lag_24" and sum(v for _, v in ranked) == pytest.approx(1.0)
    chosen = ml.choose_features(ranked, top=4, slow_limit=1)
    assert chosen[0] == "lag_24" and sum(c.startswith("reserve_base") for c in chosen) <= 1
    sliced = ml.slice_features(matrix, layout.names(), chosen)
    assert sliced.first().features.size == len(chosen)
    model = ml.fit_trees(sliced.withColumn("weight", F.lit(1.0)), ["features"], {"maxIter": 3, "maxDepth": 3})
    err = model.transform(sliced.withColumn("weight", F.lit(1.0))).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert err < 0.5
