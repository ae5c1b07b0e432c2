"""Plant records and folder keys take many times the memory of the file they come from: none of them is broadcast."""

import datetime as dt

import pytest

from rivermill.operators import turbine as tb
from rivermill.plans import source_queries, turbine_queries
from rivermill.plans import tables as t

DAY = dt.datetime(2024, 1, 10)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Parts 0 to 39, order lines of two of them and of an unknown one, readings of three sites."""
    d = str(tmp_path_factory.mktemp("plants"))

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")

    put("part", [(k, "hot bolt", k + 1, 900.0 + k) for k in range(40)], "p_partkey LONG, p_name STRING, p_size INT, p_retailprice DOUBLE")
    put("lineitem", [(1, 3, 1, 30.0, DAY), (2, 4, 1, 30.0, DAY), (3, 99, 1, 30.0, DAY), (4, 5, 2, 0.5, DAY)], "l_orderkey LONG, l_partkey LONG, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP")
    put("events", [(k, DAY + dt.timedelta(hours=k), k, ("view", "error", "sea")[k % 3], 10.0 + k, "{}") for k in range(600)],
        "event_id LONG, ts TIMESTAMP, user_id LONG, event_type STRING, value DOUBLE, props STRING")
    return d


def test_plants_are_picked_without_a_broadcast_of_the_parts(spark, store):
    got = t.plants(spark, store)
    assert "SortMergeJoin" in plan(got) and "BroadcastHashJoin" not in plan(got)
    rows, whole = {r.site: r for r in got.collect()}, {r.site_order: r for r in t.registry(spark, store).collect()}
    assert set(rows) == {"view", "error", "sea"}  # keys 12, 15 and 9
    for site, r in rows.items():
        want = whole[3 * len(site)].asDict(recursive=True)
        assert r.asDict(recursive=True) == {**{k: v for k, v in want.items() if k != "site_order"}, "site": site}


def test_points_meet_plants_without_a_broadcast(spark, store):
    got = tb.hydraulic_points(t.inflow(spark, store), t.registry(spark, store))
    assert "SortMergeJoin" in plan(got) and "BroadcastHashJoin" not in plan(got)
    assert sorted(r.l_orderkey for r in got.collect()) == [1, 2, 4]


def test_archive_holds_every_site(spark, store):
    rows = source_queries.a14(spark, store).collect()
    assert sorted(r.site for r in rows) == ["error", "sea", "view", "view"] and all(r.n_points > 0 for r in rows)


@pytest.mark.parametrize("query", ["h10", "h11", "h12", "h13"])
def test_flow_meets_plants_without_a_broadcast(spark, store, query):
    got = getattr(turbine_queries, query)(spark, store)
    assert "SortMergeJoin" in plan(got) and "BroadcastHashJoin" not in plan(got)


def test_dispatch_of_every_order_line(spark, store):
    rows = turbine_queries.h13(spark, store).collect()
    assert sorted((r.site, r["rank"]) for r in rows) == [("P3", 0), ("P3", 1), ("P3", 2), ("P5", 0)]
    assert sum(r.used for r in rows if r.site == "P3") <= 30.0


def test_only_keyword_lengths_are_broadcast_to_match_folders(spark):
    reg = spark.createDataFrame([("a", "Valmont", [("G1",)]), ("b", "Rive", [("G1",), (None,)]), ("c", None, None)], "site STRING, plant STRING, groups ARRAY<STRUCT<name:STRING>>")
    folders = spark.createDataFrame([("Valmont_G1",), ("Rive_haut_G1",), ("rive_bas_g1",), (None,)], "folder STRING")
    mapping = spark.createDataFrame([("c", "gone")], "site STRING, mapped STRING")
    got = tb.match_folders(reg, folders, mapping)
    assert plan(got).count("BroadcastHashJoin") == 1 and plan(got).count("SortMergeJoin") == 4
    assert {(r.site, r.folder, r.candidates, r.status) for r in got.collect()} == {("a", "Valmont_G1", 1, "matched"), ("b", None, 2, "unresolved"), ("c", None, 0, "unresolved")}
