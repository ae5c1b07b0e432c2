import numpy as np
import pytest
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.operators import forecast as fc
from rivermill.operators import prepare as pr
from rivermill.operators import quality as ql
from rivermill.operators import splits as sp
from rivermill.operators import turbine as tb

HOURLY = Axis(("site",), 3600)


def table(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.to_timestamp("ts")) if "ts" in df.columns else df


def test_quarter_hours_become_hours(spark, series):
    df = series([float(i) for i in range(120)], freq="15min")
    rows = pr.hourly_mean(df, HOURLY).orderBy("ts").collect()
    assert len(rows) == 30 and rows[0].flow == 1.5


def test_open_hour_and_stored_hours_stay_out(spark):
    obs = table(spark, [("s", f"2026-01-01 0{h}:{m}:00", 1000.0 * h) for h in (1, 2, 3) for m in ("10", "50")], "station STRING, ts STRING, litres DOUBLE")
    stored = table(spark, [("s", "2026-01-01 01:00:00")], "station STRING, ts STRING")
    rows = pr.closed_hours(obs, stored).collect()
    assert [(r.ts.hour, r.flow) for r in rows] == [(2, 2.0)]


def test_new_rows_win_history_stays_and_rerun_changes_nothing(spark):
    old = table(spark, [("a", "2026-01-01", 1.0), ("a", "2026-01-02", 2.0)], "site STRING, ts STRING, flow DOUBLE")
    new = table(spark, [("a", "2026-01-02", 9.0, 5.0), ("a", "2026-01-03", 3.0, 6.0)], "site STRING, ts STRING, flow DOUBLE, temp DOUBLE")
    once = pr.replace_on_key(old, new, ["site", "ts"])
    twice = pr.replace_on_key(once, new, ["site", "ts"])
    for df in (once, twice):
        assert [(r.flow, r.temp) for r in df.orderBy("ts").collect()] == [(1.0, None), (9.0, 5.0), (3.0, 6.0)]


def test_forecast_wins_but_a_null_never_erases(spark):
    archive = table(spark, [("a", "2026-01-01", 1.0), ("a", "2026-01-02", 1.0)], "site STRING, ts STRING, temp DOUBLE")
    forecast = table(spark, [("a", "2026-01-01", None), ("a", "2026-01-02", 2.0)], "site STRING, ts STRING, temp DOUBLE")
    out = pr.union_prefer_last(archive, forecast, ["site", "ts"], ["temp"]).orderBy("ts").collect()
    assert [r.temp for r in out] == [1.0, 2.0]


def test_update_starts_after_the_last_row_or_at_the_floor(spark):
    from rivermill.sources.weather import ARCHIVE_START

    sites = spark.createDataFrame([("a",), ("b",), ("done",)], "site STRING")
    stored = table(spark, [("a", "2026-01-05 07:00:00"), ("done", "2026-01-09 23:00:00")], "site STRING, ts STRING")
    got = {r.site: (str(r.start_ts), str(r.end_ts)) for r in pr.update_range(sites, stored, ARCHIVE_START, "2026-01-10 09:30:00").collect()}
    end = "2026-01-09 23:00:00"
    assert got == {"a": ("2026-01-05 08:00:00", end), "b": ("2022-11-15 00:00:00", end)}


def test_same_column_from_two_sources_is_an_error(spark, series):
    with pytest.raises(ValueError, match="flow"):
        pr.align_sources([series([1.0]), series([2.0])], ["site", "ts"])


def test_station_is_owned_once(spark):
    uses = spark.createDataFrame([("a", 1, "S1"), ("b", 2, "S1"), ("b", 2, "S2"), ("c", 3, "S3")], "site STRING, site_order INT, station STRING")
    stored = spark.createDataFrame([("S3", "c")], "station STRING, owner STRING")
    got = {(r.site, r.station): r.status for r in pr.station_owner(uses, stored).collect()}
    assert got == {("a", "S1"): "new", ("b", "S1"): "linked", ("b", "S2"): "new", ("c", "S3"): "existing"}


def test_first_valid_is_strict_on_request(spark, series):
    from pyspark.errors import PySparkException

    assert pr.first_valid(series([None, 4.0, 5.0]), "flow", ["site"]).first().flow == 4.0
    with pytest.raises(PySparkException):
        pr.first_valid(series([None, None]), "flow", ["site"], strict=True).collect()


@pytest.mark.parametrize("n", [1, 9, 10, 99, 100, 1003])
def test_slices_cover_every_row(series, n):
    rows = sp.split_fit_val_test(series([1.0] * n), Axis(("site",), 3600, block=64)).orderBy("ts").collect()
    roles = [r.role for r in rows]
    assert roles == ["fit"] * int(n * 0.8) + ["val"] * int(n * 0.1) + ["test"] * (n - int(n * 0.8) - int(n * 0.1))


def test_folds_grow_and_keep_the_gap(series):
    n, k, gap = 100, 4, 8
    rows = sp.time_series_folds(series([1.0] * n), Axis(("site",), 3600, block=16), k, gap).collect()
    size = n // (k + 1)
    for fold in range(k):
        start = n - (k - fold) * size
        assert sorted(r.rn - 1 for r in rows if r.fold == fold and r.role == "val") == list(range(start, start + size))
        assert sorted(r.rn - 1 for r in rows if r.fold == fold and r.role == "train") == list(range(max(0, start - gap)))


def contract(spark, rows, **kw):
    df = table(spark, rows, "site STRING, seq LONG, ts STRING, flow DOUBLE")
    return ql.contract_report(df, **kw).first()


def hours(n, value=10.0, start="2025-01-01"):
    first = np.datetime64(start, "s")
    return [("a", i, str(first + np.timedelta64(i, "h")).replace("T", " "), value) for i in range(n)]


def test_contract(spark):
    assert contract(spark, hours(200 * 24)).ok
    bad = hours(200 * 24)
    bad[5] = ("a", 5, bad[5][2], -1.0)
    assert contract(spark, bad).errors == ["negative_flow"]
    twice = hours(200 * 24)
    twice[6] = ("a", 6, twice[5][2], 10.0)
    assert contract(spark, twice).errors == ["duplicate_ts"]
    empty = contract(spark, hours(10 * 24, None))
    assert empty.errors == ["target_all_missing"] and empty.warnings == []
    back = hours(200 * 24)
    back[6], back[7] = ("a", 6, back[7][2], 1.0), ("a", 7, back[6][2], 1.0)
    assert contract(spark, back).errors == ["not_sorted"]
    short = hours(24) + [("a", 100 + i, t, v) for _, i, t, v in hours(24, start="2025-03-01")]
    assert contract(spark, short).warnings == ["short_history", "long_gaps"]
    strict = contract(spark, short, strict=True)
    assert strict.errors == ["short_history", "long_gaps"] and not strict.ok
    assert contract(spark, hours(3), target="level").errors == ["target_missing"]
    with pytest.raises(ValueError):
        ql.require_ok(ql.contract_report(table(spark, short, "site STRING, seq LONG, ts STRING, flow DOUBLE"), strict=True))


def test_a_target_that_is_no_number_keeps_the_order_errors(spark):
    rows = [("a", 0, "2025-01-01 00:00:00", "x"), ("a", 1, "2025-01-01 02:00:00", "1"), ("a", 2, "2025-01-01 01:00:00", "2"),
            ("a", 3, "2025-01-01 02:00:00", "3"), ("b", 0, "2025-01-01 00:00:00", "1")]
    df = table(spark, rows, "site STRING, seq LONG, ts STRING, flow STRING")
    got = {r.site: (r.errors, r.warnings, r.ok) for r in ql.contract_report(df, sites=spark.createDataFrame([("a",), ("b",), ("c",)], "site STRING")).collect()}
    assert got == {"a": (["not_sorted", "duplicate_ts", "target_not_numeric"], [], False), "b": (["target_not_numeric"], [], False), "c": (["empty"], [], False)}


def test_contract_facts_do_not_depend_on_the_block(spark):
    rows = hours(300)
    rows[40] = ("a", 40, rows[10][2], 10.0)
    df = table(spark, rows, "site STRING, seq LONG, ts STRING, flow DOUBLE")
    assert ql.contract_facts(df, block=7).first() == ql.contract_facts(df).first()


GROUP = "struct<name:string,priority:int,arm_flow:double,max_flow:double,efficiency:array<double>,head:array<struct<q_min:double,q_max:double,coeffs:array<double>>>>"
PLANT = f"site STRING, ts STRING, flow DOUBLE, reserve_flow DOUBLE, reserve_summer DOUBLE, reserve_winter DOUBLE, summer_from INT, summer_to INT, groups ARRAY<{GROUP}>"


def plant(spark, flow, groups, ts="2026-07-15", constant=None, summer=None):
    s, w = summer or (None, None)
    return table(spark, [("a", ts, flow, constant, s, w, 601 if summer else None, 1031 if summer else None, groups)], PLANT)


def points(df):
    return tb.hydraulic_points(df.select("site", "ts", "flow"), df.drop("ts", "flow")).first()


def group(name, priority, arm, top, eff=(80.0,), head=((-1e9, 1e9, [5.0]),)):
    return (name, priority, arm, top, list(eff), list(head))


def test_dispatch_by_priority_and_arming(spark):
    groups = [group("G1", 2, 2.0, 20.0), group("G4", 1, 12.5, 12.5)]
    used = plant(spark, 15.0, groups).select(tb.dispatch(F.col("flow"), F.col("groups")).alias("u")).first().u
    assert used == [12.5, 2.5]
    assert plant(spark, 5.0, [group("G1", 1, 10.0, 20.0)]).select(tb.dispatch(F.col("flow"), F.col("groups"))).first()[0] == [0.0]


@pytest.mark.parametrize("ts,want", [("2026-07-01", 9.0), ("2026-01-10", 5.0), ("2026-11-15", 5.0), ("2026-10-31", 9.0)])
def test_reserve_by_season(spark, ts, want):
    assert plant(spark, 1.0, [], ts, summer=(9.0, 5.0)).select(tb.reserve_flow(F.col("ts"))).first()[0] == want


def test_plant_point_conserves_water(spark):
    groups = [group("G1", 2, 2.0, 20.0, (70.0, 1.0), ((0.0, 10.0, [6.0]), (10.0, 30.0, [5.0, 0.01]))), group("G2", 1, 1.0, 12.0)]
    row = points(plant(spark, 25.0, groups, constant=3.5))
    assert row.usable == 21.5 and row.reserved == 3.5
    head2, head1 = 5.0, 5.25
    want = 12.0 * 0.8 * head2 * 9.81 + 9.5 * (70 + 9.5) / 100 * head1 * 9.81
    assert row.power == pytest.approx(round(want, 1))
    assert row.head == 5.0 and row.efficiency == 80.0
    none = points(plant(spark, 25.0, [], constant=3.5))
    assert (none.usable, none.power, none.head) == (21.5, 0.0, 0.0)


def test_head_outside_all_segments_uses_the_last(spark):
    g = group("G", 1, 0.0, 9.0, head=((0.0, 10.0, [1.0]), (10.0, 20.0, [2.0])))
    df = plant(spark, 50.0, [g])
    assert df.select(tb.head(F.col("groups")[0], F.col("flow"))).first()[0] == 2.0


def test_folder_match_needs_exactly_one(spark):
    reg = spark.createDataFrame([("a", "Valmont", [("G1",)]), ("b", "Élan", [("G2",)]), ("c", "Rive", [("G1",)])], "site STRING, plant STRING, groups ARRAY<STRUCT<name:STRING>>")
    folders = spark.createDataFrame([("Valmont_Sud_G1",), ("elan_haut_G2",), ("elan_bas_g2",), ("Other_G9",)], "folder STRING")
    mapping = spark.createDataFrame([("c", "Other_G9")], "site STRING, mapped STRING")
    got = {r.site: (r.folder, r.status) for r in tb.match_folders(reg, folders, mapping).collect()}
    assert got == {"a": ("Valmont_Sud_G1", "matched"), "b": (None, "unresolved"), "c": ("Other_G9", "mapped")}


def test_eligibility(spark):
    spans = spark.createDataFrame([("short", 300.0), ("new", 400.0), ("due", 400.0), ("wait", 400.0)], "site STRING, span_days DOUBLE")
    models = spark.createDataFrame([("due",), ("wait",)], "site STRING")
    tries = spark.createDataFrame([("due", "2026-01-01"), ("wait", "2026-01-05")], "site STRING, at STRING").select("site", F.to_timestamp("at").alias("attempt_ts"))
    got = {r.site: r.eligible for r in fc.training_eligibility(spans, models, tries, "2026-01-10 00:00:00").collect()}
    assert got == {"short": False, "new": True, "due": True, "wait": False}


def test_unknown_site_is_a_user_error(spark):
    models = spark.createDataFrame([("a", 8, 1, 0.5)], "site STRING, horizon INT, version INT, kge DOUBLE")
    rows = spark.createDataFrame([], "site STRING, source STRING, run_date STRING, ts STRING, q_stacked DOUBLE, q_in DOUBLE")
    for site in ("zzz", "a"):
        with pytest.raises(LookupError):
            fc.lookup_forecast(rows, models, site)


def test_wide_letters_are_folded(spark):
    from rivermill.functions.columns import fold_text

    df = spark.createDataFrame([("㎏ 5",), ("𝐀bc",), ("Élan ﬁn ½",), ("плот x",), (None,)], "t STRING")
    assert [r[0] for r in df.select(fold_text(F.col("t"))).collect()] == ["kg 5", "abc", "elan fin 12", " x", None]
