import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
SAMPLE = ["a10_scan_site_registry", "b07_time_series_folds", "c04_seasonal_transit_join", "d10_metric_cube", "g06_station_dedup",
          "h14_hydraulic_point", "i01_stream_hourly_mean", "l05_ks_drift", "w10_baseflow_ewm", "w17_snow_stock_melt", "w29_saturation_index"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["site", "model", "slice_kind", "slice", "kge", "r", "alpha", "beta", "n"]
    assert df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_result_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    res = duck.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(res.columns) == columns
    order = [list(res.columns).index(c) for c in columns]
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    assert got == sorted(repr([r[i] for i in order]) for r in res.fetchall())
