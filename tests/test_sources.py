import json

import pytest
from pyspark.sql import functions as F

from rivermill.sources import flow as fl
from rivermill.sources import registry as rg
from rivermill.sources import tables as st
from rivermill.sources import weather as wx


def test_station_file_with_byte_order_mark(spark, tmp_path):
    text = "﻿Date (TU);Valeur (en m³/s)\n2026-01-01T00:00:00Z;1.500\n2026-01-01T01:00:00Z;\n"
    (tmp_path / "amont_O1.csv").write_text(text, encoding="utf-8")
    rows = fl.read_flow_csv(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r.station, r.ts.hour, r.flow) for r in rows] == [("O1", 0, 1.5), ("O1", 1, None)]


def test_absent_path_is_an_empty_series(spark, tmp_path):
    df = fl.read_flow_csv(spark, str(tmp_path / "nothing"))
    assert df.columns == ["station", "ts", "flow"] and df.isEmpty()


def test_flow_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", "2026-01-01 00:00:00", 1.2346), ("A", "2026-01-01 01:00:00", None)], "station STRING, ts STRING, flow DOUBLE").withColumn("ts", F.to_timestamp("ts"))
    path = str(tmp_path / "out")
    fl.write_flow_csv(df, path)
    assert [(r.ts.hour, r.flow) for r in fl.read_flow_csv(spark, path).orderBy("ts").collect()] == [(0, 1.235), (1, None)]
    assert fl.read_flow_csv(spark, path).where("flow IS NULL").count() == 1


def test_pages_and_series(spark, tmp_path):
    page = {"station": "A", "next": "2", "data": [{"date_obs": "2026-01-01T00:05:00Z", "resultat_obs": 1500.0}, {"date_obs": None, "resultat_obs": 1.0}]}
    last = {"station": "A", "next": None, "data": [{"date_obs": "2026-01-01T00:10:00Z", "resultat_obs": None}, {"date_obs": "2026-01-01T00:15:00Z", "resultat_obs": 2500.0}]}
    (tmp_path / "p.json").write_text(json.dumps(page) + "\n" + json.dumps(last))
    assert [r.litres for r in fl.read_observation_pages(spark, str(tmp_path / "p.json")).orderBy("ts").collect()] == [1500.0, 2500.0]
    docs = [{"station": "A", "series": {"data": [{"t": "2026-01-01T00:00:00Z", "v": 1234.0}, {"t": "2026-01-01T01:00:00Z", "v": None}]}}, {"station": "B"}, {"station": "C", "series": {}}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, docs)))
    assert [(r.station, r.flow) for r in fl.read_series(spark, str(tmp_path / "s.json")).orderBy("ts").collect()] == [("A", 1.234), ("A", None)]


def test_chunks_touch_and_do_not_overlap(spark):
    wanted = spark.sql("SELECT 'A' AS station, date'2022-11-15' AS start_day, date'2024-01-10' AS end_day")
    rows = fl.range_chunks(wanted).orderBy("chunk").collect()
    assert rows[0].from_day.isoformat() == "2022-11-15" and rows[-1].to_day.isoformat() == "2024-01-10"
    for a, b in zip(rows, rows[1:]):
        assert (b.from_day - a.to_day).days == 1 and (a.to_day - a.from_day).days == 179


def test_weather_hours_with_a_hole_are_dropped(spark, tmp_path):
    doc = {"site": "a", "point": 1, "latitude": 43.0, "longitude": 1.0, "elevation": 250.0,
           "hourly": {"time": ["2026-01-01T00:00", "2026-01-01T01:00", "2026-01-01T02:00"], "temperature_2m": [1.0, None, 3.0], "precipitation": [0.0, 1.0, 2.0]}}
    (tmp_path / "w.json").write_text(json.dumps(doc))
    rows = wx.read_weather(spark, str(tmp_path / "w.json")).orderBy("ts").collect()
    assert [(r.ts.hour, r.temp_c, r.alt) for r in rows] == [(0, 1.0, 250.0), (2, 3.0, 250.0)]


def test_registry_accepts_both_polynomial_forms(spark, tmp_path):
    base = {"nom_groupe": "G1", "priorite": 1, "debit_armement_turbine": 1.0, "debit_max": 9.0, "rendement": [80.0]}
    sites = [
        {"dossier": "a", "centrale": "Alpha", "flex_strategy": "DEFAULT", "facteur_debit": 1.1, "q_non_turbinable_ete": 9, "q_non_turbinable_hiver": 5,
         "periode_ete": [[6, 1], [10, 31]], "groupes": [{**base, "chute_disponible_polynome": [5.0, -0.1]}]},
        {"dossier": "b", "amenagement": "Beta", "groupes": [{**base, "chute_disponible_polynome": [[1.0], [2.0]], "chute_disponible_seuils": [[0, 10], [10, 20]]}, dict(base)]},
    ]
    (tmp_path / "config.json").write_text(json.dumps(sites, indent=1))
    a, b = rg.read_sites(spark, str(tmp_path / "config.json")).orderBy("site").collect()
    assert a.plant == "Alpha" and (a.summer_from, a.summer_to) == (601, 1031)
    assert [s.coeffs for s in a.groups[0].head] == [[5.0, -0.1]]
    assert b.plant == "Beta" and [(s.q_min, s.q_max, s.coeffs) for s in b.groups[0].head] == [(0.0, 10.0, [1.0]), (10.0, 20.0, [2.0])]
    assert b.groups[1].head is None


def test_watersheds_by_folder(spark, tmp_path):
    (tmp_path / "a").mkdir()
    doc = {"bassin_versant": {"altitude_moyenne_m": 800, "surface_km2": 120}, "parametres_calage": {"K_base": 2, "exposition": 1, "kc_unit": 0.9},
           "stations_hydrometriques": [{"code": "A", "role": "amont", "transit_vers_reference_h": {"DJF": 3, "MAM": 5}}, {"code": "R", "role": "reference"}]}
    (tmp_path / "a" / "bv.json").write_text(json.dumps(doc))
    w = rg.read_watersheds(spark, str(tmp_path / "*" / "bv.json"))
    assert rg.basin_parameters(w).first().asDict() == {"site": "a", "alt_basin": 800.0, "surface_km2": 120.0, "k_base": 2.0, "exposition": 1.0, "kc_unit": 0.9}
    assert {(r.station, r.season, r.hours) for r in rg.upstream_transit(w).collect()} == {("A", "winter", 3.0), ("A", "spring", 5.0)}


def test_prepared_overwrite_touches_only_its_sites(spark, series, tmp_path):
    path = str(tmp_path / "prepared")
    st.write_prepared(series([1.0, 2.0]).unionByName(series([5.0], site="b")), path)
    st.write_prepared(series([9.0], site="b"), path)
    assert sorted(r.flow for r in st.read_prepared(spark, path).collect()) == [1.0, 2.0, 9.0]
    assert st.read_prepared(spark, path, ["b"]).count() == 1


@pytest.mark.parametrize("digits", [3])
def test_wide_csv_round_trip(spark, series, tmp_path, digits):
    path = str(tmp_path / "csv")
    st.export_csv(series([1.23456, None]).select("ts", "flow", "site"), path)
    back = st.import_csv(spark, path, "ts TIMESTAMP, flow DOUBLE, site STRING").orderBy("ts").collect()
    assert [r.flow for r in back] == [round(1.23456, digits), None] and back[0].site == "a"
