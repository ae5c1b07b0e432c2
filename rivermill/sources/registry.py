"""Site registry, watershed and station documents: nested JSON with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field names of the incoming documents.
WATERSHED_SCHEMA = """
  bassin_versant STRUCT<altitude_moyenne_m: DOUBLE, surface_km2: DOUBLE>,
  parametres_calage STRUCT<K_base: DOUBLE, exposition: DOUBLE, kc_unit: DOUBLE>,
  stations_hydrometriques ARRAY<STRUCT<code: STRING, role: STRING, transit_vers_reference_h: MAP<STRING, DOUBLE>>>,
  stations_meteo_nwp ARRAY<STRUCT<id: INT, lat: DOUBLE, lon: DOUBLE>>,
  exutoire STRUCT<lat: DOUBLE, lon: DOUBLE>,
  transit_vers_centrale_h MAP<STRING, DOUBLE>
"""
SITE_SCHEMA = """
  dossier STRING, centrale STRING, amenagement STRING, type STRING, flex_strategy STRING, facteur_debit DOUBLE,
  station_vigicrue_reference STRING, stations_vigicrue_amont ARRAY<STRING>,
  debit_non_turbinable DOUBLE, q_non_turbinable_ete DOUBLE, q_non_turbinable_hiver DOUBLE, periode_ete ARRAY<ARRAY<INT>>,
  groupes ARRAY<STRUCT<nom_groupe: STRING, priorite: INT, debit_armement_turbine: DOUBLE, debit_max: DOUBLE,
                       rendement: ARRAY<DOUBLE>, chute_disponible_polynome: STRING, chute_disponible_seuils: ARRAY<ARRAY<DOUBLE>>>>
"""
STATION_SCHEMA = """
  data ARRAY<STRUCT<code_station: STRING, latitude_station: DOUBLE, longitude_station: DOUBLE, altitude_ref_alti_station: DOUBLE>>
"""
EVERYWHERE = 1e9


def _segments(text: Column, limits: Column) -> Column:
    """One polynomial, or one per flow range, as a list of segments."""
    nested = F.from_json(text, "ARRAY<ARRAY<DOUBLE>>")
    single = F.from_json(text, "ARRAY<DOUBLE>")
    is_nested = F.regexp_replace(text, r"\s", "").startswith("[[")
    ranges = F.transform(
        nested,
        lambda c, i: F.struct(
            F.get(F.get(limits, i), F.lit(0)).alias("q_min"), F.get(F.get(limits, i), F.lit(1)).alias("q_max"), c.alias("coeffs")
        ),
    )
    whole = F.array(
        F.struct(F.lit(-EVERYWHERE).alias("q_min"), F.lit(EVERYWHERE).alias("q_max"), single.alias("coeffs"))
    )
    return F.when(text.isNotNull(), F.when(is_nested, ranges).otherwise(whole))


def normalise_sites(raw: DataFrame) -> DataFrame:
    """Registry records under the engine's column names."""

    def group(g: Column) -> Column:
        return F.struct(
            g["nom_groupe"].alias("name"),
            g["priorite"].alias("priority"),
            g["debit_armement_turbine"].alias("arm_flow"),
            g["debit_max"].alias("max_flow"),
            g["rendement"].alias("efficiency"),
            _segments(g["chute_disponible_polynome"], g["chute_disponible_seuils"]).alias("head"),
        )

    def day(i: int) -> Column:
        part = F.get("periode_ete", F.lit(i))
        return F.get(part, F.lit(0)) * 100 + F.get(part, F.lit(1))

    return raw.select(
        F.col("dossier").alias("site"),
        F.coalesce("centrale", "amenagement").alias("plant"),
        F.col("flex_strategy").alias("strategy"),
        F.col("facteur_debit").alias("flow_factor"),
        F.col("station_vigicrue_reference").alias("ref_station"),
        F.col("stations_vigicrue_amont").alias("upstream_stations"),
        F.col("debit_non_turbinable").alias("reserve_flow"),
        F.col("q_non_turbinable_ete").alias("reserve_summer"),
        F.col("q_non_turbinable_hiver").alias("reserve_winter"),
        day(0).alias("summer_from"),
        day(1).alias("summer_to"),
        F.transform("groupes", group).alias("groups"),
    )


def read_sites(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Registry file: one JSON list per file, or one record per line."""
    return normalise_sites(spark.read.schema(SITE_SCHEMA).option("multiLine", multi_line).json(path))


def read_watersheds(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Watershed files `<site>/bv.json`; the folder names the site. Records may carry it themselves instead."""
    schema = WATERSHED_SCHEMA + ", dossier STRING"
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    rows = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return rows.select(F.coalesce("dossier", folder).alias("site"), *[c for c in rows.columns if c != "dossier"])


def basin_parameters(watersheds: DataFrame) -> DataFrame:
    return watersheds.select(
        "site",
        F.col("bassin_versant.altitude_moyenne_m").alias("alt_basin"),
        F.col("bassin_versant.surface_km2").alias("surface_km2"),
        F.col("parametres_calage.K_base").alias("k_base"),
        F.col("parametres_calage.exposition").alias("exposition"),
        F.col("parametres_calage.kc_unit").alias("kc_unit"),
    )


def upstream_transit(watersheds: DataFrame) -> DataFrame:
    """(site, station, season, hours) of the upstream stations."""
    from rivermill.operators.upstream import transit_table

    stations = watersheds.select("site", F.explode("stations_hydrometriques").alias("st")).where(
        F.col("st.role") == "amont"
    )
    return transit_table(stations.select("site", F.col("st.code").alias("station"), F.col("st.transit_vers_reference_h").alias("transit")))


def discover_sites(registry: DataFrame, watersheds: DataFrame) -> DataFrame:
    """Registered sites that have a watershed document."""
    return registry.join(watersheds.select("site").distinct(), "site", "left_semi")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(STATION_SCHEMA).json(path).select(F.explode("data").alias("s"))
    return rows.select(
        F.col("s.code_station").alias("station"),
        F.col("s.latitude_station").alias("lat"),
        F.col("s.longitude_station").alias("lon"),
        F.col("s.altitude_ref_alti_station").alias("alt"),
    )


def station_places(stations: DataFrame, wanted: DataFrame) -> DataFrame:
    """Place of each wanted code; codes without an entry are absent."""
    return wanted.select("station").distinct().join(stations.dropDuplicates(["station"]), "station")
