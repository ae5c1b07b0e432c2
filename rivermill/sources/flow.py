"""Flow series: CSV landing files, observation pages, long-range series."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header of the exchanged flow files.
DATE_HEADER = "Date (TU)"
VALUE_HEADER = "Valeur (en m³/s)"
STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"
OBS_PAGE_SCHEMA = "station STRING, next STRING, data ARRAY<STRUCT<date_obs: STRING, resultat_obs: DOUBLE>>"
SERIES_SCHEMA = "station STRING, series STRUCT<data: ARRAY<STRUCT<t: STRING, v: DOUBLE>>>"
CHUNK_DAYS = 180


def _time(text):
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X"))


def read_flow_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station files as one table (station, ts, flow). An empty value is missing, an absent path is empty.

    The station comes from a `station=<code>` folder, else from the file name (`<code>.csv`, `amont_<code>.csv`).
    """
    try:
        raw = (
            spark.read.schema("at STRING, value DOUBLE")
            .option("sep", ";")
            .option("header", True)
            .option("encoding", "UTF-8")
            .option("recursiveFileLookup", True)
            .csv(path)
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "station STRING, ts TIMESTAMP, flow DOUBLE")
    file = F.col("_metadata.file_path")
    folder = F.regexp_extract(file, r"station=([^/]+)/", 1)
    name = F.regexp_extract(file, r"([^/]+)\.csv[^/]*$", 1)
    station = F.when(folder != "", folder).otherwise(F.regexp_replace(name, "^amont_", ""))
    return raw.select(station.alias("station"), _time(F.col("at")).alias("ts"), F.col("value").alias("flow"))


def write_flow_csv(flow: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per station; UTC stamps with Z, three decimals, empty for missing."""
    out = flow.select(
        "station",
        F.date_format("ts", STAMP).alias(DATE_HEADER),
        F.when(F.col("flow").isNotNull(), F.format_string("%.3f", F.col("flow"))).alias(VALUE_HEADER),
    )
    (
        out.write.mode(mode)
        .partitionBy("station")
        .option("sep", ";")
        .option("header", True)
        .option("emptyValue", "")
        .csv(path)
    )


def read_observation_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of real-time observations (litres/s) as (station, ts, litres); every page is one record."""
    pages = spark.read.schema(OBS_PAGE_SCHEMA).json(path)
    rows = pages.select("station", F.explode("data").alias("o"))
    return rows.select("station", _time(F.col("o.date_obs")).alias("ts"), F.col("o.resultat_obs").alias("litres")).where(
        F.col("ts").isNotNull() & F.col("litres").isNotNull()
    )


def series_points(payloads: DataFrame) -> DataFrame:
    """(station, ts, flow in m3/s) from series documents; a document without points gives no row."""
    rows = payloads.select("station", F.explode("series.data").alias("p"))
    return rows.select("station", _time(F.col("p.t")).alias("ts"), F.round(F.col("p.v") / 1000, 3).alias("flow"))


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return series_points(spark.read.schema(SERIES_SCHEMA).json(path))


def range_chunks(wanted: DataFrame, days: int = CHUNK_DAYS) -> DataFrame:
    """Contiguous, non-overlapping slices of at most `days` days for each (station, start_day, end_day)."""
    starts = F.sequence("start_day", "end_day", F.expr(f"INTERVAL '{days}' DAY"))
    rows = wanted.select("station", "end_day", F.posexplode(starts).alias("chunk", "from_day"))
    return rows.select(
        "station", "chunk", "from_day", F.least(F.date_add("from_day", days - 1), F.col("end_day")).alias("to_day")
    )
