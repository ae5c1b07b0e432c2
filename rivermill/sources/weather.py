"""Landed weather payloads: parallel arrays per point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WEATHER_SCHEMA = """
  site STRING, point INT, latitude DOUBLE, longitude DOUBLE, elevation DOUBLE,
  hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, precipitation: ARRAY<DOUBLE>>
"""
# Fixed value: the archive of the weather model has no earlier rows.
ARCHIVE_START = "2022-11-15"


def weather_rows(payloads: DataFrame) -> DataFrame:
    """One row per point and hour; an hour with any missing value is dropped before any merge."""
    zipped = F.arrays_zip(
        F.col("hourly.time").alias("time"),
        F.col("hourly.temperature_2m").alias("temperature_2m"),
        F.col("hourly.precipitation").alias("precipitation"),
    )
    rows = payloads.select("site", "point", "latitude", "longitude", "elevation", F.explode(zipped).alias("h"))
    return rows.select(
        "site",
        "point",
        F.to_timestamp(F.col("h.time"), "yyyy-MM-dd'T'HH:mm").alias("ts"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.coalesce("elevation", F.lit(0.0)).alias("alt"),
        F.col("h.temperature_2m").alias("temp_c"),
        F.col("h.precipitation").alias("precip_mm"),
    ).na.drop("any", subset=["ts", "temp_c", "precip_mm"])


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return weather_rows(spark.read.schema(WEATHER_SCHEMA).json(path))
