"""Stored tables: prepared series, test predictions, forecasts, documents, model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.operators.forecast import archive_stamp


def write_prepared(df: DataFrame, path: str, key: str = "site") -> None:
    """Replaces the partitions present in `df` only (dynamic overwrite), so a rerun is idempotent."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def read_prepared(spark: SparkSession, path: str, sites: list[str] | None = None) -> DataFrame:
    """Prepared series; a site list prunes folders."""
    df = spark.read.parquet(path)
    return df if sites is None else df.where(F.col("site").isin(*sites))


def export_csv(df: DataFrame, path: str, key: str = "site") -> None:
    """Wide CSV exchange form: ISO stamps with Z, three decimals."""
    columns = [
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c)
        if kind == "timestamp"
        else F.format_string("%.3f", F.col(c)).alias(c)
        if kind == "double"
        else F.col(c)
        for c, kind in df.dtypes
    ]
    cells = df.select([F.when(F.col(c).isNotNull(), x).alias(c) for c, x in zip(df.columns, columns)])
    cells.write.mode("overwrite").partitionBy(key).option("sep", ";").option("header", True).option("emptyValue", "").csv(path)


def import_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Back from the exchange form; `schema` lists the columns in file order, the partition column last."""
    return (
        spark.read.schema(schema)
        .option("sep", ";")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssX")
        .csv(path)
    )


def write_forecast(table: DataFrame, path: str, run_date: str) -> None:
    rows = table.withColumn("run_date", F.lit(run_date))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site", "run_date").parquet(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON record per site, in a folder per site."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site").json(path)


def archive_documents(documents: DataFrame, path: str, now) -> None:
    """Writes the previous documents below site / year / month / day / hour; a retry writes its hour again, sites without one nothing."""
    rows = archive_stamp(documents, now).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("site", "year", "month", "day", "hour").json(path)


def write_test_predictions(rows: DataFrame, path: str) -> None:
    """(site, ts, lead, q_observed and one column per model)."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site").parquet(path)
