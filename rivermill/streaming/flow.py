"""Live flow as Structured Streaming: closed hours, duplicates, upserts, silence, sliding percentiles."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.operators.flow import flow_lags
from rivermill.operators.prepare import last_days, replace_on_key
from rivermill.session import fresh_path, materialise


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream over what has landed so far into files, and reads them back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, handler, checkpoint: str) -> None:
    """Hands every micro-batch to `handler(batch, batch_id)`, which must be safe to repeat."""
    query = (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def closed_hour_means(stream: DataFrame, delay: str, key: str = "station") -> DataFrame:
    """Hourly mean per station, emitted once when the watermark passes the hour: the open hour never shows."""
    hour = F.window("ts", "1 hour")
    means = stream.withWatermark("ts", delay).groupBy(key, hour).agg(F.avg("flow").alias("flow"))
    return means.select(key, F.col("window.start").alias("ts"), "flow")


def without_repeats(stream: DataFrame, delay: str = "1 hour", key: str = "station") -> DataFrame:
    """The same (station, ts) delivered by overlapping polls counts once."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key, "ts"])


def silences(stream: DataFrame, limit: str, delay: str, key: str = "station") -> DataFrame:
    """A row for each time a station stays silent longer than `limit`: its activity session has closed."""
    session = F.session_window("ts", limit)
    closed = stream.withWatermark("ts", delay).groupBy(key, session).agg(F.max("ts").alias("last_ts"))
    return closed.select(key, "last_ts", F.col("session_window.end").alias("stale_at"))


def slow_windows(stream: DataFrame, threshold: float, width: str = "5 minutes", slide: str = "1 minute", delay: str = "1 minute") -> DataFrame:
    """Sliding 95th percentile above a threshold."""
    p95 = F.percentile_approx("value", 0.95).alias("p95")
    windows = stream.withWatermark("ts", delay).groupBy(F.window("ts", width, slide)).agg(p95, F.count(F.lit(1)).alias("n"))
    return windows.where(F.col("p95") > threshold).select(F.col("window.start").alias("from_ts"), "p95", "n")


def upsert_store(spark: SparkSession, store: str, batch: DataFrame, keys: list[str], part: str = "day") -> None:
    """Replaces the rows of `batch` in a table partitioned by `part`; only the partitions it touches are
    read and rewritten, through a staged copy, so a repeated batch changes nothing."""
    new = materialise(batch, "batch")
    try:
        existing = spark.read.parquet(store)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # the first batch finds no table
            raise
        merged = new
    else:
        touched = existing.join(new.select(part).distinct(), part, "left_semi")
        merged = replace_on_key(touched, new, keys)
    staged = materialise(merged, "merged")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(store)


def upsert_handler(store: str, keys: list[str], part: str = "day"):
    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_store(batch.sparkSession, store, batch, keys, part)

    return handle


def features_now(history: DataFrame, horizon: int, spd: int = 24, lookback_days: int = 90) -> DataFrame:
    """The flow lags at the last row of each site, from the last days of the store; no unbounded state."""
    step = 86_400 // spd
    recent = last_days(history.where(F.col("flow").isNotNull()), lookback_days)
    newest = recent.groupBy("site").agg(F.max("ts").alias("now_ts"))
    age = (F.unix_seconds("now_ts") - F.unix_seconds("ts")) / step
    lags = [F.max(F.when(age == n, F.col("flow"))).alias(f"lag_{n}") for n in flow_lags(horizon, spd)]
    return recent.join(newest, "site").groupBy("site", "now_ts").agg(*lags)


def features_handler(store: str, out: str, keys: list[str], horizon: int):
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        upsert_store(spark, store, batch, keys)
        features_now(spark.read.parquet(store), horizon).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return handle


def new_run(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output path, checkpoint path) of one run."""
    base = fresh_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"
