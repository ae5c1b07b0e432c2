"""Streams over the driver's events (as landed files)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermill.plans import tables as t
from rivermill.plans.oracle import rounded as rr
from rivermill.plans.oracle import with_ctes as q
from rivermill.plans.shape import rounded
from rivermill.session import fresh_path
from rivermill.streaming import flow as sf


def _stream(s, d):
    """The events table as a file stream of readings; its timestamps carry no zone and mean UTC."""
    schema = t.table(s, d, "events").schema
    raw = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return raw.select(
        F.col("event_type").alias("site"), F.concat_ws("-", "event_type", (F.col("user_id") % 3).cast("string")).alias("station"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("flow"), "value", "event_id")


def i01(s, d):
    out, chk = sf.new_run(s, "hours")
    return rounded(sf.run_available(sf.closed_hour_means(_stream(s, d), "0 seconds"), out, chk))


def i02(s, d):
    twice = _stream(s, d).select("station", "ts", "flow").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    out, chk = sf.new_run(s, "repeats")
    return sf.run_available(sf.without_repeats(twice), out, chk)


def _landed_hours(s, d):
    """Hourly rows landed in three overlapping files."""
    days = F.dayofmonth("ts")
    batch = F.explode(F.filter(F.array(F.when(days <= 12, 1), F.when((days > 8) & (days <= 22), 2), F.when(days > 18, 3)), lambda b: b.isNotNull()))
    path = fresh_path(s, "landed")
    rows = t.hourly(s, d).withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("batch", batch)
    rows.repartition("batch").write.partitionBy("batch").parquet(path)
    schema = rows.drop("batch").schema
    return s.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(path)


def i03(s, d):
    store, chk = sf.new_run(s, "upsert")
    sf.run_batches(_landed_hours(s, d), sf.upsert_handler(store, ["site", "ts"]), chk)
    return rounded(s.read.parquet(store).select("site", "ts", "flow"))


def i04(s, d):
    out, chk = sf.new_run(s, "silence")
    return sf.run_available(sf.silences(_stream(s, d), "3 hours", "0 seconds"), out, chk)


def i05(s, d):
    out, chk = sf.new_run(s, "p95")
    return rounded(sf.run_available(sf.slow_windows(_stream(s, d), 100.0), out, chk))


def i06(s, d):
    store, chk = sf.new_run(s, "features")
    out = fresh_path(s, "features-now")
    sf.run_batches(_landed_hours(s, d), sf.features_handler(store, out, ["site", "ts"], t.H), chk)
    runs = s.read.parquet(out)
    last = runs.agg(F.max("batch").alias("batch"))
    return rounded(runs.join(last, "batch").drop("batch"))


QUERIES = {
    "i01_stream_hourly_mean": i01, "i02_stream_dedup": i02, "i03_stream_upsert": i03, "i04_stream_freshness": i04,
    "i05_sliding_p95": i05, "i06_stream_forecast_features": i06,
}

ORACLE = {
    "i01_stream_hourly_mean": q(
        f"""SELECT station, date_trunc('hour', ts) AS ts, {rr(flow='avg(flow)')} FROM readings
            WHERE date_trunc('hour', ts) < (SELECT date_trunc('hour', max(ts)) FROM readings) GROUP BY station, date_trunc('hour', ts)""", "readings"),
    "i02_stream_dedup": q("SELECT DISTINCT station, ts, flow FROM readings", "readings"),
    "i03_stream_upsert": q(f"SELECT site, ts, {rr(flow='flow')} FROM hourly", "hourly"),
    "i04_stream_freshness": q(
        """SELECT station, ts AS last_ts, ts + INTERVAL 3 HOUR AS stale_at FROM (SELECT *, lead(ts) OVER (PARTITION BY station ORDER BY ts) AS next_ts FROM readings)
           WHERE (next_ts IS NULL OR next_ts > ts + INTERVAL 3 HOUR) AND ts + INTERVAL 3 HOUR <= (SELECT max(ts) FROM readings)""", "readings"),
    "i05_sliding_p95": q(
        f"""SELECT from_ts, {rr(p95='quantile_disc(flow, 0.95)')}, count(*) AS n FROM (
              SELECT flow, unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS from_ts FROM readings)
            WHERE from_ts + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM readings)
            GROUP BY from_ts HAVING quantile_disc(flow, 0.95) > 100""", "readings"),
    "i06_stream_forecast_features": q(
        f"""SELECT n.site, now_ts, {rr(**{f'lag_{k}': f"max(flow) FILTER (WHERE ts = now_ts - INTERVAL {k} HOUR)" for k in (8, 12, 16, 24, 32, 168, 336)})}
            FROM hourly h JOIN (SELECT site, max(ts) AS now_ts FROM hourly GROUP BY site) n ON n.site = h.site GROUP BY 1, 2""", "hourly"),
}
