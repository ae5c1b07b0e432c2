"""From predictions to the forecast table, documents and archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.functions.columns import paris_time
from rivermill.operators.prepare import tail_rows
from rivermill.operators.splits import from_now
from rivermill.operators.turbine import best_priority, hydraulic_points, turbine_time
from rivermill.session import materialise

OBSERVED_ROWS = 48
MODEL_COLUMNS = ("q_tree", "q_sequence", "q_stacked")


def forecast_table(observed: DataFrame, predicted: DataFrame, transit: DataFrame, factors: DataFrame) -> DataFrame:
    """Last observed rows and predicted rows at the turbine, Paris wall clock, one row per site and time.

    `predicted(site, ts, q_tree, q_sequence, q_stacked)`; `factors(site, flow_factor)`. The travel time
    is that of the season of the last observation, for both parts.
    """
    tail = tail_rows(observed, OBSERVED_ROWS)
    anchor = tail.groupBy("site").agg(F.max("ts").alias("anchor_ts"))

    def at_turbine(df: DataFrame) -> DataFrame:
        joined = df.join(anchor, "site").join(factors, "site", "left").withColumnRenamed("ts", "row_ts")
        moved = turbine_time(joined.withColumnRenamed("anchor_ts", "ts").withColumn("keep_ts", F.col("ts")), transit)
        delay = F.unix_seconds("turbine_ts") - F.unix_seconds("keep_ts")
        at = F.timestamp_seconds(F.unix_seconds("row_ts") + delay)
        return moved.withColumn("ts", paris_time(at)).drop("turbine_ts", "keep_ts", "row_ts")

    past = at_turbine(tail.select("site", "ts", "flow")).select(
        "site",
        "ts",
        *[F.lit(None).cast("double").alias(c) for c in MODEL_COLUMNS],
        F.col("turbine_flow").alias("q_in"),
        F.lit("observed").alias("source"),
    )
    future = at_turbine(predicted.withColumn("flow", F.col("q_stacked"))).select(
        "site", "ts", *MODEL_COLUMNS, F.col("turbine_flow").alias("q_in"), F.lit("prediction").alias("source")
    )
    return past.unionByName(future)


def forecast_points(table: DataFrame, plants: DataFrame, now) -> DataFrame:
    """Rows from `now` on with hydraulics, leads counted from 0."""
    rows = from_now(table, now).withColumnRenamed("q_in", "flow")
    return hydraulic_points(rows, plants)


def forecast_documents(table: DataFrame, plants: DataFrame, now, extra: dict[str, Column] | None = None) -> DataFrame:
    """One nested document per site. A run holds at most 48 + horizon points."""
    points = forecast_points(table, plants, now)
    item = F.struct(
        F.col("lead_hours"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("target_datetime"),
        F.struct(F.round("flow", 3).alias("inflow"), "usable", "reserved").alias("flow"),
        "power",
        "power_max",
        "head",
        "efficiency",
    )
    docs = points.groupBy("site").agg(
        F.array_sort(F.collect_list(item)).alias("points")
    ).join(plants.select("site", best_priority(F.col("groups")).alias("priority")), "site")
    first = F.col("points")[0]
    header = {
        "is_current": F.lit(True),
        "power_now": F.struct(*[first[c].alias(c) for c in ("power", "power_max", "head", "efficiency")]),
        "generated_at": F.lit(now).cast("timestamp"),
        **(extra or {}),
    }
    return docs.select("site", "priority", *[c.alias(n) for n, c in header.items()], "points")


def archive_stamp(documents: DataFrame, now) -> DataFrame:
    """Previous documents with the hour they were issued (one hour before `now`) as folders."""
    issued = F.lit(now).cast("timestamp") - F.make_interval(hours=F.lit(1))
    return documents.withColumns(
        {
            "issued_at": issued,
            "year": F.date_format(issued, "yyyy"),
            "month": F.date_format(issued, "MM"),
            "day": F.date_format(issued, "dd"),
            "hour": F.date_format(issued, "HH"),
        }
    )


def served_models(registry: DataFrame) -> DataFrame:
    """Newest version per site and horizon."""
    picked = registry.groupBy("site", "horizon").agg(F.max_by(F.struct("version", "kge"), "version").alias("v"))
    return picked.select("site", "horizon", "v.version", "v.kge")


def lookup_forecast(forecast: DataFrame, models: DataFrame, site: str) -> DataFrame:
    """Predicted rows of the latest run of one site; an unknown site, model or run is an error for the caller."""
    if models.where(F.col("site") == site).isEmpty():
        raise LookupError(f"no served model for site {site}")
    rows = forecast.where((F.col("site") == site) & (F.col("source") == "prediction"))
    newest = rows.agg(F.max("run_date").alias("run_date"))
    found = materialise(rows.join(newest, "run_date").select("site", "ts", "q_stacked", "q_in"), "lookup")
    if found.isEmpty():
        raise LookupError(f"no forecast stored for site {site}")
    return found


def training_eligibility(spans: DataFrame, models: DataFrame, attempts: DataFrame, now, min_days: float = 365, every_days: int = 7) -> DataFrame:
    """Enough history, and no model yet, no attempt yet, or the last attempt at least a week ago."""
    served = models.select("site", F.lit(True).alias("has_model")).distinct()
    last = attempts.groupBy("site").agg(F.max("attempt_ts").alias("last_attempt"))
    joined = spans.join(served, "site", "left").join(last, "site", "left")
    age_days = F.floor((F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("last_attempt")) / 86400)
    due = F.col("has_model").isNull() | F.col("last_attempt").isNull() | (age_days >= every_days)
    return joined.select("site", "span_days", ((F.col("span_days") >= min_days) & due).alias("eligible"))


def promote(registry: DataFrame, decisions: DataFrame, horizon: int, now, run_id: str) -> DataFrame:
    """New registry rows (version + 1) for candidates that may be served."""
    last = registry.where(F.col("horizon") == horizon).groupBy("site").agg(F.max("version").alias("last"))
    chosen = decisions.where(F.col("decision") != "keep").join(last, "site", "left")
    return chosen.select(
        "site",
        F.lit(horizon).alias("horizon"),
        (F.coalesce("last", F.lit(0)) + 1).alias("version"),
        F.col("kge_candidate").alias("kge"),
        F.lit(now).cast("timestamp").alias("promoted_at"),
        F.lit(run_id).alias("run_id"),
    )
