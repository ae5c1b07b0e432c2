"""From readings to an aligned, gap-free table: hourly means, look-ups, alignment, upserts, filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis


def bucket_start(axis: Axis) -> Column:
    return F.timestamp_seconds(axis.position() * axis.step)


def hourly_mean(df: DataFrame, axis: Axis, value: str = "flow") -> DataFrame:
    """Mean per key and step; partial sums are combined before the shuffle."""
    return df.groupBy(*axis.keys, bucket_start(axis).alias(axis.ts)).agg(F.avg(value).alias(value))


def last_stored(flow: DataFrame, key: str = "station") -> DataFrame:
    return flow.groupBy(key).agg(F.max("ts").alias("last_ts"))


def closed_hours(obs: DataFrame, stored: DataFrame, key: str = "station") -> DataFrame:
    """Hourly means in m3/s from litres/s, newer than what is stored, without the still open hour."""
    hour = F.date_trunc("hour", "ts")
    newest = obs.groupBy(key).agg(F.date_trunc("hour", F.max("ts")).alias("open_hour"))
    means = obs.groupBy(key, hour.alias("ts")).agg((F.avg("litres") / 1000).alias("flow"))
    return (
        means.join(newest, key)
        .join(last_stored(stored, key), key, "left")
        .where(F.col("ts") < F.col("open_hour"))
        .where(F.col("last_ts").isNull() | (F.col("ts") > F.col("last_ts")))
        .select(key, "ts", "flow")
    )


def newer_points(points: DataFrame, stored: DataFrame, key: str = "station") -> DataFrame:
    """Points after the newest stored timestamp of their station."""
    return (
        points.join(last_stored(stored, key), key, "left")
        .where(F.col("last_ts").isNull() | (F.col("ts") > F.col("last_ts")))
        .drop("last_ts")
    )


def append_points(points: DataFrame, stored: DataFrame, key: str = "station") -> DataFrame:
    return stored.unionByName(newer_points(points, stored, key).select(*stored.columns))


def latest_source(obs: DataFrame, primary: str) -> DataFrame:
    """Newest timestamp per station and source; another source wins only when strictly fresher."""
    best = obs.groupBy("station", "source").agg(F.max("ts").alias("ts"))
    rank = F.struct(F.col("ts"), (F.col("source") == primary).cast("int"))
    return best.groupBy("station").agg(
        F.max("ts").alias("latest_ts"), F.max_by("source", rank).alias("source")
    )


def time_range(df: DataFrame, start, end, ts: str = "ts") -> DataFrame:
    """Both ends included."""
    return df.where(F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def from_first_flow(weather: DataFrame, flow: DataFrame, start) -> DataFrame:
    """Rows at or after the later of `start` and the first known flow of the site."""
    first = (
        flow.where(F.col("flow").isNotNull())
        .groupBy("site")
        .agg(F.greatest(F.min("ts"), F.lit(start).cast("timestamp")).alias("start_ts"))
    )
    return weather.join(first, "site").where(F.col("ts") >= F.col("start_ts")).drop("start_ts")


def update_range(sites: DataFrame, stored: DataFrame, floor, now) -> DataFrame:
    """What to fetch next per site: from the hour after the last stored row, or the history floor, up to
    the end of the day before `now`."""
    end = F.date_trunc("day", F.lit(now).cast("timestamp")) - F.make_interval(hours=F.lit(1))
    after = F.col("last_ts") + F.make_interval(hours=F.lit(1))
    start = F.greatest(F.coalesce(after, F.lit(floor).cast("timestamp")), F.lit(floor).cast("timestamp"))
    wanted = sites.select("site").join(last_stored(stored, "site"), "site", "left")
    return wanted.select("site", start.alias("start_ts"), end.alias("end_ts")).where(F.col("start_ts") <= F.col("end_ts"))


def live_window(df: DataFrame, now, horizon: int, lookback_days: int = 90) -> DataFrame:
    at = F.lit(now).cast("timestamp")
    return df.where(
        F.col("ts").between(at - F.make_interval(days=F.lit(lookback_days)), at + F.make_interval(hours=F.lit(horizon)))
    )


def last_days(df: DataFrame, days: int, key: str = "site") -> DataFrame:
    """Rows within `days` of the last row of their key."""
    newest = df.groupBy(key).agg(F.max("ts").alias("_newest"))
    return (
        df.join(newest, key)
        .where(F.col("ts") >= F.col("_newest") - F.make_interval(days=F.lit(days)))
        .drop("_newest")
    )


def default_strategy(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("strategy") == "DEFAULT")


def align_sources(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join on the keys; a value column offered twice is an error."""
    seen: set[str] = set()
    for df in sources:
        extra = set(df.columns) - set(keys)
        if extra & seen:
            raise ValueError(f"columns offered by two sources: {sorted(extra & seen)}")
        seen |= extra
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), sources)


def upstream_stations(registry: DataFrame) -> DataFrame:
    """Site to upstream station, repeats removed, order kept, with the column label of each."""
    listed = registry.withColumn("codes", F.array_distinct("upstream_stations"))
    return listed.select("site", F.size("codes").alias("_n"), F.posexplode("codes").alias("position", "station")).select(
        "site",
        "position",
        "station",
        F.when(F.col("_n") == 1, "upstream").otherwise(F.concat(F.lit("upstream_"), "station")).alias("label"),
    )


def upstream_flow(registry: DataFrame, flow: DataFrame) -> DataFrame:
    return upstream_stations(registry).join(flow, "station")


def reference_flow(registry: DataFrame, flow: DataFrame) -> DataFrame:
    return registry.select("site", F.col("ref_station").alias("station")).join(flow, "station")


def distinct_stations(registry: DataFrame) -> DataFrame:
    """Reference first, then upstream stations not yet named."""
    ref = F.when(F.col("ref_station").isNotNull(), F.array("ref_station")).otherwise(F.array().cast("array<string>"))
    codes = F.array_distinct(F.concat(ref, F.coalesce("upstream_stations", F.array().cast("array<string>"))))
    return registry.select("site", F.posexplode(codes).alias("position", "station"))


def station_owner(uses: DataFrame, existing: DataFrame) -> DataFrame:
    """Who holds the series of a station: the site already storing it, else the first site to name it.

    `uses(site, site_order, station)`, `existing(station, owner)`; status is new / existing / linked.
    """
    first = uses.groupBy("station").agg(F.min_by("site", "site_order").alias("first_site"))
    return (
        uses.join(first, "station")
        .join(existing, "station", "left")
        .select(
            "site",
            "station",
            F.coalesce("owner", "first_site").alias("owner"),
            F.when(F.coalesce("owner", "first_site") != F.col("site"), "linked")
            .when(F.col("owner").isNotNull(), "existing")
            .otherwise("new")
            .alias("status"),
        )
    )


def replace_on_key(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows win, other history stays, columns may be added."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def union_prefer_last(first: DataFrame, last: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Union of two sources; on equal keys `last` wins, but a row with any missing value never does.

    One aggregation with map-side combine instead of a window over every key.
    """

    def ranked(df: DataFrame, rank: int) -> DataFrame:
        return df.select(*keys, *values).na.drop("any", subset=values).withColumn("_rank", F.lit(rank))

    both = ranked(first, 0).unionByName(ranked(last, 1))
    return (
        both.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "_rank").alias("_v"))
        .select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])
    )


def missing_weather(sites: DataFrame, weather: DataFrame, now, before_h: int = 1, after_h: int = 8) -> DataFrame:
    """Sites that have weather points but no weather row around `now`."""
    at = F.lit(now).cast("timestamp")
    near = weather.where(
        F.col("ts").between(at - F.make_interval(hours=F.lit(before_h)), at + F.make_interval(hours=F.lit(after_h)))
    )
    return sites.where(F.col("n_points") > 0).join(near.select("site").distinct(), "site", "left_anti")


def tail_rows(df: DataFrame, n: int, value: str = "flow", key: str = "site", until=None) -> DataFrame:
    """Last `n` rows with a value per key; the limit is applied before the shuffle as well."""
    known = df.where(F.col(value).isNotNull())
    if until is not None:
        known = known.where(F.col("ts") <= F.lit(until).cast("timestamp"))
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("ts")))
    return known.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def last_observed(df: DataFrame, value: str = "flow", key: str = "site") -> DataFrame:
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(key).agg(F.max_by(value, "ts").alias("last_flow"), F.max("ts").alias("last_ts"))


def first_valid(df: DataFrame, value: str, keys: list[str], strict: bool = False) -> DataFrame:
    """First present value per key; keys without any are NULL, or an error when `strict`."""
    found = df.groupBy(*keys).agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col("ts"))).alias(value))
    if not strict:
        return found
    message = F.concat(F.lit(f"{value} has no value for "), F.concat_ws("/", *keys))
    return found.withColumn(
        value, F.when(F.col(value).isNull(), F.raise_error(message).cast("double")).otherwise(F.col(value))
    )


def history_span(df: DataFrame, key: str = "site") -> DataFrame:
    seconds = F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))
    return df.groupBy(key).agg((seconds / 86400).alias("span_days"))
