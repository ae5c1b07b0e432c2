
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis, densify
from rivermill.operators.prepare import hourly_mean
from rivermill.operators.weather import normalise_weather
from rivermill.session import materialise

HOURLY = Axis(("site",), 3600)
DAILY = Axis(("site",), 86_400)
POINTS = Axis(("site", "point"), 3600)
STATIONS_HOURLY = Axis(("station",), 3600)
HOURLY_UPSTREAM = Axis(("site", "station"), 3600)
STATIONS_DAILY = Axis(("site", "station"), 86_400)
H = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular flow readings: a site per event type, three stations and weather points each."""
    part = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("site"),
        F.concat_ws("-", "event_type", part.cast("string")).alias("station"),
        (part + 1).cast("int").alias("point"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("flow"),
        "event_id",
        "props",
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_mean(readings(spark, sf_dir), HOURLY)


def dense_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(hourly(spark, sf_dir), HOURLY)


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year daily readings: the region is the site, its nations are upstream stations."""
    t = lambda n: table(spark, sf_dir, n)
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("site"),
            F.col("n_name").alias("station"),
            F.col("o_orderdate").cast("timestamp").alias("ts"),
            (F.col("o_totalprice") / 1000).alias("flow"),
            (F.col("c_acctbal") / 100).alias("aux"),
        )
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared once as a table, like every series the feature operators read more than once."""
    return materialise(densify(hourly_mean(nation_orders(spark, sf_dir), DAILY), DAILY), "daily")


def daily_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = hourly_mean(nation_orders(spark, sf_dir), STATIONS_DAILY)
    return materialise(densify(means, STATIONS_DAILY).withColumnRenamed("flow", "upstream"), "upstream")


def transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream to reference travel time per season, in steps; the last station of a region has none."""
    hours = F.create_map(
        F.lit("winter"), F.lit(3.0), F.lit("spring"), F.lit(9.0),
        F.lit("summer"), F.lit(12.0) + F.col("n_nationkey") % 5,
    )
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("n_nationkey") < 20)
        .select(
            F.col("r_name").alias("site"),
            F.col("n_name").alias("station"),
            F.explode(hours).alias("season", "hours"),
        )
    )


def point_place() -> dict[str, Column]:
    p = F.col("point")
    return {
        "lat": F.lit(43.0) + p * p * 0.2,
        "lon": F.lit(0.5) + p * 0.4,
        "alt": F.lit(200.0) + p * 300.0,
    }


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather in degrees Celsius and mm per point."""
    mean = F.avg("flow")
    return (
        readings(spark, sf_dir)
        .groupBy("site", "point", F.date_trunc("hour", "ts").alias("ts"))
        .agg(
            (mean / 7 - 4).alias("temp_c"),
            F.when(mean > 45, (mean - 45) / 10).otherwise(0.0).alias("precip_mm"),
        )
        .withColumns(point_place())
    )


def dense_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(densify(normalise_weather(weather_raw(spark, sf_dir), POINTS), POINTS), "weather")


def hourly_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations of an event site, in the role of its upstream stations."""
    means = hourly_mean(readings(spark, sf_dir), HOURLY_UPSTREAM)
    return materialise(densify(means, HOURLY_UPSTREAM).withColumnRenamed("flow", "upstream"), "hourly-upstream")


def hourly_transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Travel time of those stations in winter and spring; other seasons have none."""
    hours = F.create_map(F.lit("winter"), F.col("point") * 3.0 + 6, F.lit("spring"), F.col("point") * 1.0)
    members = readings(spark, sf_dir).select("site", "station", "point").distinct()
    return members.select("site", "station", F.explode(hours).alias("season", "hours"))


def basins(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("site")
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_type").alias("site"))
        .distinct()
        .select(
            "site",
            (F.lit(700.0) + n * 120.0).alias("alt_basin"),
            (F.lit(100.0) + n * 10.0).alias("surface_km2"),
            (F.lit(2.0) + n * 0.1).alias("k_base"),
            F.lit(1.0).alias("exposition"),
            F.lit(0.9).alias("kc_unit"),
            F.lit(43.0).alias("out_lat"),
            F.lit(1.0).alias("out_lon"),
        )
    )


def _plant_columns() -> dict[str, Column]:
    """Plant record with nested turbine groups, made of a row of `part`."""
    k, size, price = F.col("p_partkey"), F.col("p_size").cast("double"), F.col("p_retailprice")

    def group(i: int) -> Column:
        return F.struct(
            F.when((k + i) % 17 != 0, F.concat(F.lit("G"), F.lit(i).cast("string"))).alias("name"),
            ((k * 7 + i * 3) % 5).cast("int").alias("priority"),
            F.when((k + i) % 19 != 0, size / (i + 2)).alias("arm_flow"),
            (size / i + 1).alias("max_flow"),
            F.array(F.lit(60.0) + i, F.lit(0.5), F.lit(-0.01)).alias("efficiency"),
            F.when(
                (k + i) % 23 != 0,
                F.array(
                    F.struct(
                        F.lit(0.0).alias("q_min"),
                        F.lit(20.0).alias("q_max"),
                        F.array(price / 100, F.lit(-0.05)).alias("coeffs"),
                    ),
                    F.struct(
                        F.lit(20.0).alias("q_min"),
                        F.lit(40.0).alias("q_max"),
                        F.array(price / 120, F.lit(-0.02)).alias("coeffs"),
                    ),
                ),
            ).alias("head"),
        )

    seasonal = k % 3 == 0
    stations = F.array_distinct(
        F.array(*[F.concat(F.lit("ST"), ((k * m) % 50).cast("string")) for m in (3, 7, 3)])
    )
    return {
        "site": F.concat(F.lit("P"), k.cast("string")),
        "site_order": k,
        "plant": F.concat_ws(" ", F.initcap(F.split("p_name", " ")[0]), k.cast("string")),
        "strategy": F.when(F.col("p_size") % 5 == 0, "MANUAL").otherwise("DEFAULT"),
        "flow_factor": F.when(k % 11 != 0, F.lit(1.0) + size / 100),
        "ref_station": F.when(k % 13 != 0, F.concat(F.lit("ST"), (k % 50).cast("string"))),
        "upstream_stations": F.when(k % 7 != 0, stations),
        "reserve_flow": F.when(~seasonal, size / 20),
        "reserve_summer": F.when(seasonal, size / 10),
        "reserve_winter": F.when(seasonal, size / 25),
        "summer_from": F.when(seasonal, F.lit(601)),
        "summer_to": F.when(seasonal, F.lit(1031)),
        "groups": F.slice(F.array(group(1), group(2), group(3)), 1, (k % 4).cast("int")),
    }


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant records with nested turbine groups, one per part."""
    return table(spark, sf_dir, "part").select(*[c.alias(n) for n, c in _plant_columns().items()])


def inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant inflow points from order lines."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("site"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("flow"),
        "l_orderkey",
        "l_linenumber",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two naive forecasts per lead 1..H against the observed flow, long form, written out once."""
    from rivermill.operators.evaluate import naive_forecasts

    return materialise(naive_forecasts(dense_hourly(spark, sf_dir), HOURLY, H), "scored")


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant record of each event site, picked from the registry by a key made of the site name.

    The parts picked are made into records after the join; a merge join, as a small file may hold many parts.
    """
    key = basins(spark, sf_dir).select("site", (F.length("site") * 3).cast("long").alias("_key"))
    picked = key.join(table(spark, sf_dir, "part").hint("merge"), F.col("_key") == F.col("p_partkey"))
    return picked.select("site", *[c.alias(n) for n, c in _plant_columns().items() if n not in ("site", "site_order")])


def plant_transit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from the gauging station to the turbine."""
    return basins(spark, sf_dir).select("site", F.lit("winter").alias("season"), (F.length("site") / 2).alias("hours"))


def stored_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next H hours per site from its last observation: flat, day mean, and their middle."""
    from rivermill.operators.prepare import last_observed, tail_rows

    dense = dense_hourly(spark, sf_dir)
    last = last_observed(dense)
    mean = tail_rows(dense, 24).groupBy("site").agg(F.avg("flow").alias("q_sequence"))
    lead = F.explode(F.sequence(F.lit(1), F.lit(H)))
    rows = last.join(mean, "site").withColumn("lead", lead)
    return rows.select(
        "site",
        (F.col("last_ts") + F.make_interval(hours=F.col("lead"))).alias("ts"),
        F.col("last_flow").alias("q_tree"),
        "q_sequence",
        ((F.col("last_flow") + F.col("q_sequence")) / 2).alias("q_stacked"),
    )
