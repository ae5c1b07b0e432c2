"""Upstream flow carried to the reference station by its seasonal travel time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.functions.columns import EPS, season, season_of_code


def transit_table(watersheds: DataFrame) -> DataFrame:
    """`transit` maps of season code to hours, per site and station, as one row per season name."""
    rows = watersheds.select("site", "station", F.explode("transit").alias("code", "hours"))
    return rows.select("site", "station", season_of_code(F.col("code")).alias("season"), "hours")


def transit_hours(df: DataFrame, transit: DataFrame, default: float) -> DataFrame:
    """Adds `hours` for the season of each row; a missing season or station gets `default`."""
    keys = [k for k in ("site", "station", "season") if k in transit.columns]
    return (
        df.withColumn("season", season(F.col("ts")))
        .join(transit, keys, "left")
        .withColumn("hours", F.coalesce("hours", F.lit(float(default))))
    )


def seasonal_shift(up: DataFrame, transit: DataFrame, axis: Axis, horizon: int, value: str = "upstream") -> DataFrame:
    """`value` as it was max(horizon, travel time) steps earlier; the season is that of the receiving row."""
    keys = list(axis.keys)
    receive = transit_hours(up.select(*keys, axis.ts), transit, horizon).select(
        *keys,
        axis.ts,
        F.greatest(F.lit(horizon), F.col("hours").cast("long")).alias("shift_steps"),
    )
    source = up.select(*keys, F.col(axis.ts).alias("_src"), value)
    moved = receive.withColumn(
        "_src", F.timestamp_seconds(F.unix_seconds(F.col(axis.ts)) - F.col("shift_steps") * axis.step)
    )
    return moved.join(source, [*keys, "_src"], "left").drop("_src")


def upstream_features(
    up: DataFrame, transit: DataFrame, flow_lag: DataFrame, axis: Axis, horizon: int, value: str = "upstream"
) -> DataFrame:
    """Shifted upstream flow with extra lags, gradients and the ratio to the lagged reference flow.

    `flow_lag(site, ts, flow_lag)` is the reference flow `horizon` steps earlier.
    """
    spd = axis.steps_per_day
    hours = 24 // spd
    extra = [int(1.5 * horizon), 2 * horizon, 3 * horizon]
    back6, back24 = max(1, 6 // hours), max(1, 24 // hours)
    shifted = seasonal_shift(up, transit, axis, horizon, value)
    w = axis.window()
    q = F.col(value)
    wide = axis.split(shifted, back=max(*extra, back24)).withColumns(
        {
            f"{value}_lag_{horizon}": q,
            **{f"{value}_lag_{horizon + n}": F.lag(q, n).over(w) for n in extra},
            f"{value}_gradient_6h": q - F.lag(q, back6).over(w),
            f"{value}_gradient_24h": q - F.lag(q, back24).over(w),
        }
    )
    return (
        axis.core(wide)
        .join(flow_lag, ["site", axis.ts], "left")
        .withColumn(f"{value}_ratio", q / (F.col("flow_lag") + EPS))
        .drop("flow_lag")
    )
