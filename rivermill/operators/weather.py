"""Weather to runoff: rain / snow split, melt, evapotranspiration, net inflow and its memory, per weather point."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis, block_prefix, diff, rolling, running_totals
from rivermill.functions.columns import (
    EPS,
    KELVIN,
    basin_temperature,
    bound,
    distance_windows,
    et0,
    floor_zero,
    haversine_km,
)
from rivermill.functions.ewm import ewm_means

# Thresholds of the runoff model.
INTERCEPTION = 0.9
EFFECTIVE_RAIN_MM = 1.0
STOCK_DECAY = 0.998
RAIN_ON_SNOW_DIVISOR = 80
NET_INFLOW_MIN = 0.1
FLOW_SPEED_KMH = 3
HIGH_BASIN_M = 1300
FROST_LIMIT = 0.2
OFFSET = 0.1
WINDOW_HOURS = (1, 3, 6, 12, 24, 36, 48, 72, 168)


def normalise_weather(raw: DataFrame, axis: Axis) -> DataFrame:
    """Degrees to Kelvin, hourly rain to a running sum per point (missing rain counts as 0)."""
    summed = running_totals(raw, axis, {"precip_cum_mm": F.coalesce("precip_mm", F.lit(0.0))})
    return summed.withColumn("temp_k", F.col("temp_c") + KELVIN).drop("temp_c", "precip_mm")


def reference_temperature(weather: DataFrame, keys: list[str]) -> DataFrame:
    """Mean temperature of the latest year present, per point."""
    yearly = weather.groupBy(*keys, F.year("ts").alias("_y")).agg(F.avg("temp_k").alias("_t"))
    return yearly.groupBy(*keys).agg(F.max_by("_t", "_y").alias("mean_temp_k"))


def melt_potential(temp: Column, ground_rain: Column, day: Column, k_base: Column, exposition: Column) -> Column:
    factor = (k_base + F.cos(F.lit(2 * math.pi) * (day - 172) / 365)) * exposition
    return floor_zero(factor / 24 * temp) + floor_zero(ground_rain * temp) / RAIN_ON_SNOW_DIVISOR


def snow_scan(df: DataFrame, axis: Axis) -> DataFrame:
    """Snow stock and melt from `snow` and `melt_potential` on rows split by `axis`.

    stock = max(0, (stock before + snow - potential) * decay) is a walk clamped at zero: with each step
    scaled by decay^-k it is a running sum minus its running minimum. A missing temperature or snow step
    empties the stock and starts a new walk.
    """
    upto = axis.running()
    reset = F.col("melt_potential").isNull() | F.col("snow").isNull()
    first = F.min("_pos").over(axis.whole()) - 1
    df = df.withColumns(
        {
            "_seg": F.sum(F.when(reset, 1).otherwise(0)).over(upto),
            "_k": F.col("_pos") - F.coalesce(F.max(F.when(reset, F.col("_pos"))).over(upto), first),
        }
    )
    decay = F.lit(STOCK_DECAY)
    inside = Window.partitionBy(*axis.keys, "_blk", "_seg").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(~reset, (F.col("snow") - F.col("melt_potential")) * F.pow(decay, 1 - F.col("_k"))).otherwise(0.0)
    df = df.withColumn("_walk", F.sum(step).over(inside))
    low = F.least(F.lit(0.0), F.min("_walk").over(inside))
    stock = F.when(reset, 0.0).otherwise(F.pow(decay, F.col("_k")) * (F.col("_walk") - low))
    df = df.withColumn("snow_stock", stock)
    before = F.coalesce(F.lag("snow_stock").over(axis.window()), F.lit(0.0))
    melt = F.when(F.col("melt_potential").isNull(), None).otherwise(
        F.least(F.col("melt_potential"), before + F.col("snow"))
    )
    return df.withColumn("melt", melt).drop("_seg", "_k", "_walk")


def snow_memory() -> int:
    """Steps after which the decay has faded an old stock below double precision."""
    return math.ceil(36.8 / -math.log(STOCK_DECAY))


def weather_base(weather: DataFrame, basins: DataFrame, axis: Axis, halo: int = 0, snow: bool = True) -> DataFrame:
    """Split rows with precipitation phase, evapotranspiration, melt and raw net inflow.

    Without `snow` the blocks get no history for the snow stock; melt and inflow are then of no use.
    """
    keys = list(axis.keys)
    means = reference_temperature(weather, keys)
    place = weather.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(f"_{c}") for c in ("lat", "lon")]
    )
    point = (
        place.join(means, keys)
        .join(basins, "site")
        .withColumn("distance_km", haversine_km(F.col("out_lat"), F.col("out_lon"), F.col("_lat"), F.col("_lon")))
        .withColumns(
            {
                "transfer_h": F.greatest(F.lit(1), F.floor(F.col("distance_km") / FLOW_SPEED_KMH)),
                "windows": distance_windows(F.col("distance_km")),
            }
        )
        .drop("_lat", "_lon", "out_lat", "out_lon")
    )
    split = axis.split(weather.join(point, keys), back=max(halo, 1) + (snow_memory() if snow else 0))
    w = axis.window()
    temp = basin_temperature(F.col("temp_k"), F.col("alt_basin"), F.col("alt"))
    df = split.withColumns(
        {
            "precip": floor_zero(diff(F.col("precip_cum_mm"), w, 1)),
            "temp": temp,
            "et0": et0(F.col("lat"), F.col("ts"), F.col("mean_temp_k"), F.col("kc_unit")),
        }
    )
    df = df.withColumns(
        {
            "rain": F.when(F.col("temp") > 0, F.col("precip")).otherwise(0.0),
            "snow": F.when(F.col("temp") <= 0, F.col("precip")).otherwise(0.0),
        }
    )
    df = df.withColumn(
        "ground_rain", F.when(F.col("rain") >= EFFECTIVE_RAIN_MM, F.col("rain") * INTERCEPTION).otherwise(0.0)
    )
    day = F.dayofyear("ts").cast("double")
    df = df.withColumn(
        "melt_potential",
        melt_potential(F.col("temp"), F.col("ground_rain"), day, F.col("k_base"), F.col("exposition")),
    )
    df = snow_scan(df, axis)
    raw = F.col("ground_rain") + F.col("melt") - F.col("et0")
    return df.withColumn("inflow_raw", F.when(raw > NET_INFLOW_MIN, raw).otherwise(0.0))


def _frame(weather: DataFrame, basins: DataFrame, axis: Axis, days: int = 37, snow: bool = True) -> DataFrame:
    """Split rows with net inflow and `days` of history for the windows built on them (weighted means need none)."""
    spd = axis.steps_per_day
    w = axis.window()
    df = weather_base(weather, basins, axis, halo=days * spd, snow=snow)
    temp = F.col("temp")
    df = df.withColumns({"temp_48h": rolling(F.avg, temp, w, 2 * spd, 1), "temp_24h": rolling(F.avg, temp, w, spd, 1)})
    high = F.col("alt_basin") > HIGH_BASIN_M
    frost = F.pow(bound((F.col("temp_24h") + 3) / 2, 0.05, 1.0), 3)
    return df.withColumns(
        {
            "frost_factor": F.when(high, frost),
            "net_inflow": F.when(high, F.col("inflow_raw") * frost).otherwise(F.col("inflow_raw")),
        }
    )


#: Local columns that do not depend on the snow stock, and those that look back further than a week.
SNOW_FREE = {
    "precip", "rain", "snow", "ground_rain", "temp", "et0", "temp_24h", "temp_48h", "temp_diff6_24h", "temp_diff6_48h",
    "cooling_6h", "warming_6h", "frost_factor", "frost_flag", "antecedent_rain", "deficit_7d", "deficit_30d",
    "rain_1h", "rain_3h", "rain_shock", "melt_potential", "transfer_h", "distance_km", "windows",
}
MONTH_BACK = {"deficit_30d", "net_mean_30d"}


def local_features(
    weather: DataFrame, basins: DataFrame, axis: Axis, lags: tuple[int, ...] = (), only: list[str] | None = None
) -> DataFrame:
    """Features at the weather point itself; `weather` must be gap-free per point.

    With `only`, those columns: the weighted mean and its pass over the blocks are left out unless asked for.
    """
    spd = axis.steps_per_day
    d3, d6 = max(1, spd // 8), max(1, spd // 4)
    w = axis.window()
    high = F.col("alt_basin") > HIGH_BASIN_M
    asked = None if only is None else set(only)
    lagged = {f"{kind}_{n}" for n in lags for kind in ("precip_lag", "temp_lag", "precip_sum")}
    days = max(8 if asked is not None and not asked & MONTH_BACK else 31, math.ceil(max(lags, default=0) / spd) + 1)
    snow = asked is None or not asked <= SNOW_FREE | lagged
    df = _frame(weather, basins, axis, days, snow).withColumn("melt_24h", F.when(high, rolling(F.sum, F.col("melt"), w, spd, 1)))

    temp, precip, net = F.col("temp"), F.col("precip"), F.col("net_inflow")
    change6 = diff(temp, w, d6)
    deficit = floor_zero(F.col("et0") - F.col("ground_rain"))
    stage = {
        "temp_diff6_48h": diff(F.col("temp_48h"), w, d6),
        "temp_diff6_24h": diff(F.col("temp_24h"), w, d6),
        "log_snow_stock": F.when(high, F.log1p("snow_stock")),
        "cooling_6h": F.when(high, F.when(change6 > 0, 0.0).otherwise(change6)),
        "warming_6h": F.when(high, floor_zero(change6)),
        "stock_x_temp": F.when(high, F.col("snow_stock") * temp),
        "rain_on_snow": F.when(high, F.col("ground_rain") * F.col("snow_stock")),
        "melt_72h": F.when(high, rolling(F.sum, F.col("melt"), w, 3 * spd, 1)),
        "melt_168h": F.when(high, rolling(F.sum, F.col("melt"), w, 7 * spd, 1)),
        "melt_gradient_24h": F.when(high, diff(F.col("melt_24h"), w, spd)),
        "frost_flag": F.when(
            high & (F.col("point") == 1), F.coalesce(F.col("frost_factor") < FROST_LIMIT, F.lit(False)).cast("int")
        ),
        "deficit_7d": rolling(F.sum, deficit, w, 7 * spd, 1),
        "deficit_30d": rolling(F.sum, deficit, w, 30 * spd, 1),
        "rain_1h": precip,
        "rain_3h": rolling(F.sum, precip, w, d3),
        "rain_shock": precip / (rolling(F.avg, precip, w, spd) + OFFSET),
        "net_mean_30d": rolling(F.avg, net, w, 30 * spd, 1),
        "melt_ratio": F.col("melt") / (net + EPS),
        **{
            f"inflow_sum_{h}h": F.when(F.array_contains("windows", h), rolling(F.sum, net, w, max(1, h * spd // 24)))
            for h in WINDOW_HOURS
        },
    }
    for n in lags:
        stage[f"precip_lag_{n}"] = F.lag(precip, n).over(w)
        stage[f"temp_lag_{n}"] = F.lag("temp_k", n).over(w)
        stage[f"precip_sum_{n}"] = rolling(F.sum, precip, w, n)
    if only is None or "antecedent_rain" in only:
        df = ewm_means(df, axis, "ground_rain", {"antecedent_rain": (15 * spd, 1)})
    done = axis.core(df.withColumns(stage))
    return done if only is None else done.select(*axis.keys, axis.ts, *only)


def saturation_features(weather: DataFrame, basins: DataFrame, axis: Axis) -> DataFrame:
    """30-day inflow mean against its mean since the start of the series, and changes of that index.

    The mean since the start comes as totals of earlier blocks; the part of those totals that the halo
    repeats is taken off again.
    """
    spd = axis.steps_per_day
    w, upto = axis.window(), axis.running()
    df = _frame(weather, basins, axis)
    df = df.withColumn("net_mean_30d", rolling(F.avg, F.col("net_inflow"), w, 30 * spd, 1))
    m30 = F.col("net_mean_30d")
    totals = {"_sum": m30, "_cnt": F.when(m30.isNotNull(), 1)}
    carry = block_prefix(df.where("_core"), axis, {f"{n}_before": c for n, c in totals.items()})
    df = df.join(carry, [*axis.keys, "_blk"], "left")

    def expanding(n: str) -> Column:
        c = totals[n]
        halo_part = F.coalesce(F.sum(F.when(~F.col("_core"), c)).over(axis.whole()), F.lit(0))
        return F.col(f"{n}_before") + F.sum(c).over(upto) - halo_part

    df = df.withColumn("saturation", m30 / (expanding("_sum") / expanding("_cnt") + EPS))
    steps = {168: 7 * spd, 48: 2 * spd, 24: spd, 6: max(1, spd // 4)}
    df = df.withColumns({f"saturation_diff_{h}": diff(F.col("saturation"), w, n) for h, n in steps.items()})
    return axis.core(df).select(*axis.keys, axis.ts, "saturation", *[f"saturation_diff_{h}" for h in steps])


RESERVES = ("reserve_flash", "reserve_short", "reserve_medium", "reserve_base", "ratio_fast_base")
TRAVELLED = (
    "inflow_shifted", "discharge", "discharge_gradient_1h", "discharge_gradient_3h", "discharge_accel_6h",
    "inflow_acceleration", "hydraulic_shock", *RESERVES, "reactivity_12h", "discharge_mean_6h", "discharge_mean_24h",
    "discharge_mean_7d", "discharge_mean_30d", "surge_relative",
    *[f"{n}_{h}h" for h in WINDOW_HOURS for n in ("inflow_mean", "discharge", "inflow_lag")],
)


def travelled_features(weather: DataFrame, basins: DataFrame, axis: Axis, only: list[str] | None = None) -> DataFrame:
    """Features of the inflow when it reaches the outlet, `transfer_h` steps later.

    The travel time is constant per point, so they are built at the point and moved as whole rows. With `only`,
    those columns: the reserves and their pass over the blocks are left out unless asked for.
    """
    reserves = only is None or bool(set(RESERVES) & set(only))
    spd = axis.steps_per_day
    d3, d6, half = max(1, spd // 8), max(1, spd // 4), max(1, spd // 2)
    w = axis.window()
    days = 37 if only is None or "discharge_mean_30d" in only else 15
    df = _frame(weather, basins, axis, days).withColumn("inflow_shifted", F.col("net_inflow"))
    df = df.withColumn("discharge", F.col("inflow_shifted") * F.col("surface_km2") / 3.6)
    x, q = F.col("inflow_shifted"), F.col("discharge")
    df = df.withColumns(
        {
            "discharge_gradient_1h": diff(q, w, 1),
            "discharge_gradient_3h": diff(q, w, d3),
            "inflow_acceleration": diff(x, w, d3),
            "hydraulic_shock": diff(x, w, d6) / (F.lag(x, d6).over(w) + OFFSET),
            "_mean_half_day": rolling(F.avg, x, w, half, 1),
            **{f"_mean_{h}": rolling(F.avg, x, w, max(1, h * spd // 24), 1) for h in WINDOW_HOURS},
            **{f"_lag_{h}": F.lag(x, max(1, h * spd // 24)).over(w) for h in WINDOW_HOURS},
        }
    )
    if reserves:
        spans = dict(zip(RESERVES, (half, 3 * spd, 7 * spd, 30 * spd)))
        df = ewm_means(df, axis, "inflow_shifted", {name: (span, 1) for name, span in spans.items()})
        df = df.withColumn("ratio_fast_base", F.col("reserve_short") / (F.col("reserve_base") + EPS))

    def used(h: int) -> Column:
        return F.array_contains("windows", h)

    last = F.when(used(168), F.col("_mean_168")).otherwise(F.col("_mean_72"))
    df = df.withColumns(
        {
            "discharge_accel_6h": diff(F.col("discharge_gradient_3h"), w, d3),
            **{f"inflow_mean_{h}h": F.when(used(h), F.col(f"_mean_{h}")) for h in WINDOW_HOURS},
            **{f"discharge_{h}h": F.when(used(h), F.col(f"_mean_{h}") * F.col("surface_km2") / 3.6) for h in WINDOW_HOURS},
            **{f"inflow_lag_{h}h": F.when(used(h), F.col(f"_lag_{h}")) for h in WINDOW_HOURS},
            "reactivity_12h": F.col("_mean_half_day") / (last + EPS),
        }
    )
    # Every distance class has a 24 h window; its discharge is the reference of the slower means.
    ref = F.col("discharge_24h")
    df = df.withColumns(
        {
            "discharge_mean_6h": rolling(F.avg, ref, w, d6, 1),
            "discharge_mean_24h": rolling(F.avg, ref, w, spd, 1),
            "discharge_mean_7d": rolling(F.avg, ref, w, 7 * spd, spd),
            "discharge_mean_30d": rolling(F.avg, ref, w, 30 * spd, spd),
        }
    )
    df = df.withColumn("surge_relative", q / (F.col("discharge_mean_6h") + OFFSET))
    arrival = F.timestamp_seconds(F.unix_seconds(F.col(axis.ts)) + F.col("transfer_h") * axis.step)
    return axis.core(df).select(*axis.keys, arrival.alias(axis.ts), *(TRAVELLED if only is None else only))


def weather_features(
    weather: DataFrame, basins: DataFrame, axis: Axis, lags: tuple[int, ...] = (), only: list[str] | None = None
) -> DataFrame:
    """All features per weather point and step except the saturation index (see `saturation_features`).

    With `only`, those columns, from the side (at the point, or arrived at the outlet) that makes them.
    """
    keys = [*axis.keys, axis.ts]
    if only is None:
        return local_features(weather, basins, axis, lags).join(travelled_features(weather, basins, axis), keys, "left")
    moved = [c for c in only if c in TRAVELLED]
    here = [c for c in only if c not in TRAVELLED]
    rows = local_features(weather, basins, axis, lags, here) if here else weather.select(*keys)
    if moved:
        rows = rows.join(travelled_features(weather, basins, axis, moved), keys, "left")
    return rows.select(*keys, *only)


def basin_inflow(weather: DataFrame, basins: DataFrame, axis: Axis) -> DataFrame:
    """Mean discharge at the outlet over the weather points of a site; missing points are skipped."""
    keys = [*axis.keys, axis.ts]
    arrived = travelled_features(weather, basins, axis, only=["discharge"])
    return weather.select(*keys).join(arrived, keys, "left").groupBy("site", axis.ts).agg(
        F.avg("discharge").alias("basin_inflow")
    )
