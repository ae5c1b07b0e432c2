"""Flow to turbine power with nested plant records; everything is a Column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.functions.columns import GRAVITY, floor_zero, polynomial
from rivermill.session import spread


def head(group: Column, q: Column) -> Column:
    """Available head at total inflow: first segment that holds `q`, else the last; never negative."""
    segments = group["head"]
    hit = F.filter(segments, lambda s: (q >= s["q_min"]) & (q <= s["q_max"]))
    chosen = F.coalesce(F.get(hit, F.lit(0)), F.element_at(segments, -1))
    return floor_zero(polynomial(chosen["coeffs"], q))


def efficiency(group: Column, q: Column) -> Column:
    return floor_zero(polynomial(group["efficiency"], q))


def order_groups(groups: Column) -> Column:
    """By ascending priority; equal priorities keep their listed order."""
    indexed = F.transform(groups, lambda g, i: F.struct(g["priority"].alias("_p"), i.alias("_i"), g.alias("g")))
    return F.transform(F.array_sort(indexed), lambda s: s["g"])


def best_priority(groups: Column) -> Column:
    return F.array_min(F.transform(groups, lambda g: g["priority"]))


def reserve_flow(ts: Column) -> Column:
    """Flow that may not be used: constant, or by an inclusive summer period (month * 100 + day)."""
    day = F.month(ts) * 100 + F.dayofmonth(ts)
    summer = day.between(F.col("summer_from"), F.col("summer_to"))
    seasonal = F.col("reserve_summer").isNotNull() & F.col("reserve_winter").isNotNull()
    by_season = F.when(summer, F.col("reserve_summer")).otherwise(F.col("reserve_winter"))
    return F.when(seasonal, by_season).otherwise(F.coalesce("reserve_flow", F.lit(0.0)))


def dispatch(available: Column, groups: Column, sort: bool = True) -> Column:
    """Flow per group in priority order: at most its maximum, nothing below its arming flow."""
    empty = F.array().cast("array<double>")
    start = F.struct(available.cast("double").alias("left"), empty.alias("used"))

    def step(acc: Column, g: Column) -> Column:
        wanted = F.least(acc["left"], g["max_flow"])
        taken = F.when(wanted < g["arm_flow"], 0.0).otherwise(wanted)
        rest = F.greatest(acc["left"] - taken, F.lit(0.0))
        return F.struct(rest.alias("left"), F.concat(acc["used"], F.array(taken)).alias("used"))

    return F.aggregate(order_groups(groups) if sort else groups, start, step)["used"]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def plant_records(registry: DataFrame) -> DataFrame:
    """What a flow point needs of a plant, worked out once per plant: ordered groups and each group's
    full-load power per metre of head."""

    def full_load(g: Column) -> Column:
        return g["max_flow"] * efficiency(g, g["max_flow"]) / 100 * GRAVITY

    ordered = order_groups(F.col("groups"))
    return registry.select(
        "site", "reserve_flow", "reserve_summer", "reserve_winter", "summer_from", "summer_to",
        ordered.alias("ordered"), F.transform(ordered, full_load).alias("full_load"),
    )


def hydraulic_points(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds usable and reserved flow, power, dynamic maximum, head and efficiency of the first group to
    `df(site, ts, flow, ...)`. Nested records take far more memory than their file, whose size would
    have them broadcast: a merge join."""
    keep, q = df.columns, F.col("flow")
    df = df.join(plant_records(registry).hint("merge"), "site").withColumn("_reserve", reserve_flow(F.col("ts")))
    df = df.withColumn("_available", F.greatest(q - F.col("_reserve"), F.lit(0.0)))
    df = df.withColumns(
        {
            "_used": dispatch(F.col("_available"), F.col("ordered"), sort=False),
            "_heads": F.transform("ordered", lambda g: head(g, q)),
        }
    )
    df = df.withColumn("_effs", F.zip_with("ordered", "_used", efficiency))
    load = F.zip_with("_used", "_effs", lambda u, e: u * e / 100 * GRAVITY)
    none = F.coalesce(F.size("ordered"), F.lit(0)) <= 0

    def at_head(per_metre) -> Column:
        return _sum(F.zip_with(per_metre, "_heads", lambda p, h: p * h))

    return df.select(
        *keep,
        F.round(F.when(none, F.col("_available")).otherwise(_sum(F.col("_used"))), 3).alias("usable"),
        F.round(F.least(q, F.col("_reserve")), 3).alias("reserved"),
        F.round(F.when(none, 0.0).otherwise(at_head(load)), 1).alias("power"),
        F.round(F.when(none, 0.0).otherwise(at_head("full_load")), 1).alias("power_max"),
        F.round(F.when(none, 0.0).otherwise(F.get("_heads", F.lit(0))), 3).alias("head"),
        F.round(F.when(none, 0.0).otherwise(F.get("_effs", F.lit(0))), 2).alias("efficiency"),
    )


def missing_fields(registry: DataFrame) -> DataFrame:
    """Names of absent plant fields, per record, in a fixed order."""
    default = F.col("strategy") == "DEFAULT"
    no_groups = F.coalesce(F.size("groups"), F.lit(0)) <= 0

    def group_fields(g: Column) -> Column:
        label = F.concat(F.lit("groups["), F.coalesce(g["name"], F.lit("?")), F.lit("]."))
        listed = [F.when(g[f].isNull(), F.concat(label, F.lit(f))) for f in ("priority", "arm_flow", "max_flow", "efficiency", "head")]
        return F.array_compact(F.array(*listed))

    top = F.array_compact(
        F.array(
            F.when(~F.coalesce(default, F.lit(False)), "strategy"),
            F.when(default & F.col("ref_station").isNull(), "ref_station"),
            F.when(default & (F.coalesce(F.size("upstream_stations"), F.lit(0)) <= 0), "upstream_stations"),
            F.when(F.col("flow_factor").isNull(), "flow_factor"),
            F.when(no_groups, "groups"),
        )
    )
    per_group = F.flatten(F.transform(F.coalesce("groups", F.array().cast(registry.schema["groups"].dataType)), group_fields))
    return registry.select("site", F.concat(top, per_group).alias("missing"))


def turbine_time(df: DataFrame, transit: DataFrame, step_hours: int = 1) -> DataFrame:
    """Moves flow from the gauging station to the turbine: whole hours of travel by season, flow factor."""
    from rivermill.operators.upstream import transit_hours

    shifted = transit_hours(df, transit, 0.0)
    hours = F.bround("hours").cast("int")
    return shifted.select(
        *[c for c in df.columns if c not in ("ts", "flow", "flow_factor", "season", "hours")],
        (F.col("ts") + F.make_interval(hours=hours)).alias("turbine_ts"),
        (F.col("flow") * F.coalesce("flow_factor", F.lit(1.0))).alias("turbine_flow"),
    )


def match_folders(registry: DataFrame, folders: DataFrame, mapping: DataFrame) -> DataFrame:
    """Power-data folder of each plant: explicit mapping first, else the one folder whose name holds the
    plant keyword and ends with one of its groups.

    Folder names are short, so each is expanded into (ending, piece) keys and both conditions become one
    equi join; no pair is formed that does not match. Only the lengths of the keywords are broadcast: all
    other sides grow with the plants or the folders, the keys to many times the size of their file.
    """
    from rivermill.functions.columns import fold_text

    wanted = registry.select(
        "site",
        fold_text(F.col("plant")).alias("piece"),
        F.explode(F.filter(F.transform("groups", lambda g: g["name"]), lambda n: n.isNotNull())).alias("_g"),
    ).select("site", "piece", F.lower("_g").alias("ending")).where(F.length("piece") > 0)
    sizes = wanted.select(F.length("piece").alias("_len")).distinct()
    names = spread(folders.select("folder")).withColumn("_name", fold_text(F.col("folder")))
    parts = F.split("_name", "_")
    endings = F.transform(
        F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "_")
    )
    keyed = (
        names.where(F.size(parts) > 1)
        .select("folder", "_name", F.explode(endings).alias("ending"))
        .withColumn("_len", F.explode(F.sequence(F.lit(1), F.length("_name"))))
        .join(F.broadcast(sizes), "_len")
        .select(
            "folder",
            "ending",
            F.explode(
                F.array_distinct(
                    F.transform(
                        F.sequence(F.lit(1), F.length("_name") - F.col("_len") + 1),
                        lambda i: F.substring(F.col("_name"), i, F.col("_len")),
                    )
                )
            ).alias("piece"),
        )
    )
    found = (
        wanted.join(keyed.hint("merge"), ["piece", "ending"])
        .select("site", "folder")
        .distinct()
        .groupBy("site")
        .agg(F.count(F.lit(1)).alias("candidates"), F.min("folder").alias("_only"))
    )
    there = folders.select(F.col("folder").alias("mapped"), F.lit(True).alias("_there"))
    mapped = mapping.join(there.hint("merge"), "mapped", "left")
    has_map = F.col("mapped").isNotNull()
    folder = F.when(has_map, F.when(F.col("_there"), F.col("mapped"))).otherwise(F.when(F.col("candidates") == 1, F.col("_only")))
    return (
        registry.select("site")
        .join(found.hint("merge"), "site", "left")
        .join(mapped.hint("merge"), "site", "left")
        .select(
            "site",
            folder.alias("folder"),
            F.when(has_map, F.lit(0)).otherwise(F.coalesce("candidates", F.lit(0))).cast("long").alias("candidates"),
            F.when(folder.isNull(), "unresolved").when(has_map, "mapped").otherwise("matched").alias("status"),
        )
    )
