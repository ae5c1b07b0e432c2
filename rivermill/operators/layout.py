"""Wide model matrix: any number of weather points and upstream stations per site in one vector of fitted slots."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis
from rivermill.functions.columns import cyclic
from rivermill.operators.flow import flow_features
from rivermill.operators.upstream import upstream_features
from rivermill.operators.weather import saturation_features, weather_features
from rivermill.session import materialise

#: Columns of the weather side that never change at one point, and helpers: no features.
STATIC = {
    "lat", "lon", "alt", "alt_basin", "surface_km2", "k_base", "exposition", "kc_unit", "mean_temp_k", "distance_km",
    "transfer_h", "windows", "inflow_raw",
}
#: Flow columns that hold the current flow and are unknown ahead.
CURRENT = {"flow", "q95_year", "max_seen_30d", "decline_vs_max"}


@dataclass(frozen=True)
class Source:
    """Features of one kind: one row per (site, member, ts), or per (site, ts) where `member` is None."""

    name: str
    rows: DataFrame
    features: tuple[str, ...]
    member: str | None = None


@dataclass(frozen=True)
class Layout:
    """Which slots of the vector belong to which member of which site.

    `members` has one row per (source, site, member): its place among the site's members of that source, and which
    features it has at all (a feature that is never known for a member, such as snow columns of a low basin, is absent
    there: its slot stays 0 and does not make rows incomplete). `shape` lists (source, features, most members of a site).
    """

    members: DataFrame
    shape: tuple[tuple[str, tuple[str, ...], int], ...]

    def names(self) -> list[str]:
        """Name of every slot; features of a member carry its place, counted from 1."""
        return [
            f"{f}_{place + 1}" if places else f
            for _, features, places in self.shape
            for place in range(max(places, 1))
            for f in features
        ]

    def save(self, path: str) -> None:
        rows = [(i, name, list(features), places) for i, (name, features, places) in enumerate(self.shape)]
        spark = self.members.sparkSession
        spark.createDataFrame(rows, "i INT, name STRING, features ARRAY<STRING>, places INT").write.parquet(f"{path}/shape")
        self.members.write.parquet(f"{path}/members")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Layout":
        rows = spark.read.parquet(f"{path}/shape").orderBy("i").collect()
        shape = tuple((r["name"], tuple(r["features"]), r["places"]) for r in rows)
        return Layout(spark.read.parquet(f"{path}/members"), shape)


def _keyed(source: Source) -> DataFrame:
    member = F.lit("") if source.member is None else F.col(source.member).cast("string")
    cells = F.array(*[F.col(f).cast("double") for f in source.features])
    order = F.lit(0) if source.member is None else F.col(source.member)
    return source.rows.select("site", "ts", member.alias("_member"), order.alias("_order"), cells.alias("_cells"))


def fit_layout(sources: list[Source]) -> Layout:
    """One aggregate per source over its rows: members in the order of their ids, and the features each one has."""
    indexes, shape = [], []
    for source in sources:
        known = F.array(*[F.max(F.col("_cells")[j].isNotNull()) for j in range(len(source.features))])
        seen = _keyed(source).groupBy("site", "_member").agg(F.first("_order").alias("_order"), known.alias("present"))
        # Ordered are the members of one site, not its rows.
        place = F.row_number().over(Window.partitionBy("site").orderBy("_order")) - 1
        index = seen.select(F.lit(source.name).alias("source"), "site", F.col("_member").alias("member"), place.alias("place"), "present")
        indexes.append(materialise(index, f"layout-{source.name}"))
        places = indexes[-1].agg(F.max("place")).first()[0]
        shape.append((source.name, tuple(source.features), 0 if source.member is None else (-1 if places is None else places) + 1))
    return Layout(reduce(DataFrame.unionByName, indexes), tuple(shape))


def unseen_members(layout: Layout, sources: list[Source]) -> DataFrame:
    """Members of `sources` the layout was not fitted on: they have no slot, so a model must be fitted anew to use them."""
    seen = [
        _keyed(s).select(F.lit(s.name).alias("source"), "site", F.col("_member").alias("member")).distinct() for s in sources
    ]
    return reduce(DataFrame.unionByName, seen).join(layout.members, ["source", "site", "member"], "left_anti")


def wide_matrix(layout: Layout, sources: list[Source], base: DataFrame) -> DataFrame:
    """`base` (site, ts, further columns) with `features` (sparse where that is smaller) and `complete`.

    All sources meet in one aggregate on (site, ts), which holds one array per member. A row is complete if every member
    of its site has a row at that time and knows every feature it has at all; a missing cell is 0. Rows of a member the
    layout does not know are left out (see `unseen_members`). Each source has at most one row per (site, member, ts).
    """
    parts, slots, first = [], [], 0
    by_name = {s.name: s for s in sources}
    for name, features, places in layout.shape:
        index = layout.members.where(F.col("source") == name).select("site", F.col("member").alias("_member"), "place", "present")
        rows = _keyed(by_name[name]).join(index, ["site", "_member"])
        full = reduce(lambda a, b: a & b, [F.col("_cells")[j].isNotNull() | ~F.col("present")[j] for j in range(len(features))])
        values = F.transform("_cells", lambda v: F.coalesce(v, F.lit(0.0)))
        parts.append(rows.select("site", "ts", full.alias("_full"), (F.lit(first) + F.col("place")).alias("_slot"), values.alias("_values")))
        slots += [(first + p, len(features)) for p in range(max(places, 1))]
        first += max(places, 1)
    cells = reduce(DataFrame.unionByName, parts).groupBy("site", "ts").agg(
        F.map_from_entries(F.collect_list(F.struct("_slot", "_values"))).alias("_at"), F.min("_full").alias("_full")
    )
    expected = layout.members.groupBy("site").agg(F.count(F.lit(1)).alias("_members"))
    joined = base.join(cells, ["site", "ts"], "left").join(expected, "site", "left")
    places = F.array(*[F.struct(F.lit(i).alias("slot"), F.lit(n).alias("n")) for i, n in slots])
    dense = F.flatten(
        F.transform(places, lambda s: F.coalesce(F.try_element_at("_at", s["slot"]), F.array_repeat(F.lit(0.0), s["n"])))
    )
    complete = F.coalesce(F.col("_full") & (F.size("_at") == F.col("_members")), F.lit(False))
    out = joined.withColumns({"complete": complete, "_dense": array_to_vector(dense)}).drop("_at", "_full", "_members")
    return VectorAssembler(inputCols=["_dense"], outputCol="features").transform(out).drop("_dense")


def matrix_sources(
    flow: DataFrame, weather: DataFrame, basins: DataFrame, upstream: DataFrame, transit: DataFrame, horizon: int,
    axis: Axis, points: Axis, stations: Axis, only: dict[str, list[str]] | None = None,
) -> list[Source]:
    """Flow with season, weather per point, mean inflow of the basin and upstream stations, each written once.

    All series are gap-free. `only` names the features of "flow", "weather" and "upstream"; without it, all there are.
    """
    only = only or {}
    own = flow_features(flow, axis, horizon, only=only.get("flow"))
    of_flow = only.get("flow") or [c for c in own.columns if c not in CURRENT | {"site", "ts"}]
    season_sin, season_cos = cyclic(F.dayofyear("ts") - 172, 365)
    own = own.withColumns({"season_sin": season_sin, "season_cos": season_cos})

    if "weather" in only:
        local, of_weather = weather_features(weather, basins, points, only=only["weather"]), only["weather"]
    else:
        local = weather_features(weather, basins, points)
        local = local.join(saturation_features(weather, basins, points), [*points.keys, points.ts], "left")
        of_weather = [c for c in local.columns if c not in STATIC | {*points.keys, points.ts}]
    local = materialise(local.select(*points.keys, points.ts, *of_weather), "wide-weather")

    lagged = flow_features(flow, axis, horizon, only=[f"lag_{horizon}"]).select("site", "ts", F.col(f"lag_{horizon}").alias("flow_lag"))
    above = upstream_features(upstream, transit, lagged, stations, horizon)
    of_upstream = only.get("upstream") or [c for c in above.columns if c.startswith("upstream_")]
    sources = [
        Source("flow", materialise(own, "wide-flow"), (*of_flow, "season_sin", "season_cos")),
        Source("weather", local, tuple(of_weather), "point"),
        Source("upstream", materialise(above, "wide-upstream"), tuple(of_upstream), "station"),
    ]
    if "discharge" in of_weather:
        basin = local.groupBy("site", "ts").agg(F.avg("discharge").alias("basin_inflow"))
        sources.append(Source("basin", materialise(basin, "wide-basin"), ("basin_inflow",)))
    return sources


def training_rows(layout: Layout, sources: list[Source], flow: DataFrame) -> DataFrame:
    """Complete rows with a known flow: (site, ts, flow, label on a log scale, features)."""
    base = flow.where(F.col("flow").isNotNull()).select("site", "ts", "flow", F.log1p("flow").alias("label"))
    return wide_matrix(layout, sources, base).where("complete").drop("complete")


def future_rows(layout: Layout, sources: list[Source], axis: Axis, flow: DataFrame, horizon: int) -> DataFrame:
    """Complete rows, and in any case the last `horizon` rows of each series: (site, ts, flow, complete, features)."""
    last = flow.groupBy("site").agg(F.max(axis.position()).alias("_last"))
    rows = wide_matrix(layout, sources, flow.select("site", "ts", "flow")).join(last, "site")
    return rows.where(F.col("complete") | (axis.position() > F.col("_last") - horizon)).drop("_last")
