"""Model-side windows: trend, lead matrix, weather lags, sliding sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.functions.blocks import Axis, diff, rolling
from rivermill.functions.columns import cyclic, floor_zero

MIN_UPSTREAM_VALUES = 100


def trend_slope(df: DataFrame, axis: Axis, value: str = "flow", n: int = 72, min_periods: int = 12) -> DataFrame:
    """Least-squares slope per step over the last `n` rows, 0 where too few values."""
    frame = axis.window().rowsBetween(-(n - 1), 0)
    split = axis.split(df, back=n - 1)
    x = F.when(F.col(value).isNotNull(), F.col("_pos").cast("double"))
    # Positions relative to the row keep the sums of squares small.
    slope = F.regr_slope(F.col(value), x).over(frame)
    enough = F.count(value).over(frame) >= min_periods
    return axis.core(split.withColumn("trend", F.coalesce(F.when(enough, slope), F.lit(0.0))))


def lead_matrix(df: DataFrame, axis: Axis, value: str, horizon: int, name: str = "leads") -> DataFrame:
    """Values of the next `horizon` steps as an array; NULL when any step lies outside the series."""
    w = axis.window()
    split = axis.split(df, ahead=horizon)
    inside = F.lead(F.lit(1), horizon).over(w).isNotNull()
    steps = F.array(*[F.lead(value, k).over(w) for k in range(1, horizon + 1)])
    return axis.core(split.withColumn(name, F.when(inside, steps)))


def weather_lag_block(df: DataFrame, axis: Axis, columns: list[str], horizon: int) -> DataFrame:
    w = axis.window()
    split = axis.split(df, back=horizon)
    return axis.core(split.withColumns({f"{c}_lag": F.coalesce(F.lag(c, horizon).over(w), F.lit(0.0)) for c in columns}))


def sequence_stations(up: DataFrame, transit: DataFrame, horizon: int) -> DataFrame:
    """Upstream stations with enough values, ordered by longest travel time, and the sequence length of the site."""
    counts = up.groupBy("site", "station").agg(F.count("upstream").alias("n_values"))
    longest = transit.groupBy("site", "station").agg(F.max("hours").alias("max_hours"))
    kept = counts.where(F.col("n_values") > MIN_UPSTREAM_VALUES).join(longest, ["site", "station"])
    length = kept.groupBy("site").agg(
        F.greatest(F.max("max_hours") * 4, F.lit(float(horizon * 3)), F.lit(48.0)).cast("long").alias("seq_len")
    )
    return kept.join(length, "site")


def _steps(df: DataFrame, axis: Axis, logs: list[str], rains: list[str], plain: list[str]) -> tuple[DataFrame, list[str]]:
    """Per-row inputs of a sequence: log flows, 6-row rain sums, plain values, clock and calendar."""
    w = axis.window()
    prepared = {f"s_{c}": F.log1p(floor_zero(F.col(c))) for c in logs}
    df = df.withColumns({f"_inc_{c}": floor_zero(diff(F.col(c), w, 1)) for c in rains}) if rains else df
    prepared |= {f"s_{c}": rolling(F.sum, F.col(f"_inc_{c}"), w, 6, 1) for c in rains}
    prepared |= {f"s_{c}": F.col(c) for c in plain}
    ts = F.col(axis.ts)
    (prepared["s_hour_sin"], prepared["s_hour_cos"]) = cyclic(F.hour(ts), 24)
    (prepared["s_doy_sin"], prepared["s_doy_cos"]) = cyclic(F.dayofyear(ts), 365)
    return df.withColumns(prepared), list(prepared)


def _window_array(names: list[str], target: str, seq_len: int, steps: Column, fill_null: bool) -> Column:
    """Blanks the target in the future part, adds the future flag."""

    def row(s: Column, i: Column) -> Column:
        future = i >= seq_len
        cells = []
        for n in names:
            v = F.coalesce(s[n], F.lit(0.0)) if fill_null else s[n]
            cells.append(F.when(future, 0.0).otherwise(v) if n == f"s_{target}" else v)
        return F.array(*[c.cast("float") for c in cells], F.when(future, 1.0).otherwise(0.0).cast("float"))

    return F.transform(steps, row)


def sliding_sequences(
    df: DataFrame, axis: Axis, seq_len: int, horizon: int, target: str = "flow",
    logs: tuple[str, ...] = (), rains: tuple[str, ...] = (), plain: tuple[str, ...] = (), stride: int = 1,
) -> DataFrame:
    """One row per complete window: `x` (steps by inputs), `y` (next values, log), anchored at the last
    known step `ts`. `stride` keeps every n-th anchor."""
    split = axis.split(df, back=seq_len + 6, ahead=horizon)
    rows, names = _steps(split, axis, [target, *logs], list(rains), list(plain))
    w = axis.window().rowsBetween(-(seq_len - 1), horizon)
    total = seq_len + horizon
    filled = F.lit(True)
    for n in names:
        filled = filled & F.col(n).isNotNull()
    rows = rows.withColumn("_full", F.count(F.when(filled, 1)).over(w) == total)
    steps = F.collect_list(F.struct(*names)).over(w)
    rows = rows.withColumn("_steps", F.when(F.col("_full"), steps))
    kept = axis.core(rows.where("_full AND _core").where(F.pmod("_pos", F.lit(stride)) == 0).withColumns(
        {
            "x": _window_array(names, target, seq_len, F.col("_steps"), False),
            "y": F.transform(F.slice("_steps", seq_len + 1, horizon), lambda s: s[f"s_{target}"]),
        }
    ))
    return kept.select(*axis.keys, axis.ts, "x", "y")


def last_window(
    df: DataFrame, axis: Axis, seq_len: int, horizon: int, target: str = "flow",
    logs: tuple[str, ...] = (), rains: tuple[str, ...] = (), plain: tuple[str, ...] = (),
) -> DataFrame:
    """The window of the last `seq_len + horizon` rows per series, missing values as 0."""
    from rivermill.operators.prepare import tail_rows

    total = seq_len + horizon
    known = tail_rows(df.withColumn("_one", F.lit(1)), total + 7, "_one", axis.keys[0]).drop("_one")
    rows, names = _steps(
        known.withColumns({"_pos": axis.position(), "_blk": F.lit(0)}), axis, [target, *logs], list(rains), list(plain)
    )
    item = F.struct("_pos", *names)
    grouped = rows.groupBy(*axis.keys).agg(F.array_sort(F.collect_list(item)).alias("_all"))
    tail = F.slice("_all", -total, total)
    return (
        grouped.where(F.size("_all") >= total)
        .withColumn("_steps", tail)
        .select(*axis.keys, _window_array(names, target, seq_len, F.col("_steps"), True).alias("x"))
    )
