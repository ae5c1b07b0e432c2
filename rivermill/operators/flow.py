"""Autoregressive features of a gap-free flow series."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermill.functions.blocks import Axis, rolling
from rivermill.functions.columns import EPS, cap
from rivermill.functions.ewm import ewm_means

TREND_EPS = 1e-3


def flow_lags(horizon: int, spd: int) -> list[int]:
    lags = {horizon, int(1.5 * horizon), 2 * horizon, 3 * horizon, 4 * horizon, 7 * spd, 14 * spd}
    return sorted(lags)


def rolling_quantile(
    df: DataFrame, axis: Axis, value: str, n: int, min_periods: int, q: float, name: str
) -> DataFrame:
    """Exact moving quantile. A moving frame re-sorts its rows at every step in Spark, so each block
    (with `n - 1` rows of history) goes through one sliding pass in pandas instead."""
    keys, base = list(axis.keys), [*axis.keys, axis.ts, value]
    split = axis.split(df.select(*base), back=n - 1)
    out = T.StructType([*[split.schema[c] for c in base], T.StructField(name, T.DoubleType())])

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        pdf[name] = pdf[value].rolling(n, min_periods=min_periods).quantile(q)
        return pdf.loc[pdf["_core"], [*base, name]]

    quantiles = split.groupBy(*keys, "_blk").applyInPandas(one_block, out)
    # The value travels along, so only further columns need a join.
    if set(df.columns) == set(base):
        return quantiles
    return df.join(quantiles.drop(value), [*keys, axis.ts])


#: Columns that need the moving 95 % quantile of a year, of these the weighted means, and those that need the last 30 days.
CAPPED = {"q95_year", "max_seen_30d", "decline_vs_max", "baseflow_7d", "baseflow_30d", "ratio_fast_base"}
BASEFLOW = {"baseflow_7d", "baseflow_30d", "ratio_fast_base"}
MONTHLY = {"anomaly_zscore", "ratio_seasonal"}


def flow_features(df: DataFrame, axis: Axis, horizon: int, value: str = "flow", only: list[str] | None = None) -> DataFrame:
    """Lags, gradients, recession, baseflow and anomaly columns next to `value`; with `only`, those columns and what they need.

    The series must be gap-free, so that row offsets are elapsed time.
    """
    spd = axis.steps_per_day
    lags = flow_lags(horizon, spd)
    capped, monthly = (only is None or bool(group & set(only)) for group in (CAPPED, MONTHLY))
    month, w, q = 30 * spd, axis.window(), F.col(value)
    halo = max(lags[-1], horizon + month if monthly else 0, month if capped else 0)
    rows = rolling_quantile(df, axis, value, 365 * spd, month, 0.95, "q95_year") if capped else df
    base = axis.split(rows, back=halo).withColumns({f"lag_{n}": F.lag(q, n).over(w) for n in lags})
    x = F.col(f"lag_{horizon}")
    slow = {}
    if capped:
        top = F.col("q95_year")
        base = base.withColumn("max_seen_30d", cap(rolling(F.max, q, w, month, 1), top))
    if capped and (only is None or bool(BASEFLOW & set(only))):
        plain = axis.split(df, back=halo).withColumn(f"lag_{horizon}", F.lag(q, horizon).over(w))
        base = ewm_means(base, axis, f"lag_{horizon}", {"_base7": (7 * spd, spd), "_base30": (month, spd)}, source=plain)
        slow |= {"baseflow_7d": cap(F.col("_base7"), top), "baseflow_30d": cap(F.col("_base30"), top)}
    if monthly:
        slow |= {"mean_30d": rolling(F.avg, x, w, month, 7 * spd), "std_30d": rolling(F.stddev_samp, x, w, month, 7 * spd)}
    base = base.withColumns(slow) if slow else base
    pairs = list(zip(lags, lags[1:]))
    gradient = {p: F.col(f"lag_{p[0]}") - F.col(f"lag_{p[1]}") for p in pairs}
    columns = {
        **{f"gradient_{a}v{b}": g for (a, b), g in gradient.items()},
        **{
            f"accel_{a}v{b}v{c}v{d}": gradient[(a, b)] - gradient[(c, d)]
            for (a, b), (c, d) in zip(pairs, pairs[1:])
        },
        "trend_rel": gradient[pairs[0]] / (x + TREND_EPS),
        **{
            f"recession_log_{lags[i]}": F.log1p(F.col(f"lag_{lags[i + 1]}")) - F.log1p(F.col(f"lag_{lags[i]}"))
            for i in (0, 2)
        },
    }
    if capped:
        columns["decline_vs_max"] = x / (F.col("max_seen_30d") + EPS)
    if "baseflow_7d" in slow:
        columns["ratio_fast_base"] = F.col("baseflow_7d") / (F.col("baseflow_30d") + EPS)
    if monthly:
        columns["anomaly_zscore"] = (x - F.col("mean_30d")) / (F.col("std_30d") + EPS)
        columns["ratio_seasonal"] = x / (F.col("mean_30d") + EPS)
    done = axis.core(base.withColumns(columns)).drop("mean_30d", "std_30d")
    return done if only is None else done.select(*df.columns, *only)
