"""Jump consistent hashing of stable keys to shards, with a gapless slot per shard.

No ring table: key and shard count alone give the shard, and one more shard takes rows only into itself. Whole-number
keys seed the generator as they are; other keys do so by their 64-bit hash. A null key is the number 0 of a hashed key.
Rows with equal keys share a shard and take neighbouring slots. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Fixed values of the published generator.
MULTIPLIER = np.uint64(2862933555777941757)
#: Pieces of a shard within which rows are numbered; 4096 of them keep a piece of 10^12 rows over 100 shards in one task.
PIECES = 4096


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every key (uint64): jumps ahead until the next jump would pass the last shard."""
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(keys), np.int64)
    ahead = np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    while len(active):
        shard[active] = ahead[active]
        state[active] = state[active] * MULTIPLIER + np.uint64(1)
        step = (state[active] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[active] = ((shard[active] + 1) * (2147483648.0 / step)).astype(np.int64)
        active = active[ahead[active] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a long key as an int column."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def jumped(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jumped(key)


def stable_key(df: DataFrame, column: str) -> Column:
    whole = isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(F.col(column).cast("long") if whole else F.xxhash64(F.col(column)), F.lit(0).cast("long"))


def assign_shards(df: DataFrame, key: str, shards: int, grow_by: int = 1, **measures: Column) -> DataFrame:
    """`key`, the measures, `shard`, `slot` (0 and up, without gaps, per shard) and `grown_shard` for every row of `df`.

    The count per piece reads the key alone; offsets of the pieces are one row per shard and piece, and a piece is
    numbered by itself, so no task holds a shard.
    """
    k = stable_key(df, key)
    piece = F.pmod(F.xxhash64(k), F.lit(PIECES)).cast("int")
    counts = df.select(shard_of(k, shards).alias("shard"), piece.alias("_piece")).groupBy("shard", "_piece").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = df.select(
        F.col(key), *[c.alias(n) for n, c in measures.items()], piece.alias("_piece"),
        shard_of(k, shards).alias("shard"), shard_of(k, shards + grow_by).alias("grown_shard"),
    )
    # shard before anything else: rows of a piece meet by (shard, piece) both for the join and for the numbering
    ranks = Window.partitionBy("shard", "_piece").orderBy(F.col(key), *[F.col(n) for n in measures])
    slot = (F.col("_offset") + F.row_number().over(ranks) - 1).cast("long")
    return placed.join(offsets, ["shard", "_piece"]).withColumn("slot", slot).select(key, *measures, "shard", "slot", "grown_shard")
