"""Preference pairs as prompt and masked completions.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once as the prompt; what
follows on either side is its completion, with a mask of one character per character of the completion: `1` where
the loss counts (text and end mark of assistant turns), else `0`. Turns stand in the order of their number, then role,
then text; repeated rows count once. A null text is empty, a null role is written `none`; null numbers come first. A
pair that lacks one side has the other side whole as its completion; equal sides have empty completions. Marks inside a
text are escaped, so no text can open or close a turn. A pair is one row of the result, hence met as one array. All is
built of DataFrame functions; further columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
HEAD, BODY, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def _escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), _escaped(F.coalesce(turn["role"], F.lit("none"))), F.lit(BODY))


def _body(turn: Column) -> Column:
    return F.concat(_escaped(turn["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """`0` and `1` for every character of `rendered`."""
    counts = lambda t: F.when(t["role"] == TRAINED, F.lit("1")).otherwise(F.lit("0"))
    return F.array_join(F.transform(turns, lambda t: F.concat(F.repeat(F.lit("0"), F.length(_head(t))), F.repeat(counts(t), F.length(_body(t))))), "")


def conversations(turns: DataFrame, key: str) -> DataFrame:
    """One row per key with its turns as a sorted array."""
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    return turns.groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_set(turn)).alias("_turns"))


def format_preferences(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per key of either table of turns (`key`, `turn`, `role`, `text`)."""
    c, r = conversations(chosen, key).alias("c"), conversations(rejected, key).alias("r")
    kind = c.schema["_turns"].dataType.simpleString()
    none = F.array().cast(kind)
    pairs = c.join(r, F.col("c._key").eqNullSafe(F.col("r._key")), "full_outer").select(
        F.coalesce("c._key", "r._key").alias(key), F.coalesce("c._turns", none).alias("_c"), F.coalesce("r._turns", none).alias("_r"),
    )
    shorter = F.least(F.size("_c"), F.size("_r"))
    same = F.zip_with(F.slice("_c", F.lit(1), shorter), F.slice("_r", F.lit(1), shorter), lambda a, b: a.eqNullSafe(b))
    first_other = F.array_position(same, False)
    pairs = pairs.withColumn("n_common", F.when(first_other > 0, first_other - 1).otherwise(shorter).cast("long"))
    start = (F.col("n_common") + 1).cast("int")
    left = {side: F.slice(side, start, F.size(side)) for side in ("_c", "_r")}
    return pairs.select(
        key, rendered(F.slice("_c", F.lit(1), F.col("n_common").cast("int"))).alias("prompt"), "n_common",
        rendered(left["_c"]).alias("chosen"), mask(left["_c"]).alias("chosen_mask"),
        rendered(left["_r"]).alias("rejected"), mask(left["_r"]).alias("rejected_mask"),
    )


def swapped_answers(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rejected conversations where the table has none: the last assistant text is that of the neighbouring key.

    Keys 2k and 2k+1 lend each other their last answer. A conversation without an answer or a neighbour stays as it is.
    Further columns are left out before anything meets, so their names do not matter.
    """
    turns = turns.select(key, "turn", "role", "text")
    last = turns.where(F.col("role") == TRAINED).groupBy(key).agg(F.max(F.struct("turn", "text")).alias("_last"))
    own = last.select(F.col(key).alias("_own"), F.col("_last.turn").alias("_turn"))
    lent = last.select(F.col(key).bitwiseXOR(F.lit(1)).alias("_to"), F.col("_last.text").alias("_lent"))
    swaps = own.join(lent, F.col("_own") == F.col("_to")).select("_own", "_turn", "_lent")
    here = (F.col("role") == TRAINED) & F.col("turn").eqNullSafe(F.col("_turn")) & F.col("_own").isNotNull()
    return turns.join(swaps, F.col(key) == F.col("_own"), "left").select(key, "turn", "role", F.when(here, F.col("_lent")).otherwise(F.col("text")).alias("text"))
