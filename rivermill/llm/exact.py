"""Exact duplicates: local combining, salted digest groups, then the salt winners.

Texts are equal when identical; a null text counts as empty. Of equal texts the row with the largest id stays (null ids
come before all others; of rows that share that id, one). A copy's group is compared on its whole text at every stage: the digest only
decides where rows meet, so two texts with one digest stay two groups. Empty tables give empty results, further columns
are carried by `distinct_rows` and left out by `copy_groups`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.session import materialise

#: Salts per digest: a text that every map task holds meets in at most this many rows in the last stage.
SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def distinct_rows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One whole row per distinct text, that of the largest id, with all columns of `docs` as they are."""
    rest = [c for c in docs.columns if c not in (text, doc_id)]
    # the id leads the struct, so its maximum is the row of the largest id; other columns settle repeated ids
    row = F.struct(F.col(doc_id).alias("_id"), F.col(text).isNotNull().alias("_given"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(rest)])
    base = docs.select(F.coalesce(text, F.lit("")).alias("_text"), row.alias("_row")).withColumn("_digest", digest(F.col("_text")))
    merged = _merge(base, [F.max("_row").alias("_row")], [F.max("_row").alias("_row")], salts)
    back = {doc_id: F.col("_row._id"), text: F.when(F.col("_row._given"), F.col("_text")), **{c: F.col(f"_row._{i}") for i, c in enumerate(rest)}}
    return merged.select(*[back[c].alias(c) for c in docs.columns])


def copy_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per row of `docs`: its id, the id that stays (`keep_id`), `group_size`, `kept`, and `text_sha256`."""
    base = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text")).withColumn("_digest", digest(F.col("_text")))
    groups = _merge(base, [F.max("_id").alias("keep_id"), F.count("*").alias("group_size")], [F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")], salts)
    groups = groups.withColumn("text_sha256", F.lower(F.hex(sha256(F.col("_text")))))
    rows = base.groupBy("_digest", "_id", F.when(F.lit(digest is not sha256), F.col("_text")).alias("_text")).agg(F.count("*").alias("_repeats"))
    if digest is sha256:
        # A digest with one text needs no text to find its rows again. The written table stands next to the join as it is,
        # so that Spark can split the rows of a hot group there.
        per_digest = groups.groupBy("_digest").agg(F.count("*").alias("_texts"), *[F.first(c).alias(c) for c in ("keep_id", "group_size", "text_sha256")])
        found = rows.drop("_text").join(materialise(per_digest, "copy-groups"), "_digest")
        found = found.where(F.when(F.col("_texts") == 1, True).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest"))))
    else:
        found = rows.join(groups, ["_digest", "_text"])
    found = found.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), "_repeats")))
    kept = F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)
    return found.select(F.col("_id").alias(doc_id), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _merge(base: DataFrame, first: list[Column], then: list[Column], salts: int) -> DataFrame:
    """Groups of (digest, whole text): combined per task, per salt, and over the salts."""
    # the salt is the task's number: rows of a task keep one salt, so they combine before they are sent
    salted = base.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("_digest", "_salt", "_text").agg(*first)
    return winners.groupBy("_digest", "_text").agg(*then)
