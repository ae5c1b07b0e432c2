"""The corpus pipeline over `documents`: quality rules, exact and near duplicates, mixing, sentence pieces.

Every stage takes (spark, docs, sf_dir). What it returns is written as Parquet and read again for the next one. All but
the last return rows of `documents` as they are; the mix repeats rows, and the last stage gives `doc_id`, `ids`,
`n_tokens` and `restored` per row of the mix. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivermill.llm import exact, mixing, neardup, pieces, rules
from rivermill.llm.queries import PIECE_MODEL
from rivermill.llm.shared import word_count
from rivermill.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.filter_quality(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.distinct_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(spark, docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.expand(mixing.mix(docs, size=word_count))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(spark, docs, PIECE_MODEL)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_duplicates),
    ("minhash_near_dedup", near_duplicates),
    ("source_mixing", source_mix),
    ("sentencepiece", sentence_pieces),
]

#: Sampled similarities and piece models are no SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
