"""Registered queries of this package: every operator over its whole table, and the SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.llm import arc, chat, codes, cotrain, exact, langid, mixing, neardup, pieces, rules, shards, spelling, tokenfiles
from rivermill.llm.oracle import ORACLE
from rivermill.llm.shared import word_count
from rivermill.session import drop_path, fresh_path, materialise

SHARDS = 8
#: The model file of the sentence pieces, as the driver sees it.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The library's file of the token ids, and the id that ends a document.
WORD_MODEL, END_ID = public_tokenizers.path("word_bpe_49k.json"), 2
#: Rows with this remainder of crc32(doc_id as text) are never learned from.
FOLDS, HELD_OUT = 5, 0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    placed = shards.assign_shards(docs, "doc_id", SHARDS, size=size, text_crc32=crc)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    return langid.identify(spark, docs, langid.learn(docs, ~held_out), held_out=held_out)


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return chat.format_preferences(turns, chat.swapped_answers(turns))


def warc_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    key_header = "X-Page-Id"
    old, new = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    arc.write_arc(_table(spark, sf_dir, "pages"), old, "page_id", "url", "html", key_header)
    arc.write_warc(arc.to_warc(arc.read_arc(spark, old, key_header), F.col("record_key").cast("long")), new)
    drop_path(spark, old)
    back = materialise(arc.read_warc(spark, new, key_header).withColumn("page_id", F.col("record_key").cast("long")), "warc-index")
    held = back.where("record_type = 'response'").select(F.col("record_id").alias("_held"), F.col("page_id").alias("refers_to"))
    found = back.join(held, F.col("refers_to_id") == F.col("_held"), "left")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "intact")


def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(spark, _table(spark, sf_dir, "documents"), PIECE_MODEL)


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copy_groups(_table(spark, sf_dir, "documents"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), size=word_count)
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path, index = fresh_path(spark, "token-ids"), fresh_path(spark, "token-index")
    tokenfiles.write_ids(docs, path, WORD_MODEL, END_ID)
    tokenfiles.build_index(spark, path, index)
    back = tokenfiles.read_documents(spark, path, index, docs.select(F.col("doc_id").alias("key")))
    return back.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens", "ids_crc32")


QUERIES = {
    "op1_sharding": sharding,
    "op2_quality_classifier": quality_classifier,
    "op3_quality_rules": quality_rules,
    "op4_language_id": language_id,
    "op5_chat_formatting": chat_formatting,
    "op6_warc": warc_conversion,
    "op7_sentencepiece": sentence_pieces,
    "op8_minhash_near_dedup": minhash_near_dedup,
    "op9_exact_dedup": exact_dedup,
    "op10_mixing": source_mixing,
    "op11_vector_codes": vector_codes,
    "op12_spelling_variants": spelling_variants,
    "op13_token_files": token_files,
}
