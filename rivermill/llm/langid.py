"""Language identification by compression: the language whose text helps most to compress a document is its language.

A language's model is a zstandard raw-content dictionary: sample texts one after the other. Labelled texts
are cut into pieces of at most `SAMPLE_TEXT_BYTES`; the sample of a language are its distinct pieces in the order of their hash,
as many as fit into `DICTIONARY_BYTES`. Texts are reduced to their letters in lower case first. A document is compressed with every dictionary in blocks of `BLOCK_BYTES`, all of it, so the
dictionary counts in a long text as much as in a short one; the smallest sum wins. A margin below `MARGIN` is
narrow: `rejected` says so, and the best guess is given all the same. Equal sizes go to the language that comes first
by code point. A null text, or one without a letter, is `und` with score 0, and so is any text if nothing was learned.
Rows are taken as they come, repeated ones alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.session import materialise

UNKNOWN = "und"
SAMPLE_TEXT_BYTES, DICTIONARY_BYTES = 8 << 10, 64 << 10
#: What is read for a dictionary, as a multiple of its bytes, so that it fills up whatever the share of letters.
SPARE = 8
BLOCK_BYTES, LEVEL, MARGIN = 4 << 10, 6, 0.01
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The text's letters in lower case, with one space for each run of anything else."""
    return _OTHER.sub(" ", text or "").strip().lower()


def learn(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """Dictionary per language from the rows where `usable`. The bounds above bound what comes to the driver per language."""
    known = docs.where(usable & F.col(lang).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"))
    span = SAMPLE_TEXT_BYTES // 4  # characters of four bytes at most
    starts = F.sequence(F.lit(1), F.greatest(F.length("t"), F.lit(1)), F.lit(span))
    cut = F.when(F.octet_length("t") <= SAMPLE_TEXT_BYTES, F.array("t")).otherwise(F.transform(starts, lambda k: F.substring("t", k, F.lit(span))))
    pieces = known.select("l", F.explode(cut).alias("t")).withColumn("h", F.xxhash64("t"))
    size = F.octet_length(F.regexp_replace("t", r"[^\p{L}]+", " ")).cast("long")
    keys = materialise(pieces.where(F.col("t").rlike(r"\p{L}")).groupBy("l", "h").agg(F.max(size).alias("size")), "langid-pieces")
    share = SPARE * DICTIONARY_BYTES * (1 << 30) / F.col("total")
    chosen = keys.join(keys.groupBy("l").agg(F.sum("size").alias("total")), "l").where(F.pmod("h", F.lit(1 << 30)) < share).select("l", "h")
    found = pieces.join(F.broadcast(chosen), ["l", "h"]).groupBy("l", "h").agg(F.min("t").alias("t"))
    held: dict[str, list[bytes]] = {}
    for row in sorted(found.select("l", "h", "t").collect()):
        raw = letters(row["t"]).encode()
        parts = held.setdefault(row["l"], [])
        if sum(map(len, parts)) + len(raw) + len(parts) <= DICTIONARY_BYTES:
            parts.append(raw)
    return {name: b"\n".join(parts) for name, parts in sorted(held.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        self.compressors = []
        for raw in dictionaries.values():
            data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score between 0 and 1, and whether the margin is too narrow to trust."""
        raw = letters(text).encode()
        if not raw or not self.names:
            return UNKNOWN, 0.0, True
        blocks = [raw[k : k + BLOCK_BYTES] for k in range(0, len(raw), BLOCK_BYTES)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), name) for c, name in zip(self.compressors, self.names))
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        margin = 1 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], margin, margin < MARGIN


def identify(spark: SparkSession, docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", doc_id: str = "doc_id", **carried: Column) -> DataFrame:
    """`doc_id`, the carried columns, `lang_pred`, `score` and `rejected` for every row of `docs`."""
    shipped = spark.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shipped.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [model.predict(texts[k].as_py()) for k in range(len(texts))]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names, "lang_pred", "score", "rejected"])

    source = docs.select(F.col(doc_id), *[c.alias(n) for n, c in carried.items()], F.col(text).alias("_text"))
    names = source.columns[:-1]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double", "rejected boolean"]))
