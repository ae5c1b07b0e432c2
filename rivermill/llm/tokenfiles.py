"""Token ids as raw binary files, and a minimal perfect hash index that finds a document's ids by its key.

Files: documents lie in ascending order of their keys over numbered shards. A shard is the ids of its documents, each
followed by the end id, 2 or 4 bytes an id (as the vocabulary needs), little-endian; then its directory: keys (8 bytes
each), numbers of ids (8 bytes each), and a foot of 32 bytes. The text writer puts the bytes of the end id between rows,
so shards are written by Spark's own committed output, whatever store it is.

Index: keys fall into parts by their hash, about `KEYS_PER_PART` each. A part is a minimal perfect hash function over its
keys (levels of bits; a key is placed at the first level where it is alone) with a fingerprint, and the place of the key's
documents, per slot. Whole-number keys have fingerprints of their own, so an absent key is never found. A lookup reads one
part and one slot, whatever the number of keys.

Null texts are empty: the end id alone. Null keys come first in the order and are found as one key. Documents that share
a key follow each other, a run per shard, and are found together; they are ordered by a hash of their text. Texts of any
length are one document. Empty tables give no files and an empty result; further columns are ignored. Keys are whole
numbers.
"""

from __future__ import annotations

import gc
import json
import math
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from rivermill.session import materialise

#: Bytes of text per shard, and keys per part of the index.
SHARD_BYTES, KEYS_PER_PART = 16 << 20, 4096
#: Bytes of text encoded at once; words and characters that an encoder remembers, and the length of those it does not.
CHUNK_BYTES, HELD_WORDS, HELD_CHARS, LONG_WORD = 1 << 20, 5 << 17, 1 << 24, 64
#: Letters taken to the model itself, how it writes bytes, what a model that can be read word by word does to a text, and how it cuts it.
LATIN = frozenset(map(chr, range(0x100)))
#: Printable bytes stand for themselves, the others for what follows 0xFF, in order.
BYTES = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
STEPS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MAGIC, FOOT, FOOT_BYTES = b"RMTOKIDS", "<qqq8s", 32
#: Bits per key of a level: at 1.5 about half of the keys are alone.
ROOM = 1.5

_U = np.uint64


# -- encoding ------------------------------------------------------------------------------------------------------------


class Encoder:
    """The library's ids, with words encoded once.

    A model that lower-cases, drops white space and cuts texts by `PATTERN` never joins what stands on two sides of a blank,
    nor a letter and a full stop or comma. So a text's ids are those of its pieces between spaces and line ends, and those
    of `Word,` are those of `word` and `,`. Texts of any other model are encoded whole.
    """

    def __init__(self, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.model = Tokenizer.from_str(model)
        said = json.loads(model)
        steps = [s["type"] for s in (said.get("normalizer") or {}).get("normalizers", [])]
        cut = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_word = steps == STEPS and cut.get("pattern") == {"Regex": PATTERN} and cut.get("invert") is True
        self.codes: dict[str, int] = {}
        self.ids, self.starts, self.lengths, self.uses, self.chars = np.zeros(0, np.uint32), *(np.zeros(0, np.int64) for _ in range(3)), 0

    def forget(self) -> None:
        """Keeps the words that were used again since the last time."""
        kept = {w: c for w, c in self.codes.items() if self.uses[c] > 1 and len(w) < LONG_WORD}
        old, place = np.unique(np.fromiter(kept.values(), np.int64, len(kept)), return_inverse=True)
        ids, lengths = self.gather(old), self.lengths[old]
        self.codes = dict(zip(kept, place.tolist()))
        self.ids, self.starts, self.lengths, self.uses = ids, np.cumsum(lengths) - lengths, lengths, np.zeros(len(old), np.int64)
        self.chars = sum(map(len, kept))

    def gather(self, code: np.ndarray) -> np.ndarray:
        lengths = self.lengths[code]
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(self.starts[code] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.codes.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words))))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
        self.ids, self.lengths = np.append(self.ids, ids), np.append(self.lengths, lengths)
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))
        self.chars += sum(map(len, words))

    def learn(self, words: list[str]) -> None:
        plain, other = {}, [".", ","]
        for w in words:
            base = w[:-1] if w[-1:] in (".", ",") else w
            if base.isalpha() and (base.isascii() or LATIN.issuperset(base)):
                plain[w] = base.lower()
            else:
                other.append(w)
        bases, other = list(set(plain.values()).difference(self.codes)), list(set(other).difference(self.codes))
        # of lower-case Latin letters, written as the model writes their bytes, the model itself gives what the whole way gives
        tokenize, ids, lengths, collects = self.model.model.tokenize, [], [], gc.isenabled()
        gc.disable()  # many small lists at once, none of them in a cycle
        try:
            for w in bases:
                found = tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(BYTES))
                lengths.append(len(found))
                ids.extend([t.id for t in found])
        finally:
            if collects:
                gc.enable()
        self.add(bases, np.array(ids, np.uint32), np.array(lengths, np.int64))
        if other:
            found = self.model.encode(other, is_pretokenized=True, add_special_tokens=False)
            self.add(other, np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(other)))
        codes = self.codes
        codes.update([(w, codes[base]) for w, base in plain.items() if len(w) == len(base)])
        if marked := [w for w, base in plain.items() if len(w) > len(base)]:
            both = np.array([(codes[plain[w]], codes[w[-1]]) for w in marked])
            self.add(marked, self.gather(both.ravel()), self.lengths[both].sum(axis=1))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many are each text's."""
        if not self.by_word:
            found = [e.ids for e in self.model.encode_batch(texts, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        if len(self.codes) > HELD_WORDS or self.chars > HELD_CHARS:
            self.forget()
        split = [t.replace("\n", " ").split(" ") for t in texts]
        words = list(chain.from_iterable(split))
        code = np.fromiter(map(self.codes.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(code < 0)
        if len(unknown):
            self.learn(list({words[k]: None for k in unknown}))
            code[unknown] = [self.codes[words[k]] for k in unknown]
        self.uses += np.bincount(code, minlength=len(self.uses))
        first = np.cumsum([0, *map(len, split[:-1])])
        return self.gather(code), np.add.reduceat(self.lengths[code], first)


@lru_cache(maxsize=1)
def encoder_of(model: str) -> Encoder:
    """A worker's encoder, kept from task to task."""
    return Encoder(model)


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about CHUNK_BYTES; a longer text is a run of its own."""
    begin, held, size = 0, [], 0
    for k in range(len(texts)):
        own = len(texts[k].as_buffer())
        if held and size + own > CHUNK_BYTES:
            yield begin, held
            begin, held, size = k, [], 0
        held.append(texts[k].as_py())
        size += own
    if held:
        yield begin, held


# -- files ---------------------------------------------------------------------------------------------------------------


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> None:
    """Shards of the ids of `docs` below `path`. `tokenizer`: path of the library's file on the driver."""
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    width = 2 if max(Tokenizer.from_str(model).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    keyed = docs.select(F.col(doc_id).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text")).withColumn("among", F.xxhash64("text"))
    size = keyed.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ordered = keyed.repartitionByRange(max(1, math.ceil(size / shard_bytes)), "key", "among").sortWithinPartitions("key", "among").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, keys, missing, counts = encoder_of(shipped.value), [], 0, []
        for batch in batches:
            missing += batch.column(0).null_count
            keys.append(batch.column(0).fill_null(0).to_numpy())
            for _, texts in _runs(batch.column(1)):
                ids, n = own.encode(texts)
                counts.append(n)
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]) * width, pa.int64())
                data = pa.py_buffer(ids.astype(f"<u{width}").tobytes())
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.large_binary(), len(n), [None, ends.buffers()[1], data]).cast(pa.binary())], ["record"])
        if counts:
            lengths = np.concatenate(counts) + 1
            foot = struct.pack(FOOT, len(lengths), missing, int(lengths.sum()), MAGIC)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(keys).astype("<i8").tobytes() + lengths.astype("<i8").tobytes() + foot], pa.binary())], ["record"])

    records = ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    between = int(end_id).to_bytes(width, "little").decode("latin-1")
    records.write.mode("overwrite").options(lineSep=between, encoding="ISO-8859-1", compression="none", maxRecordsPerFile=0).text(path)


def _shard(content: memoryview) -> tuple[np.ndarray, np.ndarray, int, memoryview, int]:
    """Keys, numbers of ids, how many keys are null, the ids' bytes, and the width of an id."""
    for width in (2, 4):  # what follows the foot is one end id
        n, missing, ids, magic = struct.unpack(FOOT, content[len(content) - width - FOOT_BYTES : len(content) - width])
        if magic == MAGIC:
            break
    else:
        raise ValueError("not a shard of token ids, or one that was cut off")
    at = ids * width
    if at + 16 * n + FOOT_BYTES + width != len(content):
        raise ValueError("a shard of token ids has another length than its foot says")
    keys, lengths = np.frombuffer(content, "<i8", n, at), np.frombuffer(content, "<i8", n, at + 8 * n)
    return keys, lengths, missing, content[:at], width


def _shards(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")


def _heads(keys: np.ndarray, lengths: np.ndarray, missing: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each document's ids begin, and where those of the first document with its key do."""
    begin = np.cumsum(lengths) - lengths
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    new[1:missing] = False
    if 0 < missing < len(keys):
        new[missing] = True
    return begin, begin[np.flatnonzero(new)][np.cumsum(new) - 1]


def documents(spark: SparkSession, path: str) -> DataFrame:
    """What the shards hold, one row per document: `shard`, `head` (place of its key), `start` (ids of all documents before it), `n_tokens`, `ids_crc32`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, lengths, missing, data, width = _shard(memoryview(content.as_buffer()))
                begin, head = _heads(keys, lengths, missing)
                ids = np.frombuffer(data, f"<u{width}")
                crc = [zlib.crc32(ids[a : a + n].astype("<u4")) for a, n in zip(begin, lengths)]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(keys), pa.int32()), pa.array(head), pa.array(begin), pa.array(lengths), pa.array(crc, pa.int64())], ["shard", "head", "start", "n_tokens", "ids_crc32"])

    held = materialise(_shards(spark, path).mapInArrow(run, "shard int, head long, start long, n_tokens long, ids_crc32 long"), "token-documents")
    totals = held.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    offsets = totals.select(F.col("shard").alias("of"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return held.join(offsets, F.col("shard") == F.col("of")).select("shard", "head", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def directory(spark: SparkSession, path: str) -> DataFrame:
    """Runs of documents of one key within a shard: `key`, `shard`, `head`, `n_docs`, `n_ids`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, lengths, missing, _, _ = _shard(memoryview(content.as_buffer()))
                _, head = _heads(keys, lengths, missing)
                at, first, docs = np.unique(head, return_index=True, return_counts=True)
                named = pa.array(keys[first], pa.int64(), mask=np.arange(len(at)) < min(missing, 1))
                yield pa.RecordBatch.from_arrays([named, pa.array([shard] * len(at), pa.int32()), pa.array(at), pa.array(docs, pa.int64()), pa.array(np.add.reduceat(lengths, first))], ["key", "shard", "head", "n_docs", "n_ids"])

    return _shards(spark, path).mapInArrow(run, "key long, shard int, head long, n_docs long, n_ids long")


# -- minimal perfect hashing ---------------------------------------------------------------------------------------------


def _hashed(prints: np.ndarray, level: int) -> np.ndarray:
    h = prints + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """One to one on 64-bit keys."""
    h = keys.astype(np.int64).view(_U)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def build(prints: np.ndarray) -> list[np.ndarray]:
    """Bits by level for distinct fingerprints: the bit of a key is set at the first level where it is alone on it."""
    levels, left = [], prints
    while len(left):
        at = (_hashed(left, len(levels)) % _U(max(64, math.ceil(len(left) * ROOM)))).astype(np.int64)
        hits = np.bincount(at, minlength=max(64, math.ceil(len(left) * ROOM)))
        levels.append(hits == 1)
        left = left[hits[at] != 1]
    return levels


def slots(levels: list[np.ndarray], prints: np.ndarray) -> np.ndarray:
    """Slot of every key, 0 and up without gaps; -1 for some that are none of the function's keys."""
    found, below, left = np.full(len(prints), -1, np.int64), 0, np.arange(len(prints))
    for level, bits in enumerate(levels):
        at = (_hashed(prints[left], level) % _U(len(bits))).astype(np.int64)
        hit = bits[at]
        found[left[hit]] = below + (np.cumsum(bits) - 1)[at[hit]]
        below, left = below + int(bits.sum()), left[~hit]
    return found


def pack(keys: np.ndarray, shard: np.ndarray, head: np.ndarray, n_docs: np.ndarray, n_ids: np.ndarray) -> bytes:
    """One part of the index: number of keys and runs, the levels' bits, fingerprints by slot, then the runs by slot."""
    prints = fingerprints(keys)
    distinct = np.unique(prints)
    levels = build(distinct)
    by_slot = np.empty(len(distinct), _U)
    by_slot[slots(levels, distinct)] = distinct
    own = slots(levels, prints)
    order = np.lexsort((head, shard, own))
    first = np.searchsorted(own[order], np.arange(len(distinct) + 1))
    bits = [np.packbits(b, bitorder="little").tobytes() for b in levels]
    parts = [struct.pack("<qqq", len(distinct), len(keys), len(levels)), np.array([len(b) for b in levels], "<i8").tobytes(), *bits]
    parts += [by_slot.astype("<u8").tobytes(), first.astype("<i8").tobytes(), *(c[order].astype("<i8").tobytes() for c in (shard, head, n_docs, n_ids))]
    return b"".join(parts)


def find(blob: bytes, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of `keys` that the part holds, one per run, and the runs' `shard`, `head`, `n_docs`, `n_ids`."""
    n, m, deep = struct.unpack_from("<qqq", blob)
    sizes, at, levels = np.frombuffer(blob, "<i8", deep, 24), 24 + 8 * deep, []
    for size in sizes:
        levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, -(-int(size) // 8), at), count=int(size), bitorder="little").astype(bool))
        at += -(-int(size) // 8)
    by_slot, first = np.frombuffer(blob, "<u8", n, at), np.frombuffer(blob, "<i8", n + 1, at + 8 * n)
    at += 8 * (2 * n + 1)
    columns = [np.frombuffer(blob, "<i8", m, at + 8 * m * k) for k in range(4)]
    prints = fingerprints(keys)
    slot = slots(levels, prints)
    rows = np.flatnonzero((slot >= 0) & (by_slot[slot] == prints)) if n else np.zeros(0, np.int64)
    runs = first[slot[rows] + 1] - first[slot[rows]]
    each = np.repeat(first[slot[rows]] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    return np.repeat(rows, runs), [c[each] for c in columns]


def _part(key: Column, parts: int | Column) -> Column:
    """Null keys have a part of their own."""
    return F.when(key.isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(parts) if isinstance(parts, int) else parts)).cast("int")


def build_index(spark: SparkSession, path: str, index: str, keys_per_part: int = KEYS_PER_PART) -> None:
    """Index of the shards below `path`, one row per part: `part`, `parts` (how many there are) and `packed`."""
    runs = directory(spark, path)
    parts = max(1, math.ceil(runs.count() / keys_per_part))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        columns = [frame[c].to_numpy() for c in ("shard", "head", "n_docs", "n_ids")]
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "parts": [parts], "packed": [pack(frame["key"].to_numpy(np.int64), *columns)]})

    keyed = runs.withColumn("part", _part(F.col("key"), parts)).withColumn("key", F.coalesce("key", F.lit(0).cast("long")))
    keyed.groupBy("part").applyInPandas(packed, "part int, parts int, packed binary").write.mode("overwrite").parquet(index)


def lookup(spark: SparkSession, index: str, keys: DataFrame) -> DataFrame:
    """`key`, `shard`, `head`, `n_docs` and `n_ids`: a row per run of the distinct `key`s of `keys` that are stored."""
    stored = spark.read.schema("part int, parts int, packed binary").parquet(index)
    some = stored.select("parts").first()

    def found(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names = ["key", "shard", "head", "n_docs", "n_ids"]
        if not len(held) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="Int64") for c in names})
        rows, columns = find(held["packed"].iloc[0], asked["at"].to_numpy(np.int64))
        key = asked["at"].astype("Int64").mask(asked["part"] < 0).iloc[rows].reset_index(drop=True)
        return pd.DataFrame(dict(zip(names, [key, *columns])))

    asked = keys.select(F.col("key").cast("long").alias("key")).distinct()
    asked = asked.select(F.coalesce("key", F.lit(0).cast("long")).alias("at"), _part(F.col("key"), some[0] if some else 1).alias("part"))
    both = asked.groupBy("part").cogroup(stored.groupBy("part"))
    return both.applyInPandas(found, "key long, shard int, head long, n_docs long, n_ids long")


def read_documents(spark: SparkSession, path: str, index: str, keys: DataFrame) -> DataFrame:
    """`key`, `start`, `n_tokens`, `ids_crc32`: every stored document of `keys`, found through the index."""
    places = lookup(spark, index, keys).select("key", F.col("shard").alias("in"), F.col("head").alias("at"))
    return documents(spark, path).join(places, (F.col("shard") == F.col("in")) & (F.col("head") == F.col("at"))).select("key", "start", "n_tokens", "ids_crc32")
