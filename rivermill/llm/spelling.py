"""Spelling variants: a pair dictionary of trie nodes finds all words that differ by one code point.

Every prefix of a word is a node of the forward trie, every suffix one of the reversed trie; both are numbered. Leaving
out position i gives the pair (prefix node i, suffix node i + 1), standing between positions the pair (prefix node i,
suffix node i). Two words of a length share a pair of the first kind exactly when they differ in that one position. A
shorter word's pair of the second kind equals a longer word's pair of the first exactly when the longer one has one code
point more there; of a run of equal code points only the first counts, so every near pair meets once. Words meet in one
aggregate over the pairs; a group holds at most one word per letter and one shorter word, so the alphabet bounds it.

A node's number is a seeded fingerprint of its parent's number and its code point. An aggregate over all nodes proves
that no number stands for two (parent, code point) pairs; from the root on, equal numbers are then equal nodes, and
results are exact. If one does, the next seed is tried.

Null and empty texts have no words, a null id counts as an empty one, repeated rows count again. Words may be of any
length. An empty table gives an empty result, further columns are ignored. Ties between near words of equal count go to
the first in the order of code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.session import materialise

#: Fixed values of the task: letters of a word, the share of damaged ones, the least length and count, the lead of a form.
LETTERS, DAMAGED, LEAST_LENGTH, LEAST_COUNT, LEAD = "[A-Za-zÀ-ÿ]+", 97, 5, 3, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points of words handled, and rows handed over, at once.
CHUNK, SLICE = 1 << 16, 1 << 16

_U = np.uint64


def runs(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LETTERS), F.lit(0))


def damaged(doc_id: Column, run: Column) -> Column:
    """The run without one code point where the checksum of id and run says so."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % DAMAGED == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`word` and `n`, its occurrences over all documents."""
    found = docs.select(F.col(doc_id).alias("id"), F.explode(runs(F.col(text))).alias("run")).where(F.char_length("run") >= LEAST_LENGTH)
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    word = found.select("id", low.alias("run")).select(damaged(F.col("id"), F.col("run")).alias("word"))
    counts = word.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


# -- numbers of the trie nodes -------------------------------------------------------------------------------------------


def fingerprint(parent: np.ndarray, letter: np.ndarray, seed: int) -> np.ndarray:
    h = parent + (letter.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15) + _U(seed * 0xD6E8FEB86659FD93 % (1 << 64))
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def numbered(words: list[str], seed: int, number=fingerprint) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, where each word's begin, and the numbers of its prefixes and suffixes.

    A word of n code points has n + 1 of either, so those of word w begin w places later than its code points.
    """
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    ahead, back = (np.zeros(len(letters) + len(words), _U) for _ in range(2))
    order = np.argsort(-lengths, kind="stable")
    starts, ends = bounds[:-1][order], bounds[1:][order]
    longer = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")  # words of more than i code points
    for i, n in enumerate(longer):
        a, z = starts[:n] + i, ends[:n] - 1 - i
        ahead[a + order[:n] + 1] = number(ahead[a + order[:n]], letters[a], seed)
        back[z + order[:n]] = number(back[z + order[:n] + 1], letters[z], seed)
    return letters, bounds, ahead, back


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    words = batch.column(0).to_pylist()
    begin, size = 0, 0
    for k, w in enumerate(words):
        if size and size + len(w) > CHUNK:
            yield begin, words[begin:k]
            begin, size = k, 0
        size += len(w)
    if words:
        yield begin, words[begin:]


def _sliced(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for at in range(0, n, SLICE):
        yield pa.RecordBatch.from_pydict({k: pa.array(v[at : at + SLICE]) for k, v in columns.items()})


def ambiguous(words: DataFrame, seed: int, number=fingerprint) -> bool:
    """Whether a number stands for two nodes of one trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, held in _chunks(batch):
                letters, bounds, ahead, back = numbered(held, seed, number)
                at = np.arange(len(letters)) + np.repeat(np.arange(len(held)), np.diff(bounds))
                node, parent = np.concatenate([ahead[at + 1], back[at]]), np.concatenate([ahead[at], back[at + 1]])
                side = np.repeat([False, True], len(letters))
                yield from _sliced({"node": node.view(np.int64), "parent": parent.view(np.int64), "letter": np.tile(letters, 2).astype(np.int32), "side": side})

    nodes = words.select("word").mapInArrow(run, "node long, parent long, letter int, side boolean")
    # a trie's root is number 0; no node may take it
    seen = nodes.groupBy("side", "node").agg(F.min("parent").alias("p"), F.max("parent").alias("q"), F.min("letter").alias("l"), F.max("letter").alias("m"))
    return not seen.where("p <> q OR l <> m OR node = 0").isEmpty()


SKIPPED_LATER, SKIPPED, BETWEEN = 1, 2, 0


def pair_rows(words: DataFrame, seed: int, number=fingerprint) -> DataFrame:
    """Pairs of nodes: `p`, `s`, the word's `num` and `n`, and `kind`: BETWEEN two code points, or one SKIPPED (LATER: not the first of its run)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nums, ns = (batch.column(c).to_numpy() for c in (1, 2))
            for begin, held in _chunks(batch):
                letters, bounds, ahead, back = numbered(held, seed, number)
                owner = np.repeat(np.arange(len(held)), np.diff(bounds))
                at = np.arange(len(letters)) + owner
                repeat = np.zeros(len(letters), bool)
                repeat[1:] = (letters[1:] == letters[:-1]) & (owner[1:] == owner[:-1])
                every = np.repeat(np.arange(len(held)), np.diff(bounds) + 1)
                word = begin + np.concatenate([owner, every])
                kind = np.concatenate([np.where(repeat, SKIPPED_LATER, SKIPPED), np.full(len(every), BETWEEN)]).astype(np.int32)
                p, s = np.concatenate([ahead[at], ahead]), np.concatenate([back[at + 1], back])
                yield from _sliced({"p": p.view(np.int64), "s": s.view(np.int64), "num": nums[word], "n": ns[word], "kind": kind})

    return words.select("word", "num", "n").mapInArrow(run, "p long, s long, num long, n long, kind int")


# -- near words ----------------------------------------------------------------------------------------------------------


def near_words(words: DataFrame, seed: int, number=fingerprint) -> DataFrame:
    """Per word that has any: `num`, `n_near`, and its near word of largest count, `form_n` and `form_num`."""
    member = F.struct((-F.col("n")).alias("less"), "num", "kind")
    groups = pair_rows(words, seed, number).groupBy("p", "s").agg(F.collect_list(member).alias("all")).where(F.size("all") > 1)
    each = groups.select("all", F.explode("all").alias("own"))
    own = F.col("own.kind")

    def near(x: Column) -> Column:
        replaced = (own != BETWEEN) & (x["kind"] != BETWEEN)
        inserted = ((own == BETWEEN) & (x["kind"] == SKIPPED)) | ((own == SKIPPED) & (x["kind"] == BETWEEN))
        return (x["num"] != F.col("own.num")) & (replaced | inserted)

    met = each.select(F.col("own.num").alias("num"), F.filter("all", near).alias("near")).where(F.size("near") > 0)
    best = F.array_min("near")
    some = met.select("num", F.size("near").alias("some"), F.struct(best["less"].alias("less"), best["num"].alias("num")).alias("best"))
    total = some.groupBy("num").agg(F.sum("some").cast("long").alias("n_near"), F.min("best").alias("best"))
    return total.select("num", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.num").alias("form_num"))


def roots(forms: DataFrame) -> DataFrame:
    """`num` and the last word (`root`) that its forms lead to. A form's count is at least LEAD times the word's, so the way ends; each round doubles the step."""
    links = materialise(forms.select("num", F.col("form_num").alias("root")), "spelling-links")
    while True:
        onward = links.select(F.col("num").alias("via"), F.col("root").alias("onward"))
        stepped = materialise(links.join(onward, F.col("root") == F.col("via"), "left").select("num", F.coalesce("onward", "root").alias("root"), F.col("via").isNotNull().alias("moved")), "spelling-links")
        links = stepped.select("num", "root")
        if stepped.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", number=fingerprint) -> DataFrame:
    """One row per word: `word`, its `form` and `root`, `n`, `n_near` and `form_n`."""
    counts = materialise(word_counts(docs, text, doc_id), "spelling-counts")
    # numbers ascend with the words, so the smaller number is the first in the order of code points
    words = materialise(counts.orderBy("word").withColumn("num", F.monotonically_increasing_id()), "spelling-words")
    seed = 0
    while ambiguous(words, seed, number):
        seed += 1
    near = materialise(near_words(words, seed, number), "spelling-near")
    leads = F.col("form_n") >= LEAD * F.col("n")
    rated = words.join(near, "num", "left").select("word", "num", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(leads, F.col("form_num")).alias("form_num"), F.when(leads, F.col("form_n")).alias("form_n"))
    rated = materialise(rated, "spelling-rated")
    ends = roots(rated.where("form_num IS NOT NULL"))
    name = lambda c: words.select(F.col("num").alias(f"{c}_of"), F.col("word").alias(c))
    out = rated.join(ends, "num", "left").join(name("form"), F.col("form_num") == F.col("form_of"), "left").join(name("end"), F.col("root") == F.col("end_of"), "left")
    return out.select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
