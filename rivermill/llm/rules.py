"""Quality rules as a short-circuit cascade in the order of rejections per cost.

A rule is a column that is true where the text is to be rejected. Cost and selectivity of every rule are measured on a
sample of rows; then the rules run in the order of rejection per cost, and a text that one rejects meets no later one.
The order decides how fast a verdict comes, never which. A null or empty text has no words and is rejected as too
short; a table without rows keeps nothing. Texts are judged whole, whatever their length; repeated rows are judged each;
further columns are carried by `filter_quality` and left out by `judge`. All is built of DataFrame functions.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.llm.shared import WORD, let, words

#: Words of the windows in which repeats are looked for.
SPAN = 5
#: Rows on which costs and selectivities are measured.
SAMPLE_ROWS = 1000
#: Times that a rule is timed, and how many times larger than asked for a sample may come out.
RUNS, REPEATS = 3, 4

# The symbols counted.
SYMBOLS = "#*$%&|<>"


def chars_of(found: Column) -> Column:
    return F.aggregate(found, F.lit(0).cast("long"), lambda total, word: total + F.length(word))


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(_given(text), f"[^{SYMBOLS}]+", "")).cast("long")


def n_capitals(text: Column) -> Column:
    return F.length(F.regexp_replace(_given(text), r"\P{Lu}+", "")).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(_given(text), "\n"), lambda line: line.rlike(WORD))


def n_lines(text: Column) -> Column:
    return F.size(worded_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(worded_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeats_in(found: Column) -> Column:
    """Words within windows of five that occur twice or more among `found`, the first occurrence included.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. Where all differ, which one pass finds out, nothing else is done. Else
    they are sorted by hash, those with an equal neighbour are kept, and the words that their places cover are counted.
    """

    def covered(places: Column) -> Column:  # ascending; a window reaches five words on or up to the next window
        gaps = F.transform(places, lambda p, i: F.least(F.lit(SPAN), F.coalesce(F.get(places, i + 1) - p, F.lit(SPAN))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def twins(placed: Column) -> Column:
        near = lambda x, k: F.coalesce(F.get(placed, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(placed, lambda x, k: near(x, k - 1) | near(x, k + 1)), lambda x: x["i"]))

    def repeated(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(let(placed, twins), covered)

    def unlike(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(repeated(windows))

    def spans(hashes: Column) -> Column:
        whole = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, SPAN)]))
        return F.slice(whole, F.lit(1), F.size(hashes) - (SPAN - 1))

    return F.when(F.size(found) <= SPAN, F.lit(0)).otherwise(
        let(F.transform(found, lambda word: F.xxhash64(word)), lambda hashes: let(spans(hashes), unlike))
    ).cast("long")


def _given(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


@dataclass(frozen=True)
class Rule:
    """`rejects`: from the measures it names, in that order, to a boolean column, never null."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[..., Column]

    def on_text(self, text: Column) -> Column:
        """The rule by itself, with its measures taken from the text."""
        return let(words(text), lambda found: self.on_words(text, found)) if set(self.measures) & set(OF_WORDS) else self.on_words(text, None)

    def on_words(self, text: Column, found: Column | None) -> Column:
        return self.rejects(*[OF_WORDS[m](found) if m in OF_WORDS else OF_TEXT[m](text) for m in self.measures])

    def on_measures(self) -> Column:
        return self.rejects(*[F.col(m) for m in self.measures])


OF_WORDS = {"n_words": lambda found: F.size(found).cast("long"), "word_chars": chars_of, "n_repeat_words": repeats_in}
OF_TEXT = {"n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_lines": n_lines, "n_capitals": n_capitals}

#: The measures that `judge` returns.
SHOWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

TOO_SHORT = Rule("too_short", ("n_words",), lambda n: n < 10)
REPETITIVE = Rule("repetitive", ("n_repeat_words", "n_words"), lambda repeats, n: 100 * repeats > 20 * n)
#: The bounds leave room above what prose shows; each rule alone tells one kind of junk.
RULES = (
    TOO_SHORT,
    REPETITIVE,
    Rule("symbols", ("n_symbols", "n_words"), lambda symbols, n: 10 * symbols > n),
    Rule("word_length", ("word_chars", "n_words"), lambda chars, n: (chars < 2 * n) | (chars > 12 * n)),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda dup, n: 100 * dup > 40 * n),
    Rule("capitals", ("n_capitals", "word_chars"), lambda capitals, chars: 100 * capitals > 40 * chars),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    cost: float
    rejection: float


def measure(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Cost and rejected share of every rule on a sample of rows, the best rule first.

    The sample is chosen by a hash of the whole row, the same whatever the order and the partitions of the rows, and about
    `rows` large (`REPEATS` times that if rows repeat). It is held in the executors' storage while it is timed; a lost part
    is read again. The cost is the shortest of `RUNS` times, to the
    nearest power of two, so that small differences between runs do not change the order.
    """
    share = min(1.0, rows / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(1 << 31)) < F.lit(int(share * (1 << 31)))
    sample = docs.where(chosen).select(F.col(text).alias("t")).limit(REPEATS * rows).cache()
    try:
        n = sample.count()

        def timed(column: Column) -> tuple[float, int]:
            start = time.perf_counter()
            hits = sample.agg(F.sum(column.cast("int"))).first()[0]
            return time.perf_counter() - start, hits or 0

        timed(F.length("t") < 0)  # compiles what all share
        idle = min(timed(F.length("t") < 0)[0] for _ in range(RUNS))
        found = []
        for rule in rules:
            seconds, hits = zip(*[timed(rule.on_text(F.col("t"))) for _ in range(RUNS)])
            cost = 2.0 ** round(math.log2(max(min(seconds) - idle, 1e-3)))
            found.append(Measured(rule, cost, hits[0] / n if n else 0.0))
    finally:
        sample.unpersist()
    return order(found)


def order(found: list[Measured]) -> list[Measured]:
    """By rejection per cost, the highest first; equal ones by cost, then by name."""
    return sorted(found, key=lambda m: (-m.rejection / m.cost, m.cost, m.rule.name))


def passes(rejections: list[Column]) -> Column:
    """True where none holds; a branch of CASE is evaluated only where all before it were false."""
    verdict = F.when(F.lit(False), F.lit(False))
    for rejection in rejections:
        verdict = verdict.when(rejection, F.lit(False))
    return verdict.otherwise(F.lit(True))


def filter_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, unchanged."""
    ordered = [m.rule for m in measure(docs, rules, text)]
    return docs.where(let(words(F.col(text)), lambda found: passes([r.on_words(F.col(text), found) for r in ordered])))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The measures of every row, `base_failed`, and `kept`; the cascade runs on what the base rules leave."""
    ordered = [m.rule for m in measure(docs, rules, text) if m.rule not in (TOO_SHORT, REPETITIVE)]
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), words(F.col(text)).alias("words"))
    shown = {m: f(F.col("words")) for m, f in OF_WORDS.items()} | {m: f(F.col("text")) for m, f in OF_TEXT.items() if m in SHOWN}
    measured = rows.select("id", "text", *[c.alias(m) for m, c in shown.items()])
    failed = TOO_SHORT.on_measures() | REPETITIVE.on_measures()
    # measures that no column shows stand inside CASE, behind all rules that come before theirs
    late = lambda r: r.rejects(*[F.col(m) if m in shown else OF_TEXT[m](F.col("text")) for m in r.measures])
    kept = F.when(failed, False).otherwise(passes([late(r) for r in ordered]))
    return measured.select(F.col("id").alias(doc_id), *SHOWN, failed.alias("base_failed"), kept.alias("kept"))
