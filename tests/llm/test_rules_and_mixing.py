import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rivermill.llm import mixing, rules
from rivermill.llm.shared import word_count, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    found = WORD.findall(text)
    grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often = Counter(grams)
    covered = {p for i, g in enumerate(grams) if often[g] > 1 for p in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    "a b c d e a b c d e a b c d e", "a b c d e f g h i j", "a b c d e x a b c d e", "x x x x x x x x x x x", "one line\none line\n \none line",
    "a|b <c> #d $e %f &g *h i j k l m", "THESE ARE ALL CAPITALS AND MORE OF THEM STILL HERE NOW", "b c\rd\x0be\x0cf\tg  h  i j k l m n",
    "the first of many lines of prose\nand the second one of them, which is longer\nand so on it goes",
]


def test_measures_equal_brute_force(docs, odd_rows):
    rows = odd_rows + list(enumerate(TEXTS, 50))
    got = rules.judge(docs(rows, clash=True)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((i, *measures(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_filter_agrees_with_judge_and_keeps_prose(docs):
    rows = list(enumerate(TEXTS))
    kept = {r.doc_id for r in rules.judge(docs(rows)).where("kept").collect()}
    out = rules.filter_quality(docs(rows, clash=True))
    assert {r.doc_id for r in out.collect()} == kept == {8} and out.columns == docs(rows, clash=True).columns


def test_cascade_order_is_rejection_per_cost():
    rule = rules.TOO_SHORT
    found = [rules.Measured(rule, 1.0, 0.5), rules.Measured(rule, 0.1, 0.2), rules.Measured(rule, 0.5, 0.0), rules.Measured(rule, 0.2, 0.0)]
    assert [m.cost for m in rules.order(found)] == [0.1, 1.0, 0.2, 0.5]


def test_a_rejected_text_meets_no_later_rule(docs):
    boom = rules.Rule("boom", ("n_words",), lambda n: F.raise_error(F.lit("reached")).cast("boolean"))
    df = docs([(1, "too short")])
    verdict = rules.passes([rules.TOO_SHORT.on_text(F.col("text")), boom.on_text(F.col("text"))])
    assert [r[0] for r in df.select(verdict).collect()] == [False]
    with pytest.raises(Exception, match="reached"):
        docs([(1, TEXTS[1])]).select(verdict).collect()


def test_judge_asks_no_later_rule_of_a_rejected_text(docs, monkeypatch):
    broken = rules.Rule("broken", ("n_lines",), lambda n: F.when(n > 1, F.raise_error(F.lit("asked"))).otherwise(False))
    first = rules.Rule("first", ("n_symbols",), lambda n: n > 3)
    monkeypatch.setattr(rules, "measure", lambda *a: [rules.Measured(r, 1.0, 0.5) for r in (rules.TOO_SHORT, rules.REPETITIVE, first, broken)])
    rows = [(1, "too\nshort"), (2, "same old words again " * 20 + "\nmore"), (3, "one two three four five six seven\neight nine ten eleven $$$$"), (4, "one two three four five six seven eight nine ten eleven")]
    assert {r.doc_id: r.kept for r in rules.judge(docs(rows)).collect()} == {1: False, 2: False, 3: False, 4: True}
    with pytest.raises(Exception, match="asked"):
        rules.judge(docs([(5, "one two three four five six\nseven eight nine ten eleven")])).collect()


def test_the_sample_does_not_depend_on_the_order_of_rows(docs, monkeypatch):
    rows = [(k, f"text number {k} " + "$ " * (k % 9)) for k in range(300)]
    shares = [sorted((m.rule.name, m.rejection) for m in rules.measure(docs(r).repartition(p), rules.RULES, rows=50)) for r, p in ((rows, 1), (rows[::-1], 5))]
    assert shares[0] == shares[1]


def test_no_documents(docs):
    assert rules.judge(docs([])).count() == 0 and rules.filter_quality(docs([])).count() == 0
    assert mixing.mix(docs([]), size=word_count).count() == 0


def test_words(docs, odd_rows):
    got = docs(odd_rows + [(k, t) for k, t in enumerate(TEXTS, 20)]).select("text", words(F.col("text")), word_count(F.col("text"))).collect()
    assert all(r[1] == WORD.findall(r[0] or "") and r[2] == len(r[1]) for r in got)


def water(sizes, weights, total, epochs):
    target, left = {}, dict(weights)
    while left:
        share = (total - sum(target.values())) / sum(left.values())
        full = [s for s in left if share * left[s] > epochs * sizes[s]]
        if not full:
            return target | {s: share * w for s, w in left.items()}
        for s in full:
            target[s] = epochs * sizes[s]
            del left[s]
    return target


def mix_by_hand(rows, total=1.5, epochs=2):
    sizes, by = defaultdict(int), defaultdict(list)
    for i, text, source in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        by[source].append((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i, n))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = water(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, total * sum(sizes.values()), epochs)
    out = []
    for s, items in by.items():
        whole, upto = (int(target[s] // sizes[s]) if sizes[s] else 0), 0
        for _, i, n in sorted(items, key=lambda x: x[0]):
            upto += n
            out.append((i, n, sizes[s], round(target[s], 6), n * (whole + (upto - n / 2 <= target[s] - whole * sizes[s]))))
    return Counter(out)


@pytest.mark.parametrize("sources", [["a"], ["b", "a", None, "c", "é", ""], ["x"] * 8 + ["y", None]])
def test_mix_equals_brute_force(docs, sources):
    rows = [(k, "w " * (k * 7 % 23) if k % 11 else None, sources[k % len(sources)]) for k in range(240)]
    df = docs([(i, t, None, s) for i, t, s in rows], clash=True)
    got = mixing.mix(df, size=word_count).select("row.doc_id", "size", "source_size", "target", "times").collect()
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r["size"] * r.times) for r in got) == mix_by_hand(rows)
    per = defaultdict(lambda: [0, 0.0, 0])
    for r, (_, _, s) in zip(sorted(got, key=lambda r: r.doc_id), rows):
        per[s] = [per[s][0] + r["size"] * r.times, r.target, max(per[s][2], r["size"])]
    assert all(abs(taken - target) <= largest / 2 + 1e-6 for taken, target, largest in per.values())


def test_repeated_rows_are_taken_alike_and_expand_repeats_whole_rows(docs, odd_rows):
    df = docs(odd_rows, clash=True)
    mixed = mixing.mix(df, size=word_count)
    taken = defaultdict(set)
    for r in mixed.collect():
        taken[r.row.doc_id, r.row.text].add(r.times)
    assert all(len(v) == 1 for v in taken.values()) and taken[1, None] == {0}
    out = mixing.expand(mixed)
    assert out.columns == df.columns and out.count() == sum(r.times for r in mixed.collect())
