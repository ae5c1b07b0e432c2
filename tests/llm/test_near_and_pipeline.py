import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from rivermill.llm import neardup, queries
from test_rules_and_mixing import WORD, measures, mix_by_hand


def window_counts(text):
    found = WORD.findall(text or "")
    return Counter(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else Counter()


def classes_by_hand(rows, threshold=0.8):
    """Smallest id of the class of every text, from all pairs that share a window, with exact document frequencies."""
    sets = {t: window_counts(t) for t in {t or "" for _, t in rows}}
    n = len(rows)
    df = Counter(g for _, t in rows for g in sets[t or ""])
    weigh = lambda s: {g: c * (1 + 0.25 * math.log((n + 1) / (df[g] + 1)) / math.log(n + 1)) for g, c in s.items()}
    weights = {t: weigh(s) for t, s in sets.items()}
    holders = defaultdict(list)
    for t, s in sets.items():
        for g in s:
            holders[g].append(t)
    top = {t: t for t in sets}

    def root(t):
        while top[t] != t:
            t = top[t]
        return t

    for a, b in {(a, b) for ts in holders.values() for a in ts for b in ts if a < b}:
        x, y = weights[a], weights[b]
        both = sum(min(x[g], y[g]) for g in x.keys() & y.keys())
        if both / (sum(x.values()) + sum(y.values()) - both) >= threshold:
            top[root(a)] = root(b)
    least = {}
    for i, t in rows:
        least[root(t or "")] = min(i, least.get(root(t or ""), i))
    return {t: least[root(t)] for t in sets}


def families(seed, n=40):
    """Texts with near copies of one to three changed words, shared passages, and exact copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = [word() for _ in range(25)]
    out = []
    for _ in range(n):
        base = [word() for _ in range(rng.randint(60, 140))] + (passage if rng.random() < 0.5 else [])
        for copy in range(rng.randint(1, 4)):
            mine = list(base)
            for _ in range(copy):
                mine[rng.randrange(len(mine))] = word()
            out.append(" ".join(mine))
        if rng.random() < 0.3:
            out.append(" ".join(base))
    rng.shuffle(out)
    return list(enumerate(out, 10))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, docs, seed):
    rows = families(seed)
    want = classes_by_hand(rows)
    got = neardup.near_duplicates(spark, docs(rows, clash=True)).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: want[t] for i, t in rows}
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_one_large_group_of_near_copies(spark, docs):
    """Copies that are each near the original, but often not near each other, stay one class."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 300):
        mine = list(base)
        for at in rng.sample(range(len(mine)), 1 + k % 2):
            mine[at] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(mine)))
    rows += [(1000 + k, " ".join(f"y{k}_{j}" for j in range(100)) + " " + " ".join(base[:30])) for k in range(30)]
    want = classes_by_hand(rows)
    assert sum(c == 0 for c in want.values()) == 300
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark, docs(rows)).collect()}
    assert got == {i: want[t] for i, t in rows}


def test_odd_rows(spark, docs, odd_rows):
    got = neardup.near_duplicates(spark, docs(odd_rows, clash=True)).collect()
    want = {None: None, 1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 5, 9: 9}
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, want[i]) for i, _ in odd_rows)
    left = neardup.drop_near_duplicates(spark, docs(odd_rows, clash=True))
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 3, 4, 5, 7, 9, None]) and left.columns == docs(odd_rows, clash=True).columns
    assert neardup.near_duplicates(spark, docs([])).count() == 0


def test_windows_of_every_length():
    texts = ["", "a", "a b c d", "a b c d e", "a b c d e f", " x\ty\nz ", "é à ü ö ß é à ü ö ß", "a b c d e f"]
    hashes, bounds = neardup.windows([t.encode() for t in texts])
    known = {}
    for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
        found = WORD.findall(t)
        grams = [tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))] if found else []
        assert b - a == len(grams) and all(known.setdefault(g, h) == h for g, h in zip(grams, hashes[a:b].tolist()))
    assert len(set(known.values())) == len(known)


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    seen, expected = [], []
    for _ in range(300):
        own = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
        x = rng.uniform(1, 2, len(own)).astype(np.float32)
        y = np.where(rng.random(len(own)) < 0.15, x * 1.9, x).astype(np.float32)
        expected.append(neardup.jaccard((own, x), (own, y)) ** neardup.ROWS)
        seen.append((neardup.band_keys(own, x) == neardup.band_keys(own, y)).mean())
    assert abs(np.mean(seen) - np.mean(expected)) < 0.03


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 40)] + [(300, 299)]
    got = {r.id: r.label for r in neardup.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in range(7, 40)}, 299: 299, 300: 299}


def run_by_hand(rows):
    """The pipeline over (doc_id, text, source)."""
    def fine(text):
        n, chars, symbols, dup, repeats = measures(text)
        lines = sum(bool(WORD.search(line)) for line in (text or "").split("\n"))
        capitals = sum(c.isupper() for c in text or "")
        return not (n < 10 or 100 * repeats > 20 * n or 10 * symbols > n or not 2 * n <= chars <= 12 * n or 100 * dup > 40 * lines or 100 * capitals > 40 * chars)

    rows = [r for r in rows if fine(r[1])]
    last = {}
    for r in sorted(rows, key=lambda r: r[0]):
        last[r[1]] = r
    rows = list(last.values())
    classes = classes_by_hand([r[:2] for r in rows])
    rows = [r for r in rows if classes[r[1]] == r[0]]
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    ids = {i: tuple(model.encode(t)) for i, t, _ in rows}
    out = Counter()
    for (i, n, _, _, taken), count in mix_by_hand(rows).items():
        if taken:
            out[i, ids[i], len(ids[i]), True] += count * taken // n
    return out


def test_pipeline_equals_brute_force(spark, docs, odd_rows, tmp_path):
    rows = [(i, t, f"src{i % 4}" if i % 9 else None) for i, t in families(3, 30)]
    rows += [(i + 1000, t, "odd") for i, t in odd_rows if i is not None]
    rows += [(2000 + k, junk, "src0") for k, junk in enumerate(["LOUD " * 30, "a|b| " * 40, "same line of words here\n" * 9, "too short"])]
    docs([(i, t, None, s) for i, t, s in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    got = contract.queries()["pipeline"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.restored) for r in got) == run_by_hand(rows)


def test_stages_return_the_columns_of_documents_and_take_no_rows(spark, docs):
    df = docs([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, "unused")
        assert out.count() == 0 and (name == corpus_pipeline.STAGES[-1][0] or out.columns == df.columns)


def test_stages_carry_columns_of_any_name(spark, docs):
    df = docs([(k, " ".join(f"w{k}x{j}" for j in range(20)), "en", f"s{k % 3}") for k in range(30)] * 2, clash=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "unused")
        assert out.columns == df.columns and out.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, df, "unused").count() == 60


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(contract.oracle_sql()) & set(queries.QUERIES) == set(queries.ORACLE)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_result_equals_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    res = con.sql(queries.ORACLE[name])
    columns = sorted(df.columns)
    assert sorted(res.columns) == columns
    order = [list(res.columns).index(c) for c in columns]
    assert Counter(repr([r[c] for c in columns]) for r in df.collect()) == Counter(repr([r[i] for i in order]) for r in res.fetchall())


def linked(spark, docs, rows, bands):
    """Classes of more than one text by the given bands, as `id: smallest id`."""
    df = docs(rows)
    reps = spark.createDataFrame([(i, b) for (i, _), b in zip(rows, bands)], "rep LONG, bands ARRAY<LONG>")
    shipped = spark.sparkContext.broadcast(neardup.frequency_sketch(df, "text"))
    edges = neardup.links(spark, reps, df, shipped, "text", "doc_id")
    return {r.id: r.label for r in neardup.components(edges).collect()}


def test_chains_of_four_in_one_bucket_in_every_order(spark, docs):
    rows, bands, want = [], [], {}
    for n, order in enumerate(itertools.permutations(range(4))):
        words, chain = [f"f{n}w{k}" for k in range(140)], []
        for step in range(4):  # each is near the one before only
            for at in (10 + 20 * step, 20 + 20 * step) if step else ():
                words[at] = f"f{n}x{at}"
            chain.append(" ".join(words))
        for k, at in enumerate(order):
            rows.append((10 * n + k, chain[at]))
            bands.append([n] + [1000 + 100 * len(rows) + j for j in range(15)])
            want[10 * n + k] = 10 * n
    assert linked(spark, docs, rows, bands) == want


def test_a_pair_in_a_crowded_bucket_of_unlike_texts(spark, docs):
    shared = [f"s{k}" for k in range(150)]
    rows = [(k, " ".join(shared + [f"t{k}_{j}" for j in range(60)])) for k in range(40)]
    rows += [(98, rows[39][1] + " one more"), (99, rows[38][1] + " another end")]
    bands = [[7] + [1000 + 100 * i + j for j in range(15)] for i, _ in rows]
    assert linked(spark, docs, rows, bands) == {39: 39, 98: 39, 38: 38, 99: 38}


def test_unlike_texts_around_one_passage_meet_few_others(spark, docs, monkeypatch):
    """What is compared stays in proportion to the texts, though all of them share a bucket and the passage."""
    shared = [f"s{k}" for k in range(150)]
    rows = [(k, " ".join(shared + [f"t{k}_{j}" for j in range(60)])) for k in range(2000)]
    rows += [(5000 + k, rows[k][1] + " one more") for k in range(0, 2000, 40)]
    bands = [[7] + [100_000 + 100 * i + j for j in range(15)] for i, _ in rows]
    met, plain = [], neardup.similar
    monkeypatch.setattr(neardup, "similar", lambda pairs, *rest: (met.append(pairs.count()), plain(pairs, *rest))[1])
    want = {**{k: k for k in range(0, 2000, 40)}, **{5000 + k: k for k in range(0, 2000, 40)}}
    assert linked(spark, docs, rows, bands) == want and sum(met[2:]) < len(rows)
