import random
import zlib

import pytest
from pyspark.sql import functions as F

from rivermill.llm import cotrain, langid, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def test_held_out_languages_are_found(spark):
    got = queries.language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    aside = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in aside) >= 0.95 * len(aside)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es"} for r in got)


def test_nothing_is_learned_from_held_out_or_unlabelled_rows(spark, docs):
    rows = [(k, f"secret{k} text", "xx" if zlib.crc32(str(k).encode()) % 5 == 0 else "en") for k in range(40)] + [(99, "no label", None)]
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    learned = langid.learn(docs([(i, t, lang) for i, t, lang in rows]), ~held)
    assert list(learned) == ["en"] and b"label" not in learned["en"] and len(learned["en"]) <= langid.DICTIONARY_BYTES


def test_texts_without_letters_and_odd_rows(spark, docs, odd_rows):
    model = {"aa": b"same text twice word end", "bb": "日本 ünïcödé".encode()}
    got = langid.identify(spark, docs(odd_rows, clash=True), model, kept=F.col("label")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(odd_rows) and all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1, 2, 3, 9)) and by[4].lang_pred == "aa"
    assert {r.lang_pred for r in langid.identify(spark, docs(odd_rows), {}).collect()} == {"und"} and langid.identify(spark, docs([]), model).count() == 0


def test_ties_go_to_the_first_language_and_are_rejected():
    model = langid.Classifier({"aa": b"x", "bb": b"x"})
    assert model.predict("zzz yyy") == ("aa", 0.0, True)


def test_every_block_of_a_long_text_counts():
    rng = random.Random(1)
    aa, bb = (["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(300)] for _ in range(2))
    say = lambda vocabulary, n: " ".join(rng.choice(vocabulary) for _ in range(n))
    model = langid.Classifier({"aa": say(aa, 3000).encode(), "bb": say(bb, 3000).encode()})
    assert model.predict(say(bb, 700) + " " + say(aa, 9000))[0] == "aa" and model.predict(say(bb, 700))[0] == "bb"


def test_scores_follow_labels_that_were_not_learned_from(spark, table):
    labels = table("labels")
    aside = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    got = cotrain.score(table("documents"), labels.where(~aside))
    assert got.count() == 1000
    rows = got.join(labels.where(aside), "doc_id").where("quality IS NOT NULL").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert sum(pairs) / len(pairs) >= 0.9
    assert sum(r.good == bool(r.quality) for r in rows) >= 0.9 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_labels_of_one_class_or_none(spark, docs, odd_rows):
    df = docs(odd_rows, clash=True)
    labels = lambda rows: spark.createDataFrame(rows, "doc_id LONG, quality INT")
    for rows, want in (([], 0.5), ([(1, None), (None, 1)], 0.5), ([(5, 1), (5, 0), (7, 1)], 1.0)):
        got = cotrain.score(df, labels(rows)).collect()
        assert len(got) == len(odd_rows) and {r.score for r in got} == {want}
    assert cotrain.score(docs([]), labels([(1, 1), (2, 0)])).count() == 0


def test_odd_rows_are_scored(spark, docs, odd_rows):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 10)], "doc_id LONG, quality INT")
    got = cotrain.score(docs(odd_rows, clash=True), labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id == 6}) == 1


def test_long_texts_and_copies_are_learned_from(spark, docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    rows = [(k, " ".join(word() for _ in range(3000)), "long") for k in range(6)]
    rows += [(100 + k, "copied text", "copies") for k in range(600)] + [(1000 + k, f"rare {word()}", "copies") for k in range(20)]
    rows += [(2000 + k, " ".join(word() for _ in range(12)), "short") for k in range(1500)]
    learned = langid.learn(docs(rows), F.lit(True))
    assert all(0.85 * langid.DICTIONARY_BYTES < len(learned[name]) <= langid.DICTIONARY_BYTES for name in ("long", "short"))
    assert sorted(learned["copies"].decode().split("\n")) == sorted(["copied text", *[t for _, t, name in rows if t.startswith("rare")]])


def test_all_unlabelled_rows_take_part(spark, docs, monkeypatch):
    say = lambda k: ("BUY NOW $$$", "shop") if k % 2 else ("calm river story", "book")
    rows = [(k, say(k)[0], "en", say(k)[1]) for k in range(9000)]
    fit, seen = cotrain._fit, []
    monkeypatch.setattr(cotrain, "_fit", lambda rows, view: seen.append(rows.count()) or fit(rows, view))
    cotrain.train(docs(rows), spark.createDataFrame([(k, 1 - k % 2) for k in range(100)], "doc_id LONG, quality INT"), "text", "doc_id", "quality")
    assert len(seen) == 6 and all(n == seen[0] + 8900 for n in seen[2:])


def test_every_text_is_cut_into_tokens_once(spark, docs, monkeypatch):
    rows = [(k, "BUY NOW $$$" if k % 2 else "calm river story") for k in range(300)] + [(None, "a null id"), (7, None)]
    cut, seen = cotrain.features, []
    monkeypatch.setattr(cotrain, "features", lambda df, *a, **carried: seen.append(df.count()) or cut(df, *a, **carried))
    got = cotrain.score(docs(rows), spark.createDataFrame([(k, 1 - k % 2) for k in range(100)], "doc_id LONG, quality INT")).collect()
    assert seen == [101, 302]  # the labelled rows to fit on, then every row
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
