"""Quality classifier by co-training: a text-content view and a page-metadata view teach each other, then both score all rows.

Each view is a logistic regression over hashed tokens. Rounds start from labelled rows; then each view labels all
unlabelled rows that it is sure of, and the other view learns from them too. Only the labelled rows are bounded:
`LABELLED`, the first in the order of hashed ids; a fifth of the labelled rows is kept aside
for calibration (Platt scaling of each view). The score is the sum of the calibrated log odds less the prior's, as for views
that are independent given the class. Every row is scored on its whole text.

A null or empty text has no content tokens; null metadata is a value of its own. Without labels of both classes there is nothing
to learn: all scores are then the share of good labels, or 0.5 without any. Of repeated labels of a row the largest
counts. An empty table gives an empty result, repeated rows are scored alike, further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermill.llm.shared import words
from rivermill.session import materialise

LABELLED, ROUNDS = 8000, 2
SURE = 0.97
CONTENT_BITS, META_BITS = 14, 10
ITERATIONS, PENALTY = 25, 1e-4
VIEWS, ORIGIN = ("content", "meta"), ("source", "lang")


def content_tokens(text: Column) -> Column:
    """Words in lower case, and their shapes: runs of letters, digits and equal signs as one character each."""
    shape = F.coalesce(text, F.lit(""))
    for pattern, to in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"\p{N}+", "0"), (r"([^\w\s])\1+", "$1")):
        shape = F.regexp_replace(shape, pattern, to)
    return F.concat(words(F.lower(text)), F.transform(words(shape), lambda s: F.concat(F.lit("\x01"), s)))


def meta_tokens(docs: DataFrame, text: str) -> Column:
    """Where a page comes from, and its size and layout in powers of two."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = F.length(t)
    lines = size - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    step = lambda name, value: F.concat(F.lit(f"{name}="), F.coalesce(F.floor(F.log2(value + 1)).cast("string"), F.lit("null")))
    share = lambda name, pattern: step(name, 1000.0 * F.length(F.regexp_replace(t, pattern, "")) / F.greatest(size, F.lit(1)))
    origin = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in ORIGIN if c in docs.columns]
    return F.array(*origin, step("size", size), step("lines", lines), step("line", size / lines), share("marks", r"[\w\s.,]+"), share("capitals", r"\P{Lu}+"))


def _needed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Only the columns that the views read, so that no other one can clash."""
    return docs.select(doc_id, text, *[c for c in ORIGIN if c in docs.columns])


def features(docs: DataFrame, text: str, doc_id: str, **carried: Column) -> DataFrame:
    """`id`, one vector per view, and the carried columns."""
    tokens = docs.select(F.col(doc_id).alias("id"), content_tokens(F.col(text)).alias("_content"), meta_tokens(docs, text).alias("_meta"), *[c.alias(n) for n, c in carried.items()])
    for view, bits in zip(VIEWS, (CONTENT_BITS, META_BITS)):
        tokens = HashingTF(numFeatures=1 << bits, inputCol=f"_{view}", outputCol=f"_{view}_counts", binary=view == "meta").transform(tokens)
        tokens = Normalizer(p=2.0, inputCol=f"_{view}_counts", outputCol=view).transform(tokens).drop(f"_{view}", f"_{view}_counts")
    return tokens  # unit length, so that a text's length is no signal of its own


@dataclass(frozen=True)
class View:
    model: LogisticRegressionModel
    slope: float
    offset: float

    def log_odds(self, rows: DataFrame, view: str) -> Column:
        return self.slope * F.col(f"{view}_raw") + F.lit(self.offset)


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol=view, labelCol="label", maxIter=ITERATIONS, regParam=PENALTY, standardization=False, rawPredictionCol="raw", probabilityCol="p", predictionCol="y").fit(rows.select(view, "label"))


def _scored(rows: DataFrame, models: dict[str, LogisticRegressionModel]) -> DataFrame:
    for view, model in models.items():
        named = model.copy().setRawPredictionCol(f"{view}_vector").setProbabilityCol("").setPredictionCol("")
        rows = named.transform(rows).withColumn(f"{view}_raw", vector_to_array(f"{view}_vector")[1]).drop(f"{view}_vector")
    return rows


def train(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str) -> tuple[dict[str, View], float]:
    """Both views, calibrated, and the share of good labels. No views if the labels have one class or none."""
    views, prior, _ = _learn(docs, labels, text, doc_id, label)
    return views, prior


def _learn(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str) -> tuple[dict[str, View], float, DataFrame | None]:
    """As `train`, and the features of every row, written once to learn from and to score."""
    docs = _needed(docs, text, doc_id)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_of")).agg(F.max(label).cast("double").alias("label"))
    first = materialise(known.orderBy(F.xxhash64("_of"), "_of").limit(LABELLED), "cotrain-labels")
    rows = docs.join(F.broadcast(first), F.col(doc_id) == F.col("_of"))
    rows = materialise(features(rows, text, doc_id, label=F.col("label")), "cotrain-labelled")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    prior = counts.get(1.0, 0) / sum(counts.values()) if counts else 0.5
    if len(counts) < 2:
        return {}, prior, None
    aside = F.pmod(F.xxhash64(F.col("id"), F.lit("aside")), F.lit(5)) == 0
    learning, calibration = rows.where(~aside).cache(), rows.where(aside)
    told = features(docs, text, doc_id).join(known, F.col("id") == F.col("_of"), "left")  # vectors are moved, not texts
    everything = materialise(told.select("id", *VIEWS, F.col("_of").isNotNull().alias("known")), "cotrain-features")
    pool = everything.where(~F.col("known") & F.col("id").isNotNull())
    sets = {view: learning for view in VIEWS}
    models = {view: _fit(sets[view], view) for view in VIEWS}
    for _ in range(ROUNDS):
        guessed = _scored(pool, models)  # scored anew per fit: less than writing all vectors again
        for view, other in zip(VIEWS, VIEWS[::-1]):
            p = 1 / (1 + F.exp(-F.col(f"{other}_raw")))
            sure = guessed.select("id", *VIEWS, F.when(p >= SURE, 1.0).when(p <= 1 - SURE, 0.0).alias("label")).where("label IS NOT NULL")
            sets[view] = learning.unionByName(sure)
        models = {view: _fit(sets[view], view) for view in VIEWS}
    views = {}
    aside_scored = materialise(_scored(calibration, models), "cotrain-aside")
    for view in VIEWS:
        flat = VectorAssembler(inputCols=[f"{view}_raw"], outputCol="x").transform(aside_scored).select("x", "label")
        if flat.select("label").distinct().count() == 2:
            platt = LogisticRegression(featuresCol="x", labelCol="label", maxIter=ITERATIONS, regParam=1e-3).fit(flat)
            views[view] = View(models[view], float(platt.coefficients[0]), float(platt.intercept))
        else:
            views[view] = View(models[view], 1.0, 0.0)
    learning.unpersist()
    return views, prior, everything


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """`doc_id`, the calibrated `content_score` and `meta_score`, their combination `score`, and `good` for every row."""
    views, prior, everything = _learn(docs, labels, text, doc_id, label)
    if not views:
        flat = F.lit(float(prior))
        return docs.select(doc_id, flat.alias("content_score"), flat.alias("meta_score"), flat.alias("score"), (flat >= 0.5).alias("good"))
    rows = _scored(everything, {v: view.model for v, view in views.items()})
    base = F.log(F.lit(prior / (1 - prior)))
    odds = {v: view.log_odds(rows, v) for v, view in views.items()}
    chance = lambda x: 1 / (1 + F.exp(-x))
    rows = rows.select(F.col("id").alias(doc_id), *[o.alias(f"{v}_odds") for v, o in odds.items()])
    both = F.col("content_odds") + F.col("meta_odds") - base
    return rows.select(doc_id, chance(F.col("content_odds")).alias("content_score"), chance(F.col("meta_odds")).alias("meta_score"), chance(both).alias("score"), (both >= 0).alias("good"))
