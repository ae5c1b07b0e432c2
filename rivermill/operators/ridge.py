"""Ridge regression of many targets from one pass: mergeable moments, solved once on the driver.

Every task sums up its rows as (number, means, products of deviations), block by block. Two such sums make one whatever
rows they are of, so tasks merge in a tree, parts of the data (roles, folds) are added up as they are needed, and all
targets share one pass. What comes to the driver is one sum per part; the number of columns bounds it. Deviations are
taken from each block's own means, so large offsets cost no precision.

Rows with a null or NaN among their inputs or targets are left out. A constant input is only centred. Without rows there
is no model (ValueError).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks whose sums are merged at once in the first of two steps.
SALTS = 256


@dataclass(frozen=True)
class Moments:
    n: int
    mean: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(z: np.ndarray) -> Moments:
        mean = z.mean(axis=0)
        return Moments(len(z), mean, (z - mean).T @ (z - mean))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n), self.products + other.products + np.outer(step, step) * (self.n * other.n / n))


def moments(rows: DataFrame, x: Column, y: Column, part: Column | None = None) -> dict[str | None, Moments]:
    """Sums over inputs and targets (both arrays) side by side, per value of `part` (as text)."""
    source = rows.select((F.lit(None) if part is None else part).cast("string").alias("part"), F.concat(x.cast("array<double>"), y.cast("array<double>")).alias("z"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Moments] = {}
        for batch in batches:
            cells = batch.column(1)
            z = cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            sound = ~np.isnan(z).any(axis=1)
            names = np.array(batch.column(0).to_pylist(), object)
            for name in dict.fromkeys(names[sound]):
                own = Moments.of(z[sound & (names == name)])
                held[name] = held[name] + own if name in held else own
        for name, m in held.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([name], pa.string()), "n": [m.n], "mean": [m.mean.tolist()], "products": [m.products.ravel().tolist()]})

    schema = "part string, n long, mean array<double>, products array<double>"

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        m = reduce(add, map(_moments, frame.itertuples()))
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "n": [m.n], "mean": [m.mean], "products": [m.products.ravel()]})

    # an array with a null is one row that counts for nothing; only then all rows have the same length
    sums = source.where("z IS NOT NULL").mapInArrow(partial, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = sums.groupBy("part", "salt").applyInPandas(lambda frame: merged(frame), schema)
    return {r.part: _moments(r) for r in some.groupBy("part").applyInPandas(lambda frame: merged(frame), schema).collect()}


def _moments(row) -> Moments:
    mean = np.asarray(row.mean, np.float64)
    return Moments(int(row.n), mean, np.asarray(row.products, np.float64).reshape(len(mean), len(mean)))


class Ridge(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model: `output` is an array with one prediction per target. Saved and loaded as any model of Spark ML."""

    inputs = Param(Params._dummy(), "inputs", "columns, or one array column", TypeConverters.toListString)
    output = Param(Params._dummy(), "output", "column of the predictions", TypeConverters.toString)
    means = Param(Params._dummy(), "means", "means of the inputs", TypeConverters.toListFloat)
    spreads = Param(Params._dummy(), "spreads", "population spreads of the inputs", TypeConverters.toListFloat)
    coefficients = Param(Params._dummy(), "coefficients", "per target, of standardised inputs", TypeConverters.identity)
    intercepts = Param(Params._dummy(), "intercepts", "per target", TypeConverters.toListFloat)

    @property
    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputs)

    @property
    def scale(self) -> tuple[list[float], list[float]]:
        return self.getOrDefault(self.means), self.getOrDefault(self.spreads)

    @property
    def models(self) -> list[SimpleNamespace]:
        """Coefficients of standardised inputs and intercept, per target."""
        both = zip(self.getOrDefault(self.coefficients), self.getOrDefault(self.intercepts))
        return [SimpleNamespace(coefficients=Vectors.dense(c), intercept=b) for c, b in both]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        means, spreads = map(np.array, self.scale)
        weights = np.array(self.getOrDefault(self.coefficients)) / spreads
        offsets = np.array(self.getOrDefault(self.intercepts)) - weights @ means
        one = len(self.columns) == 1 and dataset.schema[self.columns[0]].dataType.typeName() == "array"

        def predicted(w: np.ndarray, b: float) -> Column:
            terms = [float(v) for v in w]
            if one:
                x = F.col(self.columns[0]).cast("array<double>")
                return F.aggregate(F.zip_with(x, F.array(*map(F.lit, terms)), lambda a, v: a * v), F.lit(float(b)), lambda total, v: total + v)
            return reduce(add, [F.col(c).cast("double") * F.lit(v) for c, v in zip(self.columns, terms)], F.lit(float(b)))

        return dataset.withColumn(self.getOrDefault(self.output), F.array(*[predicted(w, b) for w, b in zip(weights, offsets)]))


def solve(m: Moments, inputs: list[str], targets: int, alpha: float, output: str = "stacked", scale: tuple[list[float], list[float]] | None = None) -> Ridge:
    """Penalty `alpha` on the squared coefficients of standardised inputs; `scale` (means, spreads) other than the rows' own."""
    d = len(m.mean) - targets
    spread = np.sqrt(np.maximum(np.diag(m.products)[:d] / m.n, 0))
    means, spreads = (np.array(v) for v in scale) if scale else (m.mean[:d], np.where(spread > 0, spread, 1.0))
    gram = m.products[:d, :d] / np.outer(spreads, spreads)
    beta = np.linalg.solve(gram + alpha * np.eye(d), m.products[:d, d:] / spreads[:, None])
    intercepts = m.mean[d:] - ((m.mean[:d] - means) / spreads) @ beta
    model = Ridge()
    model._set(inputs=list(inputs), output=output, means=means.tolist(), spreads=spreads.tolist(), coefficients=beta.T.tolist(), intercepts=intercepts.tolist())
    return model


def total(parts: dict[str | None, Moments], keep: Callable[[str | None], bool] = lambda part: True) -> Moments:
    """The parts that are kept, as one."""
    kept = [m for name, m in sorted(parts.items(), key=lambda p: (p[0] is not None, p[0])) if keep(name)]
    if not kept:
        raise ValueError("no complete rows to fit on")
    return reduce(add, kept)


def content_key(rows: DataFrame) -> str:
    """A key of the rows' content, whatever their order and partitions: it changes with any cell, row or column name."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    names = F.xxhash64(F.lit("|".join(f"{c}:{t}" for c, t in sorted(rows.dtypes))))
    head = rows.sparkSession.range(1).select(names).first()[0]
    return f"{r.n}-{(r.x or 0) & (1 << 64) - 1:016x}-{int(r.s or 0) & (1 << 64) - 1:016x}-{head & (1 << 64) - 1:016x}"


def fit_or_load(rows: DataFrame, path: str, fit: Callable[[DataFrame], Ridge]) -> tuple[Ridge, bool]:
    """The model stored below `path` for rows of this very content and True, or a model fitted and stored now and False."""
    spark = rows.sparkSession
    folder = f"{path.rstrip('/')}/{content_key(rows)}"
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/metadata/_SUCCESS")
    if mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        return Ridge.load(folder), True
    model = fit(rows)
    model.write().overwrite().save(folder)
    return model, False
