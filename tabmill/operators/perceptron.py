"""Feed-forward classifiers by L-BFGS over scaled rows: the model of Spark's perceptron, its gradients as matrix products per task.

The scaled rows are written once, in blocks; a pass gives one sum of gradients per task. The driver holds the weights and these sums. Every row counts alike, however the rows are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tabmill.operators import features as feat
from tabmill.session import fresh_path

BLOCK = 1024    # rows of a matrix product: what fits the caches of a core
BATCH = 32      # blocks of an Arrow batch
PAIRS = 10      # steps that the search remembers of the curvature
TRIES = 10      # evaluations of a line search, and of the narrowing that ends it
FALL, TURN = 1e-4, 0.9  # the strong Wolfe conditions

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]


# -- the search ------------------------------------------------------------------------------

class NoStep(Exception):
    """No step along a direction satisfies the conditions."""


@dataclass
class Point:
    """A step along a direction: its value, its slope, and weights and gradient there."""

    t: float
    value: float
    slope: float
    at: np.ndarray
    gradient: np.ndarray


def between(a: Point, b: Point) -> float:
    """The minimum of the cubic through two points, kept off their ends."""
    if a.t > b.t:
        a, b = b, a
    d1 = a.slope + b.slope - 3 * (a.value - b.value) / (a.t - b.t)
    square = d1 * d1 - a.slope * b.slope
    d2 = math.sqrt(square) if square >= 0 else math.nan
    width = b.t - a.t
    bottom = b.slope - a.slope + 2 * d2
    t = b.t - width * (b.slope + d2 - d1) / bottom if bottom else math.nan
    if math.isnan(t):
        t = a.t + width / 2
    return min(max(t, a.t + 0.1 * width), a.t + 0.9 * width)


def line_search(objective: Objective, start: Point, direction: np.ndarray, first: float) -> Point:
    """A step that satisfies the strong Wolfe conditions."""
    if start.slope > 0:
        raise NoStep

    def point(t: float) -> Point:
        at = start.at + t * direction
        value, gradient = objective(at)
        return Point(t, value, float(gradient @ direction), at, gradient)

    def narrowed(low: Point, high: Point) -> Point:
        for _ in range(TRIES):
            c = point(between(low, high))
            if c.value > start.value + FALL * c.t * start.slope or c.value >= low.value:
                high = c
                continue
            if abs(c.slope) <= TURN * abs(start.slope):
                return c
            if c.slope * (high.t - low.t) >= 0:
                high = low
            low = c
        raise NoStep

    t, low = first, start
    for i in range(TRIES):
        c = point(t)
        if not math.isfinite(c.value):
            t /= 2
            continue
        if c.value > start.value + FALL * t * start.slope or (i and c.value >= low.value):
            return narrowed(low, c)
        if abs(c.slope) <= TURN * abs(start.slope):
            return c
        if c.slope >= 0:
            return narrowed(c, low)
        low, t = c, t * 1.5
    raise NoStep


def downhill(gradient: np.ndarray, pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The direction of the search by the last steps and changes of the gradient, latest first."""
    d, shares = gradient.copy(), []
    for step, change in pairs:
        shares.append((step @ d) / (step @ change))
        d -= shares[-1] * change
    if pairs:
        step, change = pairs[0]
        d *= (step @ change) / (change @ change)
    for (step, change), share in zip(reversed(pairs), reversed(shares)):
        d += (share - (change @ d) / (step @ change)) * step
    return -d


def minimum(objective: Objective, start: np.ndarray, iterations: int, tolerance: float) -> np.ndarray:
    """Weights after at most ``iterations`` steps of L-BFGS; it ends earlier when the value or the gradient hardly changes any more."""
    value, gradient = objective(start)
    now, values, first = Point(0.0, value, 0.0, start, gradient), [value], value
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    done, failed = 0, False
    while done < iterations and np.linalg.norm(now.gradient) > max(tolerance * abs(now.value), 1e-8):
        d = downhill(now.gradient, pairs)
        begin = Point(0.0, now.value, float(now.gradient @ d), now.at, now.gradient)
        try:
            found = line_search(objective, begin, d, 1.0 if done else 1 / np.linalg.norm(d))
            if found.t * np.linalg.norm(now.gradient) < 1e-10:
                raise NoStep
        except NoStep:
            if failed or not pairs:  # a bare gradient leads nowhere either
                break
            failed, pairs = True, []
            continue
        failed = False
        pairs = [(found.at - now.at, found.gradient - now.gradient), *pairs][:PAIRS]
        now, done = found, done + 1
        values = [*values, now.value][-20:]
        if len(values) > 1 and abs(now.value - max(values)) <= tolerance * first:
            break
    return now.at


# -- the network -----------------------------------------------------------------------------

def unpacked(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrices (inputs x outputs) and offsets, in the order of Spark's weights."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def loss_and_gradient(weights: Sequence[tuple[np.ndarray, np.ndarray]], x: np.ndarray, y: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    """Over rows, the columns of ``x``: the sum of their cross entropies, then those of its gradient. Hidden layers are logistic."""
    values = [x]
    for i, (matrix, offset) in enumerate(weights):
        z = matrix.T @ values[-1]
        z += offset[:, None]
        if i + 1 < len(weights):
            np.negative(z, out=z)
            with np.errstate(over="ignore"):
                np.exp(z, out=z)
            z += 1.0
            np.reciprocal(z, out=z)
        values.append(z)
    back = values.pop()
    back -= back.max(axis=0)
    np.exp(back, out=back)
    back /= back.sum(axis=0)
    rows = np.arange(len(y))
    with np.errstate(divide="ignore"):
        lost = -np.log(back[y, rows])
    back[y, rows] -= 1.0
    if w is not None:
        lost *= w
        back *= w
    found: list[np.ndarray] = []
    for i in range(len(weights) - 1, -1, -1):
        found[:0] = [(values[i] @ back.T).ravel(), back.sum(axis=1)]
        if i:
            back = weights[i][0] @ back
            back *= values[i]
            back *= 1.0 - values[i]
    return np.concatenate([[lost.sum()], *found])


class Blocks:
    """Scaled rows of one table in blocks, kept at hand for all fits that share their columns and label until it is closed.

    A block is a matrix, in bytes, of the scaled columns, the class and, if ``merged``, the weight; tasks need not take rows apart. Blocks are read in a
    session of their own, whose Arrow batches hold few of them.
    """

    def __init__(self, merged: bool = False) -> None:
        self.merged = merged
        self.done: dict[tuple, tuple] = {}
        self.lock = Lock()

    def __enter__(self) -> Blocks:
        return self

    def __exit__(self, *_) -> None:
        for _, blocks, _ in self.done.values():
            blocks.unpersist()
        self.done.clear()

    def of(self, df: DataFrame, cols: Sequence[str], label: str, classes: int) -> tuple[feat.PopulationScalerModel, DataFrame, float]:
        """The scaler, the blocks and the number of rows."""
        name = (tuple(cols), label, classes)
        with self.lock:
            if name not in self.done:
                self.done[name] = self._written(df, cols, label, classes)
            return self.done[name]

    def _written(self, df, cols, label, classes):
        names = [f"{c}__scaled" for c in cols]
        scaler = feat.PopulationScaler(inputCols=list(cols), outputCols=names).fit(df)
        own = F.col(label).cast("double")
        whole = lambda c, good, what: F.when(good, c).otherwise(F.raise_error(F.lit(what)))
        x = [whole(c, c.isNotNull() & ~F.isnan(c), "a feature is missing") for c in (F.col(n).cast("double") for n in names)]
        y = whole(own, (own >= 0) & (own < classes) & (own == F.floor(own)), f"a label is none of {classes} classes")
        rows = scaler.transform(df).select(*[c.alias(f"x{i}") for i, c in enumerate(x)], y.alias("y"))
        if self.merged:
            rows = rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("w"))

        merged, spark = self.merged, df.sparkSession

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                parts = [table[:, s:s + BLOCK] for s in range(0, batch.num_rows, BLOCK)]
                n = [float(p[-1].sum()) if merged else float(p.shape[1]) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.float64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["n", "block"])

        path = fresh_path(spark, "blocks")
        rows.mapInArrow(pack, "n double, block binary").write.parquet(path)
        reader = spark.newSession()
        reader.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
        blocks = reader.read.schema("n double, block binary").parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
        return scaler, blocks, blocks.agg(F.sum("n")).first()[0] or 0.0


def objective(blocks: DataFrame, number: float, layers: Sequence[int], merged: bool = False) -> Objective:
    """The mean cross entropy of a network over the rows, with its gradient: one pass, a sum per task."""
    inputs = layers[0]
    size = 1 + sum(a * b + b for a, b in zip(layers, layers[1:]))

    def at(flat: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weights = np.zeros(size), unpacked(flat, layers)
            for batch in batches:
                for block in batch.column(0):
                    table = np.frombuffer(block.as_buffer()).reshape(inputs + 1 + merged, -1)
                    total += loss_and_gradient(weights, table[:inputs], table[inputs].astype(np.int64), table[inputs + 1] if merged else None)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        total = np.zeros(size)
        for r in blocks.select("block").mapInArrow(run, "sums binary").collect():  # a row per task
            total += np.frombuffer(r["sums"])
        return total[0] / number, total[1:] / number

    return at


class Perceptron(Estimator):
    """Spark's feed-forward classifier on scaled columns, its settings taken from ``settings``, fitted by passes over written rows.

    It begins with the weights that Spark's begins with and goes by the same rules; the mean it makes least is that over rows, where Spark
    takes that over blocks of rows. The model is Spark's own. A missing feature and a label that is no class raise. ``merged`` is for inputs of
    which a few combinations are possible, such as 0/1 flags: equal rows become one, with their number as weight.
    """

    def __init__(self, cols: Sequence[str], settings: MultilayerPerceptronClassifier, blocks: Blocks | None = None, merged: bool = False):
        super().__init__()
        if settings.getSolver() != "l-bfgs":
            raise ValueError(f"no solver {settings.getSolver()}")
        self.cols, self.settings, self.blocks, self.merged = list(cols), settings, blocks, merged

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        if self.blocks is None:
            with Blocks(self.merged) as blocks:
                return self._fitted(dataset, blocks)
        return self._fitted(dataset, self.blocks)

    def _fitted(self, dataset: DataFrame, blocks: Blocks) -> PipelineModel:
        settings, layers = self.settings, self.settings.getLayers()
        label, features = settings.getLabelCol(), settings.getFeaturesCol()
        scaler, rows, number = blocks.of(dataset, self.cols, label, layers[-1])
        if not number:
            raise ValueError("no rows to fit")
        any_row = dataset.sparkSession.createDataFrame([(Vectors.dense([0.0] * layers[0]), 0.0)], [features, label])
        spark_model = lambda given: settings.copy({settings.maxIter: 0, **given}).fit(any_row)  # no step: the weights it begins with
        begin = settings.getInitialWeights() if settings.isDefined("initialWeights") else spark_model({}).weights
        found = minimum(objective(rows, number, layers, blocks.merged), np.array(begin.toArray()), settings.getMaxIter(), settings.getTol())
        model = spark_model({settings.initialWeights: Vectors.dense(found)})
        return PipelineModel([scaler, VectorAssembler(inputCols=scaler.getOutputCols(), outputCol=features), model])
