"""Training and search with Spark ML; text classes as plain aggregation.

Training rows are persisted before an iterative fit and released after it. Splits and folds
come from key hashes (``operators.split``), so a trial can be repeated exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from random import Random
from threading import Lock

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, LogisticRegressionModel,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabmill.functions.joins import lookup
from tabmill.operators import features as feat, split
from tabmill.session import cut, fresh_path, shared_dir


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep the rows at hand for the passes of a fit.

    With a checkpoint folder set, boosting cuts its growing lineage there every few rounds.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def scaled(cols: Sequence[str], *estimators: Estimator) -> Pipeline:
    """Population scaling and assembly before an estimator."""
    names = [f"{c}__scaled" for c in cols]
    return Pipeline(stages=[feat.PopulationScaler(inputCols=list(cols), outputCols=names),
                            VectorAssembler(inputCols=names, outputCol="features"), *estimators])


def plain(cols: Sequence[str], *estimators: Estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features"), *estimators])


# -- trees on merged rows -------------------------------------------------------------------

SAMPLE = 10_000  # rows that Spark's trees draw, or the square of the bins if that is more, to choose the bounds of bins


def tree_bounds(df: DataFrame, cols: Sequence[str], bins: int, weight: str, seed: int = 2) -> dict[str, list[float]]:
    """Bounds between the bins of every column, by the rule of Spark's trees: midpoints of all values if they are few, else of about equal weights.

    As there, large tables are judged by a random part of bounded size; only the bounds come from it.
    """
    rows = df.count()
    share = max(bins * bins, SAMPLE) / max(rows, 1)
    part = df if share >= 1 else df.sample(share, seed=seed)
    each = part.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("i", "v"), F.col(weight).alias("w"))
    values: list[list[tuple[float, float]]] = [[] for _ in cols]
    for r in each.where("v is not null").groupBy("i", "v").agg(F.sum("w").alias("w")).collect():  # sampled rows x columns at most
        values[r["i"]].append((r["v"], r["w"]))
    return {c: _bounds(sorted(found), min(bins, rows) - 1) for c, found in zip(cols, values)}


def _bounds(values: Sequence[tuple[float, float]], most: int) -> list[float]:
    middle = [(a + b) / 2 for (a, _), (b, _) in zip(values, values[1:])]
    if len(middle) <= most:
        return middle
    stride = sum(w for _, w in values) / (most + 1)
    bounds, seen, target = [], values[0][1], stride
    for bound, (_, w) in zip(middle, values[1:]):
        if abs(seen - target) < abs(seen + w - target):
            bounds.append(bound)
            target += stride
        seen += w
    return bounds


class Cells:
    """Merged rows of one table, written once for every way of merging them that its fits ask for."""

    def __init__(self) -> None:
        self.done: dict[tuple, tuple[Bucketizer, DataFrame]] = {}
        self.lock = Lock()

    def of(self, df: DataFrame, cols: Sequence[str], bins: int, label: str, weight: str | None, keys: Sequence[str], mean: bool):
        name = (tuple(cols), bins, label, weight, tuple(keys), mean)
        with self.lock:
            if name not in self.done:
                self.done[name] = self._merged(df, *name)
            return self.done[name]

    @staticmethod
    def _merged(df, cols, bins, label, weight, keys, mean):
        own = F.col(weight).cast("double") if weight else F.lit(1.0)
        rows = df.select(*cols, F.col(label).cast("double").alias(label), *keys, own.alias("_weight"))
        fitted = rows
        for k in keys:
            fitted = fitted.where(~F.col(k))
        bounds = tree_bounds(fitted, cols, bins, "_weight")
        inf = float("inf")
        # a tree sends the bound itself to the left, a bucket holds its lower end; a column without a bound has one value
        ends = [[-inf, *[math.nextafter(b, inf) for b in bounds[c]], inf] if bounds[c] else [-inf, 0.0, inf] for c in cols]
        names = [f"{c}__bin" for c in cols]
        cutter = Bucketizer(inputCols=list(cols), outputCols=names, splitsArray=ends)
        total = F.sum("_weight").alias("_weight")
        placed = cutter.transform(rows)
        for n in names:
            placed = placed.withMetadata(n, {})  # bins are in order: without this a tree takes them for names
        if mean:
            told = (F.sum(F.col(label) * F.col("_weight")) / F.sum("_weight")).alias(label)
            return cutter, cut(placed.groupBy(*names, *keys).agg(told, total))
        return cutter, cut(placed.groupBy(*names, label, *keys).agg(total))


class Binned(Estimator):
    """Trees fitted on merged rows: those alike in all bins, and in the label, are one row with their weights added up.

    A tree sees nothing of a value but its bin, so the model is the same up to rounding, while a fit holds at most bins ** columns x labels
    rows, in each of its passes. Of a number that is boosted by squared errors only the mean over a bin matters. Fits that draw rows at random,
    or count them, are refused. The model cuts its columns to bins itself.
    """

    def __init__(self, cols: Sequence[str], trees: Estimator, cells: Cells | None = None):
        super().__init__()
        inner = trees.getClassifier() if isinstance(trees, OneVsRest) else trees
        if inner.getMinInstancesPerNode() > 1 or (inner.hasParam("subsamplingRate") and inner.getSubsamplingRate() < 1) or inner.hasParam("bootstrap"):
            raise ValueError("merged rows cannot be drawn or counted one by one")
        self.cols, self.trees, self.inner, self.cells = list(cols), trees, inner, cells

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        outer, inner = self.trees, self.inner
        weight = next((t.getWeightCol() for t in (outer, inner) if t.isDefined("weightCol") and t.getWeightCol()), None)
        held_out = inner.hasParam("validationIndicatorCol") and inner.isDefined("validationIndicatorCol")
        keys = [inner.getValidationIndicatorCol()] if held_out else []
        mean = isinstance(inner, GBTRegressor) and inner.getLossType() == "squared" and not keys
        cutter, cells = (self.cells or Cells()).of(dataset, self.cols, inner.getMaxBins(), outer.getLabelCol(), weight, keys, mean)
        assembler = VectorAssembler(inputCols=cutter.getOutputCols(), outputCol=outer.getFeaturesCol())
        with held(assembler.transform(cells)) as rows:
            model = outer.copy({outer.weightCol: "_weight"}).fit(rows)
        return PipelineModel([cutter, assembler, model])


def binned(cols: Sequence[str], trees: Estimator, cells: Cells | None = None) -> Binned:
    """Trees on merged rows; fits of one table that share ``cells`` merge it once."""
    return Binned(cols, trees, cells)


class Votes(Transformer):
    """Adds up the class shares of trees; the prediction is the class with the most, the first of equal ones."""

    def __init__(self, shares: Sequence[str], classes: int, out: str):
        super().__init__()
        self.shares, self.classes, self.out = list(shares), classes, out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        arrays = [vector_to_array(F.col(s)) for s in self.shares]
        votes = F.array(*[sum((a[i] for a in arrays), F.lit(0.0)) for i in range(self.classes)])
        return dataset.withColumn("_votes", votes).withColumn(
            self.out, (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")).drop("_votes", *self.shares)


class BinnedForest(Estimator):
    """A random forest fitted on merged rows, every tree on its own draw of them.

    A forest takes each row a Poisson number of times for each tree. Over the rows alike in all bins and in the label these numbers add up to a
    Poisson number again, whose mean is the sum of theirs: it is drawn at once, and alike however the rows are
    partitioned. A tree then sees what it would have seen of the rows, whose number a pass no longer grows with.
    """

    def __init__(self, cols: Sequence[str], forest: RandomForestClassifier, cells: Cells | None = None):
        super().__init__()
        if not forest.getBootstrap() or forest.getMinInstancesPerNode() > 1 or (forest.isDefined("weightCol") and forest.getWeightCol()):
            raise ValueError("only forests of rows drawn with replacement, without weights, can be fitted on merged rows")
        self.cols, self.forest, self.cells = list(cols), forest, cells

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        forest, n = self.forest, self.forest.getNumTrees()
        label, features = forest.getLabelCol(), forest.getFeaturesCol()
        cutter, cells = (self.cells or Cells()).of(dataset, self.cols, forest.getMaxBins(), label, None, [], False)
        classes = int(cells.agg(F.max(label)).first()[0]) + 1
        names = [f"_draw{i}" for i in range(n)]
        own = drawn(cells, [*cutter.getOutputCols(), label], names, forest.getSubsamplingRate(), forest.getSeed())
        assembler = VectorAssembler(inputCols=cutter.getOutputCols(), outputCol=features)
        rows = assembler.transform(own).select(
            features, F.col(label).alias(label, metadata={"ml_attr": {"type": "nominal", "num_vals": classes}}), *names)
        part = forest.getFeatureSubsetStrategy()
        if part == "auto":  # of one tree alone it would mean all
            part = "sqrt" if n > 1 else "all"
        trees = []
        with held(rows) as rows:
            some = rows.agg(*[F.max(c).alias(c) for c in names]).first()
            for i, c in enumerate(names):
                if some[c]:  # a tree without a row has no vote
                    own = {forest.numTrees: 1, forest.bootstrap: False, forest.subsamplingRate: 1.0, forest.weightCol: c,
                           forest.featureSubsetStrategy: part, forest.seed: forest.getSeed() + i}
                    tree = forest.copy(own).fit(rows.where(F.col(c) > 0))
                    trees.append(tree.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"_share{i}"))
        votes = Votes([t.getProbabilityCol() for t in trees], classes, forest.getPredictionCol())
        return PipelineModel([cutter, assembler, *trees, votes])


TASK_CELLS = 50_000  # merged rows of a task


def drawn(cells: DataFrame, by: Sequence[str], names: Sequence[str], rate: float, seed: int, parts: int = 256) -> DataFrame:
    """Cells with a column of Poisson numbers for each name, of mean ``rate`` for each row merged: the same however the cells are partitioned."""
    def draw(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(list(by))
        random = np.random.default_rng([seed, int(some["_part"].iloc[0])])
        return some.assign(**{n: random.poisson(some["_weight"] * rate).astype(float) for n in names})

    placed = cells.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))
    tasks = min(parts, cells.count() // TASK_CELLS + 1)  # a pass over few cells is all overhead of its tasks
    return placed.repartition(tasks, "_part").groupBy("_part").applyInPandas(draw, T.StructType([*placed.schema, *[T.StructField(n, T.DoubleType()) for n in names]]))


# -- estimators with the settings in use --------------------------------------------------
# Depth 10, rate 0.2, 200 rounds; hidden layers 16-8-4 and 8-8; penalty 1, five iterations.

def boosted_trees(depth: int = 10, rate: float = 0.2, rounds: int = 200, weight: str | None = None,
                  validation: str | None = None, seed: int = 2) -> GBTClassifier:
    """Binary boosted trees; ``validation`` names a boolean column for early stopping."""
    gbt = GBTClassifier(maxDepth=depth, stepSize=rate, maxIter=rounds, seed=seed)
    if weight:
        gbt.setWeightCol(weight)
    if validation:
        gbt.setParams(validationIndicatorCol=validation)
    return gbt


def boosted_classes(depth: int = 5, rate: float = 0.2, rounds: int = 20, parallelism: int = 4,
                    seed: int = 2) -> OneVsRest:
    """Boosted trees for more than two classes, one against the rest."""
    return OneVsRest(classifier=GBTClassifier(maxDepth=depth, stepSize=rate, maxIter=rounds, seed=seed),
                     parallelism=parallelism)


def perceptron(inputs: int, hidden: Sequence[int], classes: int, iterations: int = 100,
               seed: int = 2) -> MultilayerPerceptronClassifier:
    """Feed-forward classifier, such as hidden 16-8-4 for two classes or 8-8 for three."""
    return MultilayerPerceptronClassifier(layers=[inputs, *hidden, classes], maxIter=iterations, seed=seed)


class Logistic(LogisticRegression):
    """Logistic regression whose model is stored and loaded, which drops its training summary.

    The summary of a 0/1 label holds the session, and tasks get it with the model. A session in which anything was ever
    observed (``DataFrame.observe``) cannot be sent, so a model with its summary scores no row there.
    """

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        path = fresh_path(dataset.sparkSession, "logistic")
        super()._fit(dataset).save(path)
        return LogisticRegressionModel.load(path)


def weighted_logistic(weight: str, iterations: int = 100) -> Logistic:
    """For weighted classes, which the perceptron cannot take."""
    return Logistic(weightCol=weight, maxIter=iterations)


def lasso(penalty: float = 1.0, iterations: int = 5) -> LinearRegression:
    return LinearRegression(elasticNetParam=1.0, regParam=penalty, maxIter=iterations)


def tree_regressor(depth: int = 5, rounds: int = 20, seed: int = 2) -> GBTRegressor:
    return GBTRegressor(maxDepth=depth, maxIter=rounds, seed=seed)


def regression_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares with one feature, as an aggregate."""
    return df.groupBy(*by).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                               F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


# -- search ---------------------------------------------------------------------------------

def draw(space: Mapping[str, tuple], trials: int, seed: int = 2) -> list[dict]:
    """Trial settings from a space: ("log", lo, hi), ("int", lo, hi), ("choice", values)."""
    random = Random(seed)

    def one(kind, *args):
        if kind == "log":
            low, high = args
            return low * (high / low) ** random.random()
        if kind == "int":
            return random.randint(*args)
        if kind == "choice":
            return random.choice(list(args[0]))
        raise ValueError(f"unknown kind {kind}")

    return [{name: one(*spec) for name, spec in space.items()} for _ in range(trials)]


def search(train: DataFrame, validation: DataFrame, settings: Sequence[Mapping],
           build: Callable[[Mapping], Estimator], evaluator: Evaluator,
           parallelism: int = 4) -> tuple[DataFrame, Model]:
    """Fit every setting, ``parallelism`` at a time; a run log and the best model.

    The log is long: ``(run, step, kind, key, value)`` with text values of settings left out of
    ``value`` and put in ``text``. It has a few rows per trial.
    """
    larger, lock = evaluator.isLargerBetter(), Lock()
    best: list = [None, None]  # rank, model
    with held(train) as train, held(validation) as validation:
        def trial(i: int) -> float:
            model = build(settings[i]).fit(train)
            metric = float(evaluator.evaluate(model.transform(validation)))
            rank = (math.isnan(metric), -metric if larger else metric, i)
            with lock:  # the best so far is all that stays
                if best[0] is None or rank < best[0]:
                    best[:] = [rank, model]
            return metric

        with ThreadPool(parallelism) as pool:
            metrics = pool.map(trial, range(len(settings)), chunksize=1)
    return trial_log(train.sparkSession, list(zip(settings, metrics)), evaluator.getMetricName()), best[1]


def trial_log(spark: SparkSession, done: Sequence[tuple[Mapping, float]], metric_name: str) -> DataFrame:
    """``(run, step, kind, key, value, text)`` of trials: their settings and metric."""
    rows = []
    for i, (setting, metric) in enumerate(done):
        for key, value in setting.items():
            number = isinstance(value, (int, float))
            rows.append((f"trial-{i}", None, "param", key, float(value) if number else None,
                         None if number else str(value)))
        rows.append((f"trial-{i}", None, "metric", metric_name, float(metric), None))
    return spark.createDataFrame(rows, "run string, step long, kind string, key string, value double, text string")


def out_of_fold(df: DataFrame, key: Sequence[str], estimator: Estimator, k: int = 3,
                keep: Sequence[str] = ("label",), seed: str = "2", fast: bool = True) -> DataFrame:
    """Each row scored by a model that has not seen it."""
    parts = []
    with held(split.folds(df, k, key, seed=seed, fast=fast)) as folded:
        for i in range(k):
            model = estimator.fit(folded.where(F.col("fold") != i))
            scored = model.transform(folded.where(F.col("fold") == i))
            parts.append(cut(scored.select(*key, *keep, "fold", "prediction")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# -- text classes ---------------------------------------------------------------------------


@dataclass
class TextClasses:
    """Multinomial naive Bayes on TF-IDF: lookup tables, no vocabulary on the driver."""

    classes: list
    idf: DataFrame      # (term, df, idf)
    terms: DataFrame    # (term, l0, l1, ...) log probability per class
    priors: list[float]


def fit_text_classes(df: DataFrame, key: str, text: str, label: str, alpha: float = 1.0) -> TextClasses:
    """Fit by aggregation: any vocabulary size, no term left out. Rows without a label are not used."""
    df = df.where(F.col(label).isNotNull())
    sizes = df.groupBy(label).count().collect()  # a row per class
    per_class = sorted((r[0], r[1]) for r in sizes)
    classes = [c for c, _ in per_class]
    documents = sum(n for _, n in per_class)
    idf = cut(feat.inverse_frequency(df, text))
    weights = feat.tfidf(feat.term_counts(df, key, text, [label]), idf, key, written=True)
    sums = cut(weights.groupBy("term").agg(*[
        F.sum(F.when(F.col(label) == F.lit(c), F.col("weight")).otherwise(0.0)).alias(f"s{i}")
        for i, c in enumerate(classes)]))
    row = sums.agg(F.count("*").alias("v"), *[F.sum(f"s{i}").alias(f"t{i}") for i in range(len(classes))]).first()
    terms = sums.select("term", *[
        F.ln((F.col(f"s{i}") + alpha) / (row[f"t{i}"] + alpha * row["v"])).alias(f"l{i}")
        for i in range(len(classes))])
    return TextClasses(classes, idf, terms, [float(n) / documents for _, n in per_class])


def score_text_classes(model: TextClasses, df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, prediction)``; a text without a known word goes by the priors."""
    weights = feat.tfidf(feat.term_counts(df, key, text), model.idf, key, written=True)
    joined = lookup(weights, model.terms, ["term"], how="inner")
    n = range(len(model.classes))
    sums = joined.groupBy(key).agg(*[F.sum(F.col("weight") * F.col(f"l{i}")).alias(f"l{i}") for i in n])
    every = df.select(key).join(sums, key, "left")
    scores = [F.coalesce(f"l{i}", F.lit(0.0)) + F.ln(F.lit(model.priors[i])) for i in n]
    best = F.array_max(F.array(*[F.struct(s.alias("s"), F.lit(-i).alias("i")) for i, s in enumerate(scores)]))
    names = F.array(*[F.lit(c) for c in model.classes])
    return every.select(key, F.element_at(names, 1 - best["i"]).alias("prediction"))


# -- automatic choice -----------------------------------------------------------------------

def choose(train: DataFrame, validation: DataFrame, candidates: Mapping[str, Estimator],
           evaluator: Evaluator, parallelism: int = 2) -> tuple[DataFrame, Model]:
    """Fit several estimators and keep the best by one metric (area under PR, RMSE, ...)."""
    names = list(candidates)
    return search(train, validation, [{"model": n} for n in names],
                  lambda s: candidates[s["model"]], evaluator, parallelism)


def classifier_candidates(cols: Sequence[str], weight: str | None = None) -> dict[str, Estimator]:
    lr = Logistic(maxIter=50)
    gbt = GBTClassifier(maxDepth=4, maxIter=10, seed=2)
    if weight:
        lr.setWeightCol(weight)
        gbt.setWeightCol(weight)
    return {"logistic": scaled(cols, lr), "boosted": binned(cols, gbt)}


def regressor_candidates(cols: Sequence[str]) -> dict[str, Estimator]:
    return {"linear": scaled(cols, LinearRegression(maxIter=50)),
            "boosted": binned(cols, GBTRegressor(maxDepth=4, maxIter=10, seed=2))}
