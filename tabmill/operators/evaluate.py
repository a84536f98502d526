"""Metrics, matrices and model gates. Rows are reduced by partial aggregation only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from tabmill.functions.order import quantiles_with, running_totals
from tabmill.operators.clean import NUMERIC, columns_of

# -- aggregates, for use in agg() with or without groups ---------------------------------


def accuracy(label: str, prediction: str) -> Column:
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def rmse(label: str, prediction: str) -> Column:
    return F.sqrt(mse(label, prediction))


def mse(label: str, prediction: str) -> Column:
    gap = F.col(label) - F.col(prediction)
    return F.avg(gap * gap)


def mae(label: str, prediction: str) -> Column:
    return F.avg(F.abs(F.col(label) - F.col(prediction)))


def rmsle(label: str, prediction: str) -> Column:
    gap = F.log1p(F.col(label)) - F.log1p(F.col(prediction))
    return F.sqrt(F.avg(gap * gap))


def mape(label: str, prediction: str) -> Column:
    """In percent; rows with label 0 have none."""
    y = F.nullif(F.col(label), F.lit(0.0))
    return F.avg(F.abs((y - F.col(prediction)) / y)) * 100


def r2(label: str, prediction: str) -> Column:
    spread = F.var_pop(label)
    return F.lit(1.0) - mse(label, prediction) / F.when(spread > 0, spread)


def cross_entropy(label: str, probability: str, eps: float = 1e-7) -> Column:
    """Binary, with the probability kept off 0 and 1."""
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(probability)))
    return -F.avg(F.col(label) * F.ln(p) + (1 - F.col(label)) * F.ln(1 - p))


def categorical_cross_entropy(label: str, probabilities: str, eps: float = 1e-7) -> Column:
    """Label is a class number, probabilities an array in class order."""
    p = F.element_at(probabilities, F.col(label).cast("int") + 1)
    return -F.avg(F.ln(F.greatest(F.lit(eps), F.least(F.lit(1 - eps), p))))


def threshold_counts(label: str, probability: str, at: float = 0.5) -> list[Column]:
    """Binary accuracy, false positives and false negatives."""
    said = F.col(probability) > at
    true = F.col(label) == 1
    return [F.avg((said == true).cast("double")).alias("binary_accuracy"),
            F.count_if(said & ~true).alias("false_positives"),
            F.count_if(~said & true).alias("false_negatives")]


REGRESSION = {"rmse": rmse, "mae": mae, "mse": mse, "rmsle": rmsle, "mape": mape, "r2": r2}


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (),
                       names: Mapping[str, str] | None = None) -> DataFrame:
    """All regression metrics in one pass; ``names`` maps metric to output column."""
    names = names or {m: m for m in REGRESSION}
    return df.groupBy(*by).agg(*[REGRESSION[m](label, prediction).alias(out)
                                 for m, out in names.items()])


# -- classification ----------------------------------------------------------------------

def confusion(df: DataFrame, label: str, prediction: str, labels: Sequence,
              by: str | None = None, by_values: Sequence = ()) -> DataFrame:
    """``(by, row, col, truth, predicted, n)`` in the order of ``labels``; rows are the truth.

    Cells nobody fell into are there with 0; values outside ``labels`` are not counted. With
    ``by`` there is a matrix for each of ``by_values``, all from one pass.
    """
    known = list(labels)
    kind = dict(df.dtypes)
    group = [by] if by else []
    counts = (df.where(F.col(label).isin(known) & F.col(prediction).isin(known))
              .groupBy(*group, F.col(label).alias("truth"), F.col(prediction).alias("predicted"))
              .agg(F.count("*").alias("n")))
    axis = F.array(*[F.lit(v) for v in known])
    grid = df.sparkSession.range(1)
    if by:
        grid = (grid.select(F.explode(F.array(*[F.lit(v) for v in by_values])).alias(by))
                .withColumn(by, F.col(by).cast(kind[by])))
    grid = (grid.select(*group, F.posexplode(axis).alias("row", "truth"))
            .select(*group, "row", "truth", F.posexplode(axis).alias("col", "predicted"))
            .withColumn("truth", F.col("truth").cast(kind[label]))
            .withColumn("predicted", F.col("predicted").cast(kind[prediction])))
    if by:
        counts = counts.where(F.col(by).isin(list(by_values)))
    # both sides have at most one row per cell
    return (grid.join(F.broadcast(counts), [*group, "truth", "predicted"], "left")
            .select(*group, "row", "col", "truth", "predicted",
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def weighted_precision_recall(df: DataFrame, label: str, prediction: str, digits: int = 5) -> DataFrame:
    """Precision and recall averaged by class support; a class never predicted counts as 0."""
    cells = df.groupBy(F.col(label).cast("string").alias("t"),
                       F.col(prediction).cast("string").alias("p")).agg(F.count("*").alias("n"))
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("t").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"),
                 hit.cast("long").alias("hit")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"),
                 F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("support", "said", "hit")])
    precision = F.when(F.col("said") > 0, F.col("hit") / F.nullif("said", F.lit(0))).otherwise(0.0)
    return per.agg(
        F.round(F.sum(precision * F.col("support")) / F.sum("support"), digits).alias("precision"),
        F.round(F.sum("hit") / F.sum("support"), digits).alias("recall"))


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score, highest first: cumulative counts, precision and recall."""
    hit = (F.col(label) == 1).cast("long")
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    curve = running_totals(per_score, [F.desc("score")], {"tp": "pos", "fp": "neg"})
    positives = curve.agg(F.max("tp")).scalar()  # from the written curve, not the scored rows
    return curve.select("*", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                        F.try_divide("tp", positives).alias("recall"))


def area_under_pr(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area over the exact curve, starting at recall 0 with the first precision."""
    curve = pr_curve(df, label, score)
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.col("precision"))
    step = F.col("recall") * F.try_divide("pos", "tp")  # recall gained at this score
    return curve.agg(F.sum(F.coalesce(step, F.lit(0.0)) * (F.col("precision") + before) / 2)
                     .alias("area_under_pr"))


# -- comparing and gating ------------------------------------------------------------------

def pair_with_truth(predictions: DataFrame, truth: DataFrame, key: Sequence[str]) -> DataFrame:
    """Predictions next to their labels, by row key: files have no order to rely on.

    No row is lost: ``status`` is "paired", "unlabelled" for a prediction without a label, "unpredicted" for a label without
    a prediction. A null key pairs with nothing. A key held by several rows of a side is paired with each.
    """
    left = predictions.withColumn("_p", F.lit(True))
    right = truth.withColumn("_t", F.lit(True))
    status = F.when(F.col("_t").isNull(), "unlabelled").when(F.col("_p").isNull(), "unpredicted").otherwise("paired")
    return left.join(right, list(key), "full").withColumn("status", status).drop("_p", "_t")


def gate(metrics: DataFrame, limits: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row, ``decision`` "true" or "false".

    ``metrics`` is ``(metric, value)``; ``limits`` maps a metric to ("max", x), value must be
    below x, or ("min", x), value must be above. A metric that is missing fails.
    """
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(side).alias("side"),
                              F.lit(float(x)).alias("limit")) for m, (side, x) in limits.items()])
    wanted = metrics.sparkSession.range(1).select(F.explode(rows).alias("w")).select("w.*")
    ok = F.when(F.col("side") == "max", F.col("value") < F.col("limit")).otherwise(
        F.col("value") > F.col("limit"))
    joined = wanted.join(metrics.where(F.col("metric").isin(list(limits))), "metric", "left")
    passed = F.bool_and(F.coalesce(ok, F.lit(False)))
    return joined.agg(F.when(passed, "true").otherwise("false").alias("decision"))


def best_model(metrics: DataFrame, order: Sequence[str], smaller_is_better: bool = True) -> DataFrame:
    """Best row of ``(model, value)``; the model named first in ``order`` wins a tie.

    A null or NaN value never wins; without any other value there is no best model.
    """
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    value = F.col("value") if smaller_is_better else -F.col("value")
    valid = metrics.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return valid.agg(F.min_by(F.struct("model", "value"), F.struct(value, rank)).alias("best")).where("best is not null").select("best.*")


# -- summaries ----------------------------------------------------------------------------

def shape(df: DataFrame) -> DataFrame:
    """Row and column counts as metrics."""
    return df.agg(F.count("*").alias("n_records")).withColumn("n_columns", F.lit(len(df.columns)))


def summary(df: DataFrame, cols: Sequence[str] | None = None,
            probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column: count, mean, sample deviation, min, exact interpolated quartiles, max.

    NaN counts as missing, like null. Two scans of ``df``, whatever the number of columns.
    """
    cols = columns_of(df, NUMERIC) if cols is None else list(cols)
    number = lambda c: F.col(c).cast("double")
    df = df.select(*[F.when(~F.isnan(number(c)), number(c)).alias(c) for c in cols])
    moments = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "n": F.count}
    quartiles, row = quantiles_with(df, cols, probs, {
        f"{name}_of_{i}": fn(F.col(c)) for name, fn in moments.items() for i, c in enumerate(cols)})
    names = [f"p{round(p * 100)}" for p in probs]
    rows = [(c, *[row[f"{m}_of_{i}"] for m in ("n", "mean", "std", "min")], *quartiles[c], row[f"max_of_{i}"])
            for i, c in enumerate(cols)]  # a row per column
    return df.sparkSession.createDataFrame(rows, ", ".join(
        ["feature string", "n long", *[f"{c} double" for c in ("mean", "std", "min", *names, "max")]]))


def feature_importance(model, names: Sequence[str], spark) -> DataFrame:
    """``(feature, importance)`` of a fitted tree model: one row per model input."""
    weights = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)],
                                 "feature string, importance double")


def contributions(df: DataFrame, model: LinearRegressionModel | LogisticRegressionModel,
                  features: Sequence[str]) -> DataFrame:
    """Per row what each feature adds to a linear model's margin, ``by_<feature>``: weight times value."""
    return df.withColumns({f"by_{f}": F.col(f) * F.lit(float(w)) for f, w in zip(features, model.coefficients)})
