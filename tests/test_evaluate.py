import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabmill.operators import evaluate


def test_confusion_in_given_order(spark):
    df = spark.createDataFrame([("b", "t"), ("b", "b"), ("e", "b"), ("zzz", "b"), ("t", None)], "y string, p string")
    got = sorted(map(tuple, evaluate.confusion(df, "y", "p", ["b", "t", "e"]).collect()))
    assert [(g[0], g[1], g[4]) for g in got] == [(0, 0, 1), (0, 1, 1), (0, 2, 0), (1, 0, 0), (1, 1, 0), (1, 2, 0),
                                                 (2, 0, 1), (2, 1, 0), (2, 2, 0)]


def scores(spark):
    return spark.range(3000).select(
        (F.pmod(F.xxhash64("id"), F.lit(7)) == 0).cast("double").alias("label"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200)) / 200.0).alias("p")).withColumn(
        "p", F.least(F.lit(0.995), F.col("p") + F.col("label") * 0.2))


def test_area_equals_the_evaluator(spark):
    df = scores(spark)
    ml = df.withColumn("v", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))
    want = BinaryClassificationEvaluator(rawPredictionCol="v", metricName="areaUnderPR", numBins=0).evaluate(ml)
    assert evaluate.area_under_pr(df, "label", "p").first()[0] == pytest.approx(want, abs=1e-12)


def test_area_without_positives(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.7)], "label int, p double")
    assert evaluate.area_under_pr(df, "label", "p").first()[0] == 0.0


def test_weighted_scores_equal_the_evaluator(spark):
    df = spark.range(2000).select((F.pmod(F.xxhash64("id"), F.lit(4))).cast("double").alias("label"),
                                  (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(3))).cast("double").alias("prediction"))
    got = evaluate.weighted_precision_recall(df, "label", "prediction").first()
    judge = lambda m: round(MulticlassClassificationEvaluator(metricName=m).evaluate(df), 5)
    assert (got.precision, got.recall) == (judge("weightedPrecision"), judge("weightedRecall"))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 2.0)], "y double, p double")
    got = evaluate.regression_metrics(df, "y", "p").first()
    assert (got.mse, got.mae, got.mape) == pytest.approx((5 / 3, 1.0, 50.0))
    assert got.rmse == pytest.approx(math.sqrt(5 / 3))
    assert got.r2 == pytest.approx(1 - 5 / (14 / 3))


def test_log_loss_is_finite(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, p double")
    assert df.agg(evaluate.cross_entropy("y", "p")).first()[0] == pytest.approx(-math.log(1e-7) / 2, rel=1e-3)


def test_gates(spark):
    metrics = spark.createDataFrame([("rmse", 19.9), ("auRoc", 0.95)], "metric string, value double")
    decide = lambda limits: evaluate.gate(metrics, limits).first().decision
    assert decide({"rmse": ("max", 20.0)}) == "true"
    assert decide({"rmse": ("max", 19.9)}) == "false"
    assert decide({"rmse": ("max", 20.0), "auRoc": ("min", 0.95)}) == "false"
    assert decide({"mape": ("max", 3.05)}) == "false"


def test_a_tie_goes_to_the_first(spark):
    metrics = spark.createDataFrame([("two", 1.0), ("one", 1.0), ("three", 2.0)], "model string, value double")
    assert evaluate.best_model(metrics, ["one", "two", "three"]).first().model == "one"
    assert evaluate.best_model(metrics, ["one", "two", "three"], False).first().model == "three"


def test_summary_with_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None), (4, None)], "a int, b double")
    got = {r.feature: r for r in evaluate.summary(df).collect()}
    assert (got["a"].n, got["a"].p25, got["a"].p50, got["a"].p75, got["a"].max) == (3, 1.5, 2.0, 3.0, 4.0)
    assert got["b"].n == 0 and got["b"].p50 is None


def test_nan_is_missing_in_a_summary(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "a double")
    row = evaluate.summary(df).first()
    assert (row.n, row["mean"], row.p50, row["max"]) == (2, 2.0, 2.0, 3.0)


def test_a_missing_metric_never_wins(spark):
    rows = spark.createDataFrame([("one", None), ("three", float("nan")), ("two", 1.0)], "model string, value double")
    assert [tuple(r) for r in evaluate.best_model(rows, ["one", "two", "three"]).collect()] == [("two", 1.0)]
    assert evaluate.best_model(rows.where("model <> 'two'"), ["one", "three"]).count() == 0


def test_unmatched_predictions_and_labels_are_kept(spark):
    predictions = spark.createDataFrame([(1, 0.5), (2, 0.7), (None, 0.1)], "k long, prediction double")
    truth = spark.createDataFrame([(1, 1.0), (3, 0.0), (None, 1.0)], "k long, label double")
    got = evaluate.pair_with_truth(predictions, truth, ["k"]).select("k", "prediction", "label", "status").collect()
    assert {tuple(r) for r in got} == {(1, 0.5, 1.0, "paired"), (2, 0.7, None, "unlabelled"), (None, 0.1, None, "unlabelled"),
                                       (3, None, 0.0, "unpredicted"), (None, None, 1.0, "unpredicted")}
    assert len(got) == 5
