"""Whole flows: two models compared and gated, and monitoring that leads to retraining."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabmill.operators import evaluate, feature_store as store, monitor, score, split, train
from tabmill.plans.monitoring import EVENT_EDGES
from tabmill.plans.history import k_of
from tabmill.plans.prepare import LINE_KEY
from tabmill.plans.registry import query, table
from tabmill.plans.training import COLS, PRODUCT, labelled
from tabmill.session import cut


@query()
def two_model_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Split by content, fit a linear and an automatically chosen model, score both on TEST, pick
    the better by RMSE (the first on a tie) and gate it."""
    marked = cut(split.content_split(labelled(spark, sf, PRODUCT), [*LINE_KEY, "l_extendedprice"], fast=False))
    parts = split.given_split(marked, "split", ["TRAIN", "VALIDATE", "TEST"])
    with train.held(parts["TRAIN"]) as fit:
        linear = train.scaled(COLS, train.lasso(0.01, 5)).fit(fit)
    _, chosen = train.choose(parts["TRAIN"], parts["VALIDATE"], train.regressor_candidates(COLS),
                             RegressionEvaluator(metricName="rmse"))
    scored = None
    for name, model in (("linear", linear), ("automatic", chosen)):
        one = model.transform(parts["TEST"]).select(F.lit(name).alias("model"), "label", "prediction")
        scored = one if scored is None else scored.unionByName(one)
    metrics = scored.groupBy("model").agg(evaluate.rmse("label", "prediction").alias("value"))
    best = cut(evaluate.best_model(metrics, ["linear", "automatic"]))
    decision = evaluate.gate(best.select(F.lit("rmse").alias("metric"), "value"), {"rmse": ("max", 20.0)})
    return best.withColumn("decision", decision.scalar())


@query()
def retraining_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Daily drift of the events decides on retraining; a model is then trained on point-in-time
    features, gated by its accuracy, and gets 20 % of the requests if it passes."""
    events = table(spark, sf, "events").withColumn("k", k_of())
    watched = events.select(F.to_date("ts").alias("day"), "value", "k", "event_type")
    drifts = monitor.drift(watched, F.col("day"), EVENT_EDGES, ["event_type"])
    counts = monitor.anomaly_counts(monitor.with_limits(drifts), "PREDICTION_DRIFT")
    decision = monitor.retrain(counts, enabled=True).first()

    history = store.ingest(events.where("event_type <> 'purchase'"), "user_id",
                           {"value": ("value", "double"), "k": ("k", "double")}, "ts", "event_id")
    reads = events.where("event_type = 'purchase'").select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "ts", (F.col("value") > 10).cast("double").alias("label"))
    rows = cut(store.as_of(reads, history, "user_id", "ts").drop("ts", "feature_time").dropna("any"))
    side, passed = F.lit("current"), "false"
    if decision["retrain"]:
        marked = split.fractions(rows, ["event_id"], (0.8, 0.2), ("train", "test"), fast=False)
        with train.held(marked.where("split = 'train'")) as fit:
            model = train.scaled(["value", "k"], train.Logistic(maxIter=20)).fit(fit)
        tested = model.transform(marked.where("split = 'test'"))
        metric = tested.agg(evaluate.accuracy("label", "prediction").alias("value")).select(
            F.lit("accuracy").alias("metric"), "value")
        passed = evaluate.gate(metric, {"accuracy": ("min", 0.5)}).first()["decision"]
        side = score.route(["event_id"], has_current=True, fast=False) if passed == "true" else side
    requests = table(spark, sf, "events").groupBy(side.alias("side")).agg(F.count("*").alias("requests"))
    return requests.select("side", "requests", F.lit(int(decision["anomaly_count"])).cast("long").alias("anomalies"),
                           F.lit(passed).alias("gate"))
