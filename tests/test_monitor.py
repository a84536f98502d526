import pytest
from pyspark.sql import functions as F

from tabmill.functions import hashing
from tabmill.operators import monitor

EDGES = {"score": [10.0, 20.0, 30.0], "reward": [1.0, 2.0, 3.0]}


@pytest.fixture(scope="module")
def serving(spark):
    return spark.range(20_000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(40))).cast("double").alias("score"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5))).cast("double").alias("reward"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("country"),
        F.concat(F.lit("l"), (F.col("id") % 3).cast("string")).alias("language"),
        F.timestamp_seconds(F.col("id") * 60).alias("ts"))


def shifted(df):
    """Half of the requests, by key, get irregular values and the language as country."""
    hit = hashing.in_fraction(0.5, "id")
    return df.withColumns({
        "score": F.when(hit, F.col("score") + 100_000).otherwise(F.col("score")),
        "reward": F.when(hit, F.col("reward") - 2000).otherwise(F.col("reward")),
        "country": F.when(hit, F.col("language")).otherwise(F.col("country"))})


def test_identical_tables_are_at_distance_zero(serving):
    rows = monitor.skew(serving, serving, EDGES, ["country"]).collect()
    assert len(rows) == 3 and all(r.distance == 0.0 for r in rows)


def test_a_shift_raises_anomalies_and_a_retrain(serving):
    found = monitor.with_limits(monitor.skew(serving, shifted(serving), EDGES, ["country", "language"]))
    counts = monitor.anomaly_counts(found, "RAW_FEATURE_SKEW")
    assert {r.feature: r.anomaly_count for r in counts.collect()} == {"score": 1, "reward": 1, "country": 1, "language": 0}
    assert monitor.retrain(counts, True).first().retrain is True
    assert monitor.retrain(counts, False).first().retrain is False
    assert monitor.retrain(counts, True, "language").first().retrain is False
    assert monitor.retrain(counts.where("false"), True).first().retrain is False


def test_own_limits(serving):
    far = monitor.skew(serving, shifted(serving), EDGES)
    assert monitor.with_limits(far, {"score": 5.0}).where("anomaly").select("feature").collect()[0][0] == "reward"


def test_disjoint_values_are_at_full_distance(spark):
    a, b = spark.createDataFrame([("x", 1.0)], "c string, score double"), spark.createDataFrame([("y", 99.0)], "c string, score double")
    rows = {r.feature: r.distance for r in monitor.skew(a, b, {"score": [50.0]}, ["c"]).collect()}
    assert rows == pytest.approx({"score": 0.6931471805599453, "c": 1.0})


def test_drift_finds_the_changed_window(serving):
    day = F.to_date("ts")
    changed = shifted(serving.where("ts >= '1970-01-05'")).unionByName(serving.where("ts < '1970-01-05'"))
    rows = monitor.with_limits(monitor.drift(changed, day, EDGES, ["country"]), default=0.1).collect()
    assert {str(r.window) for r in rows if r.anomaly} == {"1970-01-05"}
    assert "1970-01-01" not in {str(r.window) for r in rows}


def test_null_has_a_bin_of_its_own(spark):
    df = spark.createDataFrame([(None, None), (1.0, "")], "score double, c string")
    bins = {(r.feature, r.bin): r.n for r in monitor.histogram(df, {"score": [0.0]}, ["c"]).collect()}
    assert bins == {("score", "-1"): 1, ("score", "1"): 1, ("c", ""): 2}


def test_a_vanished_feature_is_as_far_as_can_be(spark):
    schema = "feature string, kind string, bin string, n long"
    known = spark.createDataFrame([("a", "category", "x", 5), ("b", "category", "y", 5)], schema)
    left = spark.createDataFrame([("a", "category", "x", 7)], schema)
    assert {r.feature: r.distance for r in monitor.compare(known, left).collect()} == {"a": 0.0, "b": 1.0}
