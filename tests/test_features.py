import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabmill.functions.text import plain
from tabmill.operators import clean, features as feat


def test_label_codes_in_sorted_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v string")
    got = sorted(((r.v or "", r.v_code) for r in feat.label_encode(df, ["v"]).collect()))
    assert got == [("", None), ("a", 0), ("a", 0), ("b", 1), ("c", 2)]


def test_label_codes_of_many_values(spark):
    df = spark.range(20_000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"))
    codes = feat.label_codes(df.repartition(20), ["name"])
    assert codes.where(F.col("code") != F.substring("value", 2, 6).cast("long")).count() == 0
    assert codes.count() == 20_000


def test_vocabulary_slots(spark):
    train = spark.createDataFrame([("x",), ("y",), ("y",), ("w",)], "v string")
    vocab = feat.vocabulary(train, ["v"])
    assert {r["size"] for r in vocab.collect()} == {5}
    df = spark.createDataFrame([("y",), ("w",), ("x",), ("new",), ("",), (None,)], "v string")
    assert sorted((r.v or "", r.s) for r in feat.vocabulary_encode(df, "v", vocab, "s").collect()) == [
        ("", 0), ("", 0), ("new", 1), ("w", 3), ("x", 4), ("y", 2)]


def test_one_hot_names_columns_by_value(spark):
    df = spark.createDataFrame([(1, "USA"), (2, "Japan"), (3, None)], "id int, origin string")
    out = feat.one_hot(df)
    assert out.columns == ["id", "Japan", "USA"]
    assert sorted(map(tuple, out.collect())) == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]


@pytest.mark.parametrize("deviation, std", [("population", math.sqrt(2 / 3)), ("sample", 1.0)])
def test_three_deviations(spark, deviation, std):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, same double")
    got = sorted(map(tuple, feat.standardize(df, ["x", "same"], deviation=deviation).collect()))
    assert [g[0] for g in got] == pytest.approx([-1 / std, 0, 1 / std])
    assert [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_fitted_on_train_only(spark):
    train = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    rest = spark.createDataFrame([(100.0,), (None,)], "x double")
    assert [r.x for r in feat.standardize(rest, ["x"], train).collect()] == [99.0, None]
    assert [r.c for r in rest.select(clean.clip("x").alias("c")).collect()] == [5.0, None]


def test_scaler_model_survives_storage(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (5.0, "a")], "x double, c string")
    model = feat.feature_pipeline(df, auto=["x", "c"], label="y").fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    rows = lambda m: [r.features for r in m.transform(df).select("features").collect()]
    assert rows(again) == rows(model)
    assert isinstance(Pipeline(stages=[model]), Pipeline)


def test_the_label_is_no_feature(spark):
    df = spark.createDataFrame([(1.0, 0)], "x double, y int")
    with pytest.raises(ValueError):
        feat.feature_pipeline(df, numeric=["x"], auto=["y"], label="y")


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(0, "cat dog cat a"), (1, "Dog bird"), (2, "x y")], "id int, t string")
    got = {(r.id, r.term): r.weight for r in feat.tfidf(
        feat.term_counts(df, "id", "t"), feat.inverse_frequency(df, "t"), "id").collect()}
    cat, dog, bird = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1, math.log(4 / 2) + 1
    n0, n1 = math.hypot(cat, dog), math.hypot(dog, bird)
    assert got == pytest.approx({(0, "cat"): cat / n0, (0, "dog"): dog / n0, (1, "dog"): dog / n1, (1, "bird"): bird / n1})


def test_texts_move_once(spark):
    df = spark.createDataFrame([(0, "aa bb")], "id int, t string")
    plan = feat.term_counts(df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange") == 1


def test_parts_of_texts_grow_in_number_not_in_size(spark):
    df = spark.range(400).select("id", F.lit("aa bb cc dd " * 5).alias("t"))  # 60 bytes each
    assert feat.text_tasks(df, "t", 600) == 40
    assert feat.term_counts(df, "id", "t").count() == 1600
    assert feat.text_tasks(df.where("id < 0"), "t") == 1
    parted = spark.range(0, 3000, 1, 4).select("id", F.expr("repeat('aa bb ', 4000)").alias("t"))  # 72 MB in few bytes when packed
    assert feat.term_counts(parted, "id", "t").rdd.getNumPartitions() >= 5


def test_plain_text(spark):
    df = spark.createDataFrame([("It's 5 o'clock, «Élan»!",)], "t string")
    assert df.select(plain("t").alias("t")).first().t == "its 5 oclock «élan»"


def test_mutual_information(spark):
    df = spark.range(4000).select((F.col("id") % 2).alias("y"), (F.col("id") % 2 * 10.0).alias("same"),
                                  (F.col("id") % 1000 * 1.0).alias("other"), F.lit(None).cast("double").alias("void"))
    out = {r.feature: r for r in feat.mutual_information(
        df, "y", {"same": [5.0], "other": [500.0], "void": [0.0]}, None).collect()}
    assert out["same"].mi == pytest.approx(math.log(2)) and out["same"].ami == pytest.approx(1.0)
    assert abs(out["other"].ami) < 1e-3 and out["void"].mi == 0.0


def test_quantile_edges(spark):
    edges = feat.quantile_edges(spark.range(1001).select(F.col("id").cast("double").alias("x")), ["x"], 4)
    assert edges["x"] == pytest.approx([250.0, 500.0, 750.0], abs=1)


def test_weights_and_lags(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (1, 1)], "y int, t int")
    assert {r.y: r.weight for r in feat.class_weights(df, "y").collect()} == pytest.approx({0: 1 / 3, 1: 1.0})
    assert [r.w for r in feat.with_weights(df, "y", {0: 1, 1: 100}, "w").orderBy("y", "t").collect()] == [1, 1, 1, 100]
    out = feat.lags(df, "y", "t", ["t"], 2).where("y = 0").orderBy("t").collect()
    assert [(r.t_lag1, r.t_lag2) for r in out] == [(None, None), (1, None), (2, 1)]


def test_expected_information_equals_the_sum_over_all_counts(spark):
    margins = [(1, 1, 2), (3, 4, 9), (10, 10, 10), (50, 7, 60), (600, 500, 1000), (1, 999, 1000), (5, 5, 5000)]
    df = spark.createDataFrame(margins, "a long, b long, n long")
    fact = lambda x: math.lgamma(x + 1)
    for r in df.select("*", feat.expected_information(F.col("a"), F.col("b"), F.col("n")).alias("e")).collect():
        want = sum(k / r.n * math.log(r.n * k / (r.a * r.b)) * math.exp(
            fact(r.a) + fact(r.b) + fact(r.n - r.a) + fact(r.n - r.b) - fact(r.n) - fact(k) - fact(r.a - k) - fact(r.b - k)
            - fact(r.n - r.a - r.b + k)) for k in range(max(1, r.a + r.b - r.n), min(r.a, r.b) + 1))
        assert r.e == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_unrelated_feature_has_no_adjusted_information(spark):
    df = spark.range(4000).select((F.xxhash64("id") % 2).cast("int").alias("y"), F.xxhash64(F.col("id") + 9).cast("double").alias("noise"),
                                  F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.xxhash64("id") % 2).cast("double").alias("same"))
    edges = feat.exact_edges(df, ["noise", "same"])
    assert len(edges["noise"]) == 9 and len(edges["same"]) <= 3
    got = {r.feature: r.ami for r in feat.mutual_information(df, "y", edges).collect()}
    assert abs(got["noise"]) < 0.005 and got["same"] > 0.8


def test_edges_are_values_at_ranks(spark):
    df = spark.createDataFrame([(float(x), None) for x in range(100, 0, -1)] + [(None, None)], "x double, none double")
    assert feat.exact_edges(df, ["x", "none"], 4) == {"x": [26.0, 51.0, 76.0], "none": []}
