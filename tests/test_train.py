import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation, functions as F

from tabmill.operators import evaluate, features as feat, runs, score, split, train
from tabmill.plans import all_queries

QUERIES, _ = all_queries()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    uniform = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000.0
    return spark.range(4000).select("id", uniform(1).alias("a"), uniform(2).alias("b")).withColumn(
        "label", (F.col("a") * F.col("b") > 0.45).cast("double")).cache()


def parts(df):
    marked = split.head_tail(df, ["id"])
    return marked.where("split = 'train'"), marked.where("split = 'test'")


@pytest.mark.parametrize("name", ["gbt_scores", "multiclass_scores", "mlp_scores", "mlp_three_classes"])
def test_a_trained_model_beats_the_majority(spark, name):
    scored = QUERIES[name](spark, SF).select("label", "prediction").cache()
    most = scored.groupBy("label").count().agg(F.max("count")).first()[0] / scored.count()
    assert scored.agg(evaluate.accuracy("label", "prediction")).first()[0] >= most


def test_regression_explains_the_target(spark):
    scored = QUERIES["regressor_scores"](spark, SF)
    assert evaluate.regression_metrics(scored, "label", "prediction").first().r2 > 0.8


def test_out_of_fold_covers_each_key_once(rows):
    oof = train.out_of_fold(rows, ["id"], train.plain(["a", "b"], DecisionTreeClassifier(maxDepth=4, seed=2)))
    assert oof.count() == 4000 and oof.select("id").distinct().count() == 4000
    assert oof.agg(evaluate.accuracy("label", "prediction")).first()[0] > 0.9


def test_a_stored_model_scores_the_same(spark, rows, tmp_path):
    fit, rest = parts(rows)
    model = Pipeline(stages=[feat.feature_pipeline(fit, auto=["a", "b"], label="label"), LogisticRegression()]).fit(fit)
    path = str(tmp_path / "model")
    model.save(path)
    again = score.score_with(path, rest, ["id"])
    direct = model.transform(rest).select("id", "prediction", vector_to_array("probability").alias("scores"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, direct.collect()))
    folder = score.write_predictions(again, str(tmp_path), "m")
    assert spark.read.json(folder).count() == rest.count()
    with pytest.raises(Exception):
        from datetime import datetime
        at = datetime(2024, 1, 1)
        for _ in range(2):
            score.write_predictions(again, str(tmp_path), "m", at)


def test_one_row_scores_as_it_should(spark, rows):
    """A single instance, as a smoke check of a stored linear score."""
    one = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    assert one.select(score.linear_score({"a": 0.5, "b": -1.0}, 1.0).alias("s")).first().s == -1.0


def test_search_keeps_the_best(rows):
    fit, rest = parts(rows)
    judge = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0)
    log, best = train.search(fit, rest, [{"depth": 1}, {"depth": 5}], lambda s: train.plain(
        ["a", "b"], train.boosted_trees(depth=s["depth"], rounds=3)), judge)
    values = {r.run: r.value for r in log.where("kind = 'metric'").collect()}
    assert judge.evaluate(best.transform(rest)) == pytest.approx(max(values.values()))
    assert log.where("kind = 'param'").count() == 2


def test_automatic_choice(rows):
    fit, rest = parts(rows.withColumn("y", F.col("a") * 3 + F.col("b")).drop("label").withColumnRenamed("y", "label"))
    log, best = train.choose(fit, rest, train.regressor_candidates(["a", "b"]), RegressionEvaluator(metricName="rmse"))
    by_text = {r.run: r.text for r in log.where("key = 'model'").collect()}
    low = log.where("kind = 'metric'").orderBy("value").first().run
    assert by_text[low] == "linear" and best.transform(rest).count() == rest.count()


def test_draws_repeat(spark):
    space = {"rate": ("log", 0.001, 1.0), "units": ("int", 64, 256), "layers": ("choice", [1, 2])}
    drawn = train.draw(space, 16)
    assert drawn == train.draw(space, 16) and len(drawn) == 16
    assert all(0.001 <= d["rate"] <= 1 and 64 <= d["units"] <= 256 and d["layers"] in (1, 2) for d in drawn)


def test_routing(spark):
    df = spark.range(10_000).select("id", score.route(["id"]).alias("side"))
    assert abs(df.where("side = 'new'").count() - 2000) < 200
    assert spark.range(5).where(score.route(["id"], has_current=False) == "new").count() == 5


def test_text_classes_without_a_known_word(spark):
    fit = spark.createDataFrame([(0, "red apple", "f"), (1, "green apple pear", "f"), (2, "fast car", "v")],
                                "id int, t string, y string")
    model = train.fit_text_classes(fit, "id", "t", "y")
    rest = spark.createDataFrame([(9, "an apple"), (10, "car"), (11, "unheard of"), (12, "")], "id int, t string")
    assert {r.id: r.prediction for r in train.score_text_classes(model, rest, "id", "t").collect()} == {
        9: "f", 10: "v", 11: "f", 12: "f"}


def test_logistic_models_score_in_a_session_that_has_observed(spark):
    session = spark.newSession()
    seen = Observation()
    session.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    df = session.range(200).select("id", (F.col("id") / 200).alias("a"), (F.col("id") > 90).cast("double").alias("label"), F.lit(1.0).alias("w"))
    log, best = train.choose(df, df, train.classifier_candidates(["a"]), BinaryClassificationEvaluator(metricName="areaUnderPR"))
    assert log.where("kind = 'metric'").count() == 2
    model = train.scaled(["a"], train.weighted_logistic("w")).fit(df)
    assert model.transform(df).where("label <> prediction").count() == 0


def test_lineage_leaves_the_session_fit_for_plain_models(spark):
    session = spark.newSession()
    edges = session.createDataFrame([("e", "input", "x"), ("e", "output", "y")], "execution string, direction string, artifact string")
    assert runs.upstream(edges, session.createDataFrame([("y",)], "node string")).count() == 3
    df = session.range(200).select((F.col("id") / 200).alias("a"), (F.col("id") > 90).cast("double").alias("label"))
    assert train.plain(["a"], LogisticRegression()).fit(df).transform(df).where("label <> prediction").count() == 0


def many(spark, n=3000):
    """Rows with a column of more values than bins, and a label no tree reaches."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(n, numPartitions=4).select(
        "id", (F.col("id") % 50).cast("double").alias("a"), noise.alias("b"), F.lit(3.0).alias("c"),
        ((F.col("id") % 50 > 20) & (noise > 0.4) | (noise > 0.9)).cast("double").alias("label"),
        (F.pmod("id", F.lit(3)) + 1).cast("double").alias("weight"), (F.col("id") % 5 == 0).alias("held_out"))


@pytest.mark.parametrize("trees, label", [
    (lambda: train.boosted_trees(depth=3, rounds=3, weight="weight"), "label"),
    (lambda: train.boosted_trees(depth=3, rounds=3, validation="held_out"), "label"),
    (lambda: train.boosted_classes(depth=2, rounds=2), "a % 3"),
    (lambda: train.tree_regressor(depth=3, rounds=4), "a * b"),
])
def test_trees_on_merged_rows_are_the_same(spark, trees, label):
    df = many(spark).withColumn("label", F.expr(label)).cache()
    told = [build(["a", "b", "c"], trees()).fit(df).transform(df).select("id", F.round("prediction", 9).alias("p"))
            for build in (train.plain, train.binned)]
    assert told[0].exceptAll(told[1]).count() == 0


def test_merged_rows_do_not_grow_with_the_table(spark):
    cells = train.Cells()
    gbt = train.boosted_trees(depth=2, rounds=1).setMaxBins(8)
    df = many(spark, 20_000)
    for _ in range(2):
        train.binned(["a", "b"], gbt, cells).fit(df)
    [(_, merged)] = cells.done.values()  # the second fit merges nothing
    assert merged.count() <= 8 * 8 * 2
    assert merged.agg(F.sum("_weight")).first()[0] == 20_000


def test_rows_drawn_at_random_are_not_merged(spark):
    for trees in (RandomForestClassifier(), train.boosted_trees().setSubsamplingRate(0.5), train.boosted_trees().setMinInstancesPerNode(2)):
        with pytest.raises(ValueError):
            train.binned(["a"], trees)


def test_a_bound_itself_goes_left(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "a double, label double")
    model = train.binned(["a"], train.boosted_trees(depth=1, rounds=1)).fit(df)
    rows = spark.createDataFrame([(0.5,), (0.50001,)], "a double")
    assert [r[0] for r in model.transform(rows).orderBy("a").select("prediction").collect()] == [0.0, 1.0]


@pytest.mark.parametrize("rate", [1.0, 0.3])
def test_forests_on_merged_rows_learn_as_well(spark, rate):
    df = many(spark).withColumn("label", F.expr("cast(a > 20 as double) + cast(b > 0.5 as double)")).cache()
    forest = lambda: RandomForestClassifier(maxDepth=4, maxBins=16, subsamplingRate=rate, numTrees=15, seed=2)
    right = [build(["a", "b", "c"], forest()).fit(df).transform(df).where("label = prediction").count() / df.count()
             for build in (train.plain, train.BinnedForest)]
    assert min(right) > 0.95


def test_forests_on_merged_rows_repeat_and_do_not_grow(spark):
    forest = lambda: RandomForestClassifier(maxDepth=3, maxBins=8, subsamplingRate=0.4, numTrees=3, seed=2)
    df = many(spark, 20_000)
    cells = train.Cells()
    told = [train.BinnedForest(["a", "b"], forest(), cells).fit(rows).transform(df).select("id", "prediction") for rows in (df, df.repartition(3))]
    assert told[0].exceptAll(told[1]).count() == 0
    [(cutter, merged)] = cells.done.values()
    assert merged.count() <= 8 * 8 * 2
    by = [*cutter.getOutputCols(), "label"]
    one, two = (train.drawn(merged.repartition(n), by, ["x", "y"], 0.4, 2) for n in (1, 5))
    assert one.exceptAll(two).count() == 0
    x, y = one.agg(F.sum("x"), F.sum("y")).first()  # mean 8,000, deviation 89
    assert x != y and all(abs(v - 8000) < 500 for v in (x, y))


def test_forests_that_weigh_or_count_rows_are_not_merged(spark):
    for forest in (RandomForestClassifier(bootstrap=False), RandomForestClassifier(minInstancesPerNode=2), RandomForestClassifier(weightCol="w")):
        with pytest.raises(ValueError):
            train.BinnedForest(["a"], forest)
