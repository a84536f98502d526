"""Networks by mini-batches: gradients against differences, the same weights for any partitioning, known targets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.operators import network


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(5)
    a, b = rnd.normal(size=(2, 1200))
    y = 3 * a - 2 * b + 5 + rnd.normal(size=1200) * 0.3
    data = [(i, *map(float, r)) for i, r in enumerate(zip(a, b, y))] + [(9000, None, 1.0, 1.0), (9001, 1.0, 1.0, None)]
    return spark.createDataFrame(data, "id int, a double, b double, y double").cache()


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_gradients_equal_differences(loss):
    rnd = np.random.default_rng(1)
    layers = [(rnd.normal(size=s), rnd.normal(size=s[1])) for s in ((3, 4), (4, 5), (5, 1))]
    x, y, w = rnd.normal(size=(20, 3)), rnd.integers(0, 2, 20).astype(float), rnd.uniform(1, 3, 20)
    masks = [network.kept(np.arange(20), 4, 7, 0, 0.3), None]

    def total(flat):
        out = network.forward(network.unpacked(flat, layers), x, masks)[-1][:, 0]
        return (w * ((out - y) ** 2 / 2 if loss == "squared" else np.logaddexp(0, out) - out * y)).sum()

    flat = np.concatenate([v.ravel() for pair in layers for v in pair])
    found = np.concatenate([g.ravel() for g in network.gradients(layers, x, y, w, masks, loss)])
    tiny = np.eye(len(flat)) * 1e-6
    assert np.allclose(found, [(total(flat + t) - total(flat - t)) / 2e-6 for t in tiny], atol=1e-4)


def test_units_are_dropped_by_row_at_the_given_rate():
    masks = network.kept(np.arange(5000), 16, 3, 0, 0.2)
    assert abs((masks == 0).mean() - 0.2) < 0.01 and np.allclose(masks[masks > 0], 1.25)
    assert np.array_equal(masks[100:200], network.kept(np.arange(100, 200), 16, 3, 0, 0.2))
    assert not np.array_equal(masks, network.kept(np.arange(5000), 16, 4, 0, 0.2))


def test_weights_do_not_depend_on_the_partitioning(rows):
    fits = [network.fit(rows.repartition(n), "y", ["a", "b"], ["id"], (6,), dropout=[0.2], epochs=2, batches=3) for n in (1, 7)]
    for (w, b), (v, c) in zip(*(f.layers for f in fits)):
        assert np.allclose(w, v, atol=1e-9) and np.allclose(b, c, atol=1e-9)


def test_linear_target_comes_near_its_optimum(rows):
    net = network.fit(rows, "y", ["a", "b"], ["id"], (16,), epochs=10, batches=6, judge=rows)
    assert len(net.history) == 10 and net.history[-1]["mse"] < 2 * 0.3 ** 2
    told = network.predictions(rows, net)
    assert told.where("y is not null and a is not null").agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0] == pytest.approx(net.history[-1]["mse"])
    assert told.where("a is null").first().prediction is None


def test_row_weights_move_the_decision(rows):
    df = rows.withColumn("hit", (F.col("y") > 9).cast("int")).withColumn("w", F.when(F.col("y") > 9, 20.0).otherwise(1.0))
    share = []
    for weight in (None, "w"):
        net = network.fit(df, "hit", ["a", "b"], ["id"], (4,), "logistic", epochs=2, batches=4, weight=weight, judge=df)
        share.append(network.predictions(df, net).where("prediction > 0.5").count())
        assert set(net.history[-1]) == {"loss", "accuracy"}
    assert share[1] > share[0]
    with pytest.raises(ValueError):
        network.fit(df.where("id < 0"), "hit", ["a"], ["id"])


def test_networks_fitted_together_are_as_if_alone(spark):
    df = spark.range(600).select("id", (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    df = df.withColumn("y", 2 * F.col("a") - F.col("b"))
    settings = [{"hidden": [4], "epochs": 1}, {"hidden": [8, 4], "dropout": [0.2], "epochs": 3}]
    together = network.fits(df, "y", ["a", "b"], ["id"], settings, judge=df)
    for net, setting in zip(together, settings):
        alone = network.fit(df, "y", ["a", "b"], ["id"], judge=df, **setting)
        assert len(net.history) == setting["epochs"]
        for one, other in zip(net.history, alone.history):
            assert one == pytest.approx(other)
