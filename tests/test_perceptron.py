import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.operators import perceptron, train


def test_minimum_of_a_curved_valley():
    def valley(x):
        a, b = x
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert np.allclose(perceptron.minimum(valley, np.array([-1.2, 1.0]), 100, 1e-12), [1, 1], atol=1e-5)


def test_gradient_is_the_slope_of_the_loss():
    random = np.random.default_rng(1)
    x, y, w = random.normal(size=(3, 50)), random.integers(0, 3, 50), random.integers(1, 5, 50).astype(float)
    layers = [3, 5, 4, 3]
    flat = random.normal(size=sum(a * b + b for a, b in zip(layers, layers[1:])))
    found = perceptron.loss_and_gradient(perceptron.unpacked(flat, layers), x, y, w)[1:]
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (perceptron.loss_and_gradient(perceptron.unpacked(flat + s, layers), x, y, w)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - found[i]) < 1e-4 * max(1, abs(found[i]))


def flags(spark, n, parts):
    own = F.col("id")
    return spark.range(0, n, 1, parts).select(
        (own % 2).cast("double").alias("a"), (F.floor(own / 2) % 2).cast("double").alias("b"),
        F.when(own % 7 == 0, 2.0).otherwise((own % 2).cast("double")).alias("label"))


def weights(model):
    return np.array(model.stages[-1].weights.toArray())


def test_weights_are_those_of_the_library(spark):
    df = flags(spark, 120, 1)  # one block of the library's, whose mean over blocks is then that over rows
    spec = train.perceptron(2, (4,), 3, 8)
    ours, theirs = perceptron.Perceptron(["a", "b"], spec).fit(df), train.scaled(["a", "b"], spec).fit(df)
    assert np.allclose(weights(ours), weights(theirs), rtol=1e-6)
    both = [[r[0] for r in m.transform(df).select("prediction").collect()] for m in (ours, theirs)]
    assert both[0] == both[1]


def test_rows_count_alike_however_they_are_partitioned_or_merged(spark):
    spec = train.perceptron(2, (4,), 3, 8)
    one = weights(perceptron.Perceptron(["a", "b"], spec).fit(flags(spark, 3000, 1)))
    assert np.allclose(weights(perceptron.Perceptron(["a", "b"], spec).fit(flags(spark, 3000, 7))), one, rtol=1e-6)
    with perceptron.Blocks(merged=True) as blocks:
        _, held, number = blocks.of(flags(spark, 3000, 7), ["a", "b"], "label", 3)
        assert number == 3000
        cells = sum(len(r["block"]) // (4 * 8) for r in held.collect())
        assert cells == 8  # four pairs of flags, two labels each
        assert np.allclose(weights(perceptron.Perceptron(["a", "b"], spec, blocks).fit(flags(spark, 3000, 7))), one, rtol=1e-6)


@pytest.mark.parametrize("feature, label", [(None, 0.0), (1.0, None), (1.0, 2.0), (1.0, 0.5), (1.0, -1.0)])
def test_missing_features_and_labels_that_are_no_class_raise(spark, feature, label):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (feature, label)], "a double, label double")
    with pytest.raises(Exception):
        perceptron.Perceptron(["a"], train.perceptron(1, (2,), 2, 3)).fit(df)


def test_no_rows_raise(spark):
    with pytest.raises(ValueError, match="no rows"):
        perceptron.Perceptron(["a"], train.perceptron(1, (2,), 2, 3)).fit(spark.createDataFrame([], "a double, label double"))
