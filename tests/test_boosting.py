"""Boosted trees from aggregated histograms against the same trees grown in one place."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmill.operators import boosting


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(3)
    a, b = rnd.integers(0, 12, 900), rnd.normal(size=900).round(2)
    y = (a >= 6).astype(int) + (b > 0.3) + rnd.integers(0, 2, 900) * (a == 3)
    data = [(i, float(p) if i % 50 else None, float(q), float(v), 1.0 + i % 3) for i, (p, q, v) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(data, "id int, a double, b double, y double, w double").repartition(4).cache()


def brute(table, edges, outputs, loss, depth, rate, rounds, penalty=1.0, least=1.0):
    """Margins after every round, with all rows at hand."""
    x = np.array([[-1 if r[c] is None else sum(r[c] >= e for e in es) for c, es in zip("ab", edges)] for r in table])
    y, w = np.array([r.y for r in table]), np.array([r.w for r in table])
    m = np.zeros((len(y), outputs))

    def grow(rows, g, h, level):
        value = -rate * g[rows].sum() / (h[rows].sum() + penalty)
        best = (1e-9, None)
        for f in range(2):
            for b in sorted(set(x[rows, f]))[:-1]:
                left = rows[x[rows, f] <= b]
                right = rows[x[rows, f] > b]
                if min(h[left].sum(), h[right].sum()) < least:
                    continue
                score = lambda s: g[s].sum() ** 2 / (h[s].sum() + penalty)
                gain = score(left) + score(right) - score(rows)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (left, right))
        if level == depth or best[1] is None:
            return [(rows, value)]
        return [leaf for side in best[1] for leaf in grow(side, g, h, level + 1)]

    for _ in range(rounds):
        if loss == "softmax":
            e = np.exp(m - m.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            g, h = p - (y[:, None] == np.arange(outputs)), p * (1 - p)
        elif loss == "logistic":
            p = 1 / (1 + np.exp(-m))
            g, h = p - y[:, None], p * (1 - p)
        else:
            g, h = m - y[:, None], np.ones_like(m)
        for k in range(outputs):
            for leaf, value in grow(np.arange(len(y)), g[:, k] * w, h[:, k] * w, 0):
                m[leaf, k] += value
    return m


def test_merged_rows_give_the_same_trees(rows):
    one, two = (boosting.fit(rows, "y", ["a", "b"], "squared", depth=2, rounds=2, bins=6, weight="w", merged=m) for m in (False, True))
    assert [(t.features, t.bins) for t in one.trees] == [(t.features, t.bins) for t in two.trees]
    assert np.allclose([t.values[-1] for t in one.trees], [t.values[-1] for t in two.trees])


@pytest.mark.parametrize("loss, outputs, label", [("softmax", 3, "least(y, 2.0D)"), ("logistic", 1, "double(y > 0.5)"), ("squared", 1, "y")])
def test_margins_equal_brute_force(rows, loss, outputs, label):
    df = rows.withColumn("y", F.expr(label))
    model = boosting.fit(df, "y", ["a", "b"], loss, outputs, depth=3, rate=0.4, rounds=4, bins=16, weight="w", track=True)
    got = boosting.margins(df, model).orderBy("id").collect()
    want = brute(got, model.edges, outputs, loss, 3, 0.4, 4)
    assert np.allclose([r.margins for r in got], want, atol=1e-9)
    assert len(model.trees) == 4 * outputs and [x["fitted"] for x in model.losses] == sorted((x["fitted"] for x in model.losses), reverse=True)
    right = boosting.predictions(df, model).where("abs(prediction - y) < 0.5").count()
    assert right > 0.8 * len(got)


def test_contributions_and_base_are_the_margin(rows):
    df = rows.withColumn("y", F.expr("least(y, 2.0D)")).withColumn("base_", F.lit(1))
    model = boosting.fit(df, "y", ["a", "b"], "softmax", 3, depth=3, rounds=3, bins=8)
    for k in range(3):
        got = boosting.margins(boosting.contributions(df, model, k), model).collect()
        assert all(math.isclose(r.by_a + r.by_b + r.base, r.margins[k], abs_tol=1e-9) for r in got)
        assert any(abs(r.by_a) > 0.01 for r in got) and any(abs(r.by_b) > 0.01 for r in got)


def test_boosting_ends_when_rows_held_out_gain_nothing(spark):
    df = spark.range(600).select((F.col("id") % 7).cast("double").alias("a"), (F.xxhash64("id") % 5).cast("double").alias("b"),
                                 F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("double").alias("y"), (F.col("id") % 3 == 0).alias("out"))
    model = boosting.fit(df, "y", ["a", "b"], depth=4, rounds=15, rate=0.9, least=0.1, held_out="out", patience=2)
    losses = [x["held_out"] for x in model.losses]
    assert len(losses) < 15 and len(model.trees) == int(np.argmin(losses)) + 1


def test_nothing_to_fit_and_unknown_losses(rows):
    with pytest.raises(ValueError):
        boosting.fit(rows.where("id < 0"), "y", ["a", "b"])
    with pytest.raises(ValueError):
        boosting.fit(rows, "y", ["a", "b"], "hinge")


def test_many_trees_are_walked_by_batches(spark):
    """The sum of the leaves as the trees say, missing values and trees of one leaf included; no tree is part of the plan."""
    trees = [boosting.Tree(i % 2, [[i % 2], [0, 1]], [[i % 3], [1, 0]], [[0.0], [0.5, 0.5], [float(i), -1.0, 2.0, i / 7]]) for i in range(60)]
    trees.append(boosting.Tree(1, [], [], [[0.25]]))
    model = boosting.Boosted("softmax", ["a", "b"], [[1.0, 2.0, 3.0], [5.0, 6.0]], 2, trees, [])
    table = [(None if i % 11 == 0 else i % 5 * 1.0, i % 7 + 1.0) for i in range(80)]
    scored = boosting.margins(spark.createDataFrame(table, "a double, b double"), model)
    assert len(scored._jdf.queryExecution().optimizedPlan().toString()) < 3000
    for r in scored.collect():
        x = [-1 if v is None else sum(v >= e for e in es) for v, es in zip((r.a, r.b), model.edges)]
        want = [0.0, 0.0]
        for t in trees:
            node = 0
            for f, b in zip(t.features, t.bins):
                node = node * 2 + (x[f[node]] > b[node])
            want[t.output] += t.values[-1][node]
        assert r.margins == want
