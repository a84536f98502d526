"""L1 models on sums: the conditions of the optimum, and least squares without a penalty."""

import numpy as np
import pytest

from tabmill.operators import linear


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(5)
    a, b = rnd.normal(size=(2, 400))
    c = a * 0.9 + rnd.normal(size=400) * 0.1
    y = 3 * a - 2 * b + 0.5 + rnd.normal(size=400) * 0.2
    data = [tuple(map(float, r)) + (1e6, "VALIDATE" if i % 5 == 0 else "TRAIN") for i, r in enumerate(zip(a, b, c, y))]
    data += [(None, 1.0, 1.0, 1.0, 1e6, "TRAIN"), (1.0, 1.0, 1.0, None, 1e6, "TRAIN"), (1.0, 1.0, 1.0, 9.0, 1e6, None)]
    return spark.createDataFrame(data, "a double, b double, c double, y double, same double, part string")


def test_conditions_of_the_optimum_hold(rows):
    found = linear.moments(rows.where("part = 'TRAIN'"), ["a", "b", "c", "same"], "y")
    assert found.weight == 320 and found.scale[3] == 0
    table = np.array([r[:4] for r in rows.where("part = 'TRAIN'").dropna().collect()], float)
    x = (table[:, :3] - table[:, :3].mean(0)) / table[:, :3].std(0)
    for penalty in (0.0, 0.1, 0.5, 2.0, 10.0):
        fit = linear.lasso(found, penalty)
        assert fit.gap < 1e-9 and fit.weights[3] == 0
        w = fit.weights[:3] * table[:, :3].std(0)
        gradient = x.T @ (table[:, 3] - table[:, 3].mean() - x @ w) / len(x)
        assert all(abs(g - penalty * np.sign(v)) < 1e-8 if v else abs(g) <= penalty + 1e-8 for g, v in zip(gradient, w))
    assert not linear.lasso(found, 10.0).weights.any()
    plain = np.linalg.lstsq(np.c_[table[:, :3], np.ones(len(table))], table[:, 3], rcond=None)[0]
    free = linear.lasso(found, 0.0)
    assert np.allclose([*free.weights[:3], free.intercept], plain, atol=1e-6)


def test_trials_are_judged_on_the_other_part(rows):
    log, best = linear.lasso_trials(rows, ["a", "b", "c", "same"], "y", [1.0, 0.001, 10.0], "part")
    mse = {r.run: r.value for r in log.collect() if r.key == "mse"}
    assert min(mse, key=mse.get) == "trial-1" and best.penalty == 0.001 and mse["trial-1"] < 0.06
    assert log.count() == 3 * 7
    _, none = linear.lasso_trials(rows, ["a"], "y", [1.0], "part", judge="TEST")
    assert none is None
    with pytest.raises(ValueError):
        linear.moments(rows.where("a > 99"), ["a"], "y")
