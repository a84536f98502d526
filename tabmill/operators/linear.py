"""Linear models with an L1 penalty, solved on sums.

Two aggregates give means, deviations and all cross products of the scaled columns, a matrix of features x features; every penalty is
then solved by coordinate descent on that matrix, so any number of trials reads the rows twice, and once more to judge them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class Moments:
    features: list[str]
    weight: float        # of all rows
    mean: np.ndarray
    scale: np.ndarray    # population deviations, 0 for a constant
    gram: np.ndarray     # mean products of the scaled features
    cross: np.ndarray    # and of these with the centred label
    label_mean: float


@dataclass
class LinearFit:
    penalty: float
    features: list[str]
    weights: np.ndarray  # of the features as they are
    intercept: float
    gap: float           # by how much the conditions of the optimum are missed at most

    def prediction(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.weights):
            out = out + F.col(c) * F.lit(float(w))
        return out


def moments(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> Moments:
    """Means, deviations and cross products; rows with a missing number, label or weight are left out. Tables without rows raise."""
    features, p = list(features), len(features)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"), w.alias("w")).dropna()
    names = [f"x{i}" for i in range(p)] + ["y"]
    sums = rows.agg(F.sum("w").alias("w"), *[F.sum(F.col(c) * F.col("w")).alias(c) for c in names],
                    *[F.min(c).alias(f"lo_{c}") for c in names], *[F.max(c).alias(f"hi_{c}") for c in names]).first()
    if not sums["w"]:
        raise ValueError("no rows to fit")
    total = sums["w"]
    mean = np.array([sums[c] / total for c in names])
    centred = [F.col(c) - F.lit(float(m)) for c, m in zip(names, mean)]
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    found = rows.agg(*[F.sum(centred[i] * centred[j] * F.col("w")).alias(f"s{i}_{j}") for i, j in pairs]).first()
    both = np.zeros((p + 1, p + 1))
    for i, j in pairs:
        both[i, j] = both[j, i] = found[f"s{i}_{j}"] / total
    scale = np.array([0.0 if sums[f"lo_{c}"] == sums[f"hi_{c}"] else np.sqrt(both[i, i]) for i, c in enumerate(names[:p])])
    by = np.where(scale > 0, scale, np.inf)
    return Moments(features, total, mean[:p], scale, both[:p, :p] / np.outer(by, by), both[:p, p] / by, float(mean[p]))


def lasso(m: Moments, penalty: float, sweeps: int = 10_000, tolerance: float = 1e-12) -> LinearFit:
    """Least mean squared error / 2 plus ``penalty`` times the sum of absolute weights of the scaled features.

    A constant feature has weight 0. ``gap`` is what the optimum's conditions lack: the gradient of a weight is the penalty with the weight's
    sign, or smaller than it where the weight is 0.
    """
    p = len(m.features)
    w = np.zeros(p)
    for _ in range(sweeps):
        before = w.copy()
        for j in range(p):
            if m.scale[j] > 0:
                left = m.cross[j] - m.gram[j] @ w + m.gram[j, j] * w[j]
                w[j] = np.sign(left) * max(abs(left) - penalty, 0.0) / m.gram[j, j]
        if np.abs(w - before).max(initial=0.0) <= tolerance:
            break
    gradient = m.cross - m.gram @ w
    missed = np.where(w != 0, np.abs(gradient - penalty * np.sign(w)), np.maximum(np.abs(gradient) - penalty, 0.0))
    weights = np.divide(w, m.scale, out=np.zeros(p), where=m.scale > 0)
    return LinearFit(penalty, m.features, weights, m.label_mean - float(weights @ m.mean), float(missed.max(initial=0.0)))


def lasso_trials(df: DataFrame, features: Sequence[str], label: str, penalties: Sequence[float], part: str, fit: str = "TRAIN",
                 judge: str = "VALIDATE") -> tuple[DataFrame, LinearFit | None]:
    """A model per penalty from the rows whose ``part`` is ``fit``, judged by squared error on those where it is ``judge``.

    The log ``(run, kind, key, value)`` has each trial's penalty, weights, intercept and ``mse``; the best model is the one with the least error,
    the first of equal ones. Rows with a missing number are left out of both; if nothing is left to judge, errors are null and there is no best.
    """
    solved = moments(df.where(F.col(part) == fit), features, label)
    fits = [lasso(solved, penalty) for penalty in penalties]
    rows = df.where(F.col(part) == judge).select(*features, label).dropna()
    errors = list(rows.agg(*[F.avg((F.col(label) - f.prediction()) ** 2).alias(f"e{i}") for i, f in enumerate(fits)]).first())
    log = []
    for i, (f, error) in enumerate(zip(fits, errors)):
        run = f"trial-{i}"
        log += [(run, "param", "penalty", float(f.penalty)), (run, "weight", "", float(f.intercept)), (run, "metric", "mse", error)]
        log += [(run, "weight", c, float(w)) for c, w in zip(f.features, f.weights)]
    known = [(e, i) for i, e in enumerate(errors) if e is not None]
    return df.sparkSession.createDataFrame(log, "run string, kind string, key string, value double"), fits[min(known)[1]] if known else None
