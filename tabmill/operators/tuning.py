"""Search in batches: the trials after the first batch are drawn near the settings that did well.

A new setting is drawn from a kernel density over the better ones so far: one bump about each of them, in all parameters
at once, narrower the more there are, and one flat part over the whole space. Only ranks of metrics count. A batch sees
the results of whole batches, in the order of trials, so a search runs alike whichever fit ends first. What the driver
holds is settings and metrics, a row per trial, and the best model so far.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool
from random import Random
from threading import Lock

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame

from tabmill.operators.train import held, trial_log

BETTER = 0.15      # of the trials so far, at least one
WIDTH = 0.3        # of the bump about the only better setting, in shares of the range

Space = Mapping[str, tuple]


def _check(space: Space) -> None:
    for name, (kind, *rest) in space.items():
        if kind in ("log", "linear", "int"):
            low, high = rest
            if not low <= high or (kind == "log" and low <= 0):
                raise ValueError(f"{name}: no range")
        elif kind in ("choice", "discrete"):
            if not rest[0]:
                raise ValueError(f"{name}: no values")
        else:
            raise ValueError(f"{name}: unknown kind {kind}")


def _unit(spec: tuple, value) -> float:
    """Place of a number in its range, 0 to 1."""
    kind, *rest = spec
    if kind == "discrete":
        low, high = min(rest[0]), max(rest[0])
    else:
        low, high = rest
    if kind == "log":
        low, high, value = math.log(low), math.log(high), math.log(value)
    return (value - low) / (high - low) if high > low else 0.0


def _value(spec: tuple, unit: float):
    """The number at a place of the range; of whole or listed numbers the nearest."""
    kind, *rest = spec
    if kind == "discrete":
        return min(rest[0], key=lambda v: abs(_unit(spec, v) - unit))
    low, high = rest
    if kind == "log":
        return low * (high / low) ** unit
    at = low + (high - low) * unit
    return round(at) if kind == "int" else at


def _near(random: Random, spec: tuple, value, width: float):
    """A draw from the bump about a value; a bump is cut off at the ends of the range."""
    if spec[0] == "choice":
        return value if random.random() > width else random.choice(list(spec[1]))
    centre = _unit(spec, value)
    while True:  # a bump lies in the range by half or more of what is within two widths, so this ends soon
        unit = random.gauss(centre, width)
        if 0 <= unit <= 1:
            return _value(spec, unit)


def _anywhere(random: Random, spec: tuple):
    return random.choice(list(spec[1])) if spec[0] == "choice" else _value(spec, random.random())


def _one(random: Random, space: Space, better: Sequence[Mapping]) -> dict:
    """A draw from the kernel density of the better settings: one bump each, in all parameters at once, and a flat part."""
    at = random.randrange(len(better) + 1)
    if at == len(better):
        return {name: _anywhere(random, spec) for name, spec in space.items()}
    width = WIDTH / math.sqrt(len(better))  # narrower the more there is to go by
    return {name: _near(random, spec, better[at][name], width) for name, spec in space.items()}


def proposed(space: Space, done: Sequence[tuple[Mapping, float]], n: int, larger: bool, seed: int = 2) -> list[dict]:
    """Settings of the next ``n`` trials, given those done with their metrics (NaN: the worst there is)."""
    _check(space)
    random = Random(f"{seed}/{len(done)}")
    worst = -math.inf if larger else math.inf
    ranked = sorted(range(len(done)), key=lambda i: (
        -1 if larger else 1) * (worst if math.isnan(done[i][1]) else done[i][1]))  # equal metrics by trial
    better = [done[i][0] for i in ranked[:math.ceil(BETTER * len(done))]]
    return [_one(random, space, better) for _ in range(n)]


def batches(space: Space, measure: Callable[[list[dict]], Sequence[float]], trials: int, parallelism: int, larger: bool,
            seed: int = 2) -> list[tuple[dict, float, int]]:
    """All trials with their metric and batch; ``measure`` gives the metrics of a batch of settings."""
    done: list[tuple[dict, float, int]] = []
    while len(done) < trials:
        settings = proposed(space, [(s, m) for s, m, _ in done], min(parallelism, trials - len(done)), larger, seed)
        batch = done[-1][2] + 1 if done else 0
        done += [(s, float(m), batch) for s, m in zip(settings, measure(settings))]
    return done


def tune(train: DataFrame, validation: DataFrame, space: Space, build: Callable[[Mapping], Estimator],
         evaluator: Evaluator, trials: int = 16, parallelism: int = 4, seed: int = 2) -> tuple[DataFrame, Model]:
    """Fit ``trials`` settings of a space, ``parallelism`` at a time: the run log and the best model.

    A space maps a parameter to ("log", lo, hi), ("linear", lo, hi), ("int", lo, hi), ("discrete", numbers) or ("choice",
    values). The log is that of ``train.search`` with the batch of each trial as a parameter. Of equally good models the
    one of the first trial is kept. A metric of NaN is the worst.
    """
    larger, lock = evaluator.isLargerBetter(), Lock()
    best: list = [None, None]  # rank, model
    with held(train) as train, held(validation) as validation, ThreadPool(parallelism) as pool:
        first = [0]

        def measure(settings: list[dict]) -> list[float]:
            def fit(i: int) -> float:
                model = build(settings[i]).fit(train)
                metric = float(evaluator.evaluate(model.transform(validation)))
                rank = (math.isnan(metric), -metric if larger else metric, first[0] + i)
                with lock:
                    if best[0] is None or rank < best[0]:
                        best[:] = [rank, model]
                return metric

            metrics = pool.map(fit, range(len(settings)), chunksize=1)
            first[0] += len(settings)
            return metrics

        done = batches(space, measure, trials, parallelism, larger, seed)
    log = trial_log(train.sparkSession, [({"batch": b, **s}, m) for s, m, b in done], evaluator.getMetricName())
    return log, best[1]
