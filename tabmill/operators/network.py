"""Feed-forward networks by mini-batches: gradients as matrix products per task, added up by an aggregation.

Scaled rows are written once, one folder per mini-batch, so that a step reads its own batch only. A row's batch and the units it drops out follow from a hash
of its key: a fit gives the same weights, up to rounding, however the rows are partitioned and after any retry. The driver holds the weights and one sum of
gradients at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabmill.session import fresh_path

# Odd multipliers of a published 64-bit mixer, and the usual constants of Adam
MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
BETA1, BETA2, TINY = 0.9, 0.999, 1e-8
OWN = ("hidden", "dropout", "epochs", "rate")  # settings in which networks fitted together may differ


@dataclass
class Network:
    features: list[str]
    loss: str                      # "squared" or "logistic"
    layers: list[tuple[np.ndarray, np.ndarray]]
    mean: np.ndarray
    scale: np.ndarray
    label_mean: float = 0.0        # of a number; its deviation
    label_scale: float = 1.0
    history: list[dict[str, float]] = field(default_factory=list)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + STEP
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


def kept(keys: np.ndarray, units: int, step: int, layer: int, rate: float) -> np.ndarray:
    """1 / (1 - rate) for the units a row keeps in a step, 0 for those it drops, by the row's hash."""
    with np.errstate(over="ignore"):
        place = mixed(np.arange(units, dtype=np.uint64) + np.uint64(step * 64 + layer) * STEP)
        drawn = mixed(keys.view(np.uint64)[:, None] ^ place[None, :])
    return (drawn >= np.uint64(min(int(rate * 2.0 ** 64), 2 ** 64 - 1))) / (1 - rate)


def forward(layers: Sequence[tuple[np.ndarray, np.ndarray]], x: np.ndarray, masks: Sequence[np.ndarray | None] = ()) -> list[np.ndarray]:
    """Values of all layers, input first; the last one is linear, the others are cut off at 0."""
    values = [x]
    for i, (w, b) in enumerate(layers):
        z = values[-1] @ w + b
        if i + 1 < len(layers):
            z = np.maximum(z, 0.0)
            if i < len(masks) and masks[i] is not None:
                z = z * masks[i]
        values.append(z)
    return values


def gradients(layers: Sequence[tuple[np.ndarray, np.ndarray]], x: np.ndarray, y: np.ndarray, w: np.ndarray, masks: Sequence[np.ndarray | None],
              loss: str) -> list[np.ndarray]:
    """Sums over the rows of the gradients of every matrix and offset."""
    values = forward(layers, x, masks)
    out = values[-1][:, 0]
    back = (((1 / (1 + np.exp(-out)) if loss == "logistic" else out) - y) * w)[:, None]
    found: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        found[:0] = [values[i].T @ back, back.sum(axis=0)]
        if i:
            back = (back @ layers[i][0].T) * (values[i] > 0)
            if i - 1 < len(masks) and masks[i - 1] is not None:
                back = back * masks[i - 1]
    return found


def unpacked(flat: np.ndarray, like: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for w, b in like:
        out.append((flat[at:at + w.size].reshape(w.shape), flat[at + w.size:at + w.size + b.size]))
        at += w.size + b.size
    return out


def arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "key"))


def summed(rows: DataFrame, fn, size: int) -> np.ndarray:
    """Sum over all rows of ``fn(x, y, w, key)``, ``size`` numbers: per task in one array, then by number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        some = False
        for batch in batches:
            if batch.num_rows:
                total += fn(batch)
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    out = np.zeros(size)
    for r in rows.select("x", "y", "w", "key").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # a row per weight
        out[r["i"]] = r["v"]
    return out


def fit(df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], hidden: Sequence[int] = (16, 16), loss: str = "squared",
        dropout: Sequence[float] = (), epochs: int = 10, batches: int = 8, rate: float = 0.03, weight: str | None = None, seed: int = 2,
        judge: DataFrame | None = None) -> Network:
    """A network with cut-off hidden layers for a number (squared) or a 0/1 label (logistic).

    ``dropout`` is the share of units dropped after each hidden layer, none after those it does not name. ``weight`` multiplies a row's gradient.
    With ``judge`` every epoch ends with ``mse`` and ``mae`` (squared) or ``loss`` and ``accuracy`` over its rows, in ``history``. Rows with a missing
    number are left out; rows with one key share batch and dropped units; a constant feature says nothing. Tables without rows raise.
    """
    return fits(df, label, features, key, [{"hidden": hidden, "dropout": dropout, "epochs": epochs, "rate": rate}], loss, batches, weight, seed, judge)[0]


@dataclass
class Course:
    """A network on its way: its settings, weights and the running means of Adam."""

    net: Network
    hidden: Sequence[int] = (16, 16)
    dropout: Sequence[float] = ()
    epochs: int = 10
    rate: float = 0.03

    def begin(self, inputs: int, seed: int) -> None:
        random = np.random.default_rng(seed)
        sizes = [inputs, *self.hidden, 1]
        self.net.layers = [(random.normal(size=(a, b)) * np.sqrt(2 / a), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]
        self.flat = np.concatenate([v.ravel() for pair in self.net.layers for v in pair])
        self.first, self.second = np.zeros(len(self.flat)), np.zeros(len(self.flat))

    def advance(self, gradient: np.ndarray, step: int) -> None:
        self.first = BETA1 * self.first + (1 - BETA1) * gradient
        self.second = BETA2 * self.second + (1 - BETA2) * gradient ** 2
        self.flat = self.flat - self.rate * (self.first / (1 - BETA1 ** step)) / (np.sqrt(self.second / (1 - BETA2 ** step)) + TINY)
        self.net.layers = unpacked(self.flat, self.net.layers)


def fits(df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], settings: Sequence[Mapping], loss: str = "squared", batches: int = 8,
         weight: str | None = None, seed: int = 2, judge: DataFrame | None = None) -> list[Network]:
    """A network per setting (``hidden``, ``dropout``, ``epochs``, ``rate`` of ``fit``), each as if fitted alone.

    They share the written batches and go step by step together: one job a step reads its batch once, whatever the number of settings.
    """
    if loss not in ("squared", "logistic"):
        raise ValueError(f"no loss {loss}")
    features, p = list(features), len(features)
    shaped = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)] + [F.col(label).cast("double").alias("y")]
    own = (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w")
    hashed = F.xxhash64(F.lit(seed), *[F.col(c) for c in key]).alias("key")
    rows = df.select(*shaped, own, hashed).dropna()
    stats = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in [f"x{i}" for i in range(p)] + ["y"]
                                                for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]).first()
    if not stats["n"]:
        raise ValueError("no rows to fit")
    mean = np.array([stats[f"mean_x{i}"] for i in range(p)])
    scale = np.array([stats[f"dev_x{i}"] or 1.0 for i in range(p)])
    center, spread = (stats["mean_y"], stats["dev_y"] or 1.0) if loss == "squared" else (0.0, 1.0)

    def scaled(table: DataFrame) -> DataFrame:
        x = F.array(*[(F.col(f"x{i}") - float(mean[i])) / float(scale[i]) for i in range(p)])
        return table.select(x.alias("x"), ((F.col("y") - center) / spread).alias("y"), "w", "key", F.pmod("key", F.lit(batches)).cast("int").alias("batch"))

    path = fresh_path(df.sparkSession, "batches")
    scaled(rows).write.partitionBy("batch").parquet(path)
    held = df.sparkSession.read.parquet(path)
    judged = scaled(judge.select(*shaped, own, hashed).dropna()).persist() if judge is not None else None

    courses = [Course(Network(features, loss, [], mean, scale, center, spread), **s) for s in settings]
    for c in courses:
        c.begin(p, seed)
    step = 0
    for epoch in range(max((c.epochs for c in courses), default=0)):
        going = [c for c in courses if epoch < c.epochs]
        for b in range(batches):
            step += 1
            nets = [(c.net.layers, c.hidden, c.dropout) for c in going]

            def grade(batch: pa.RecordBatch, nets=nets, now=step) -> np.ndarray:
                x, y, w, keys = arrays(batch, p)
                found = []
                for layers, hidden, dropout in nets:
                    masks = [kept(keys, units, now, i, share) if share else None for i, (units, share) in enumerate(zip(hidden, dropout))]
                    found += [g.ravel() for g in gradients(layers, x, y, w, masks, loss)]
                return np.concatenate([*found, [w.sum()]])

            total = summed(held.where(F.col("batch") == b), grade, sum(len(c.flat) for c in going) + 1)
            if not total[-1]:
                continue  # no row fell into this batch
            at = 0
            for c in going:
                c.advance(total[at:at + len(c.flat)] / total[-1], step)
                at += len(c.flat)
        if judged is not None:
            nets = [c.net.layers for c in going]

            def judge_batch(batch: pa.RecordBatch, nets=nets) -> np.ndarray:
                x, y, w, _ = arrays(batch, p)
                found = [len(y)]
                for layers in nets:
                    out = forward(layers, x)[-1][:, 0]
                    if loss == "squared":
                        miss = (out - y) * spread
                        found += [(miss ** 2).sum(), np.abs(miss).sum()]
                    else:
                        found += [(np.logaddexp(0, out) - out * y).sum(), ((out > 0) == (y > 0.5)).sum()]
                return np.array(found, dtype=float)

            n, *sums = summed(judged, judge_batch, 1 + 2 * len(going))
            names = ("mse", "mae") if loss == "squared" else ("loss", "accuracy")
            for i, c in enumerate(going):
                c.net.history.append(dict(zip(names, (sums[2 * i] / n, sums[2 * i + 1] / n))) if n else {})
    if judged is not None:
        judged.unpersist()
    return [c.net for c in courses]


def predictions(df: DataFrame, net: Network, out: str = "prediction") -> DataFrame:
    """The predicted number, or the probability of 1; null where a feature is missing. Nothing is dropped out."""
    layers, p = net.layers, len(net.features)

    @F.pandas_udf("double")
    def predict(x):
        table = np.stack(x.to_numpy()).astype(float).reshape(-1, p) if len(x) else np.zeros((0, p))
        z = forward(layers, (table - net.mean) / net.scale)[-1][:, 0]
        return x.map(lambda _: 0.0) + (1 / (1 + np.exp(-z)) if net.loss == "logistic" else z * net.label_scale + net.label_mean)

    columns = [F.col(c).cast("double") for c in net.features]
    whole = columns[0].isNotNull()
    for c in columns[1:]:
        whole = whole & c.isNotNull()
    return df.withColumn(out, F.when(whole, predict(F.array(*[F.coalesce(c, F.lit(0.0)) for c in columns]))))


def grid(train: DataFrame, judge: DataFrame, label: str, features: Sequence[str], key: Sequence[str], settings: Sequence[Mapping], parallelism: int = 4,
         **fixed) -> DataFrame:
    """A run per setting (arguments of ``fit``): its parameters and ``mse`` and ``mae`` after every epoch, as ``(run, step, kind, key, value)``.

    Lists among the parameters are logged by their elements, ``hidden.0``, ``hidden.1``; the last epoch's metrics come again without a step.
    """
    whole = [{**fixed, **s} for s in settings]
    groups: list[tuple[dict, list[int]]] = []  # runs that differ in nothing but the network itself are fitted together
    for i, s in enumerate(whole):
        common = {k: v for k, v in s.items() if k not in OWN}
        found = next((runs for shared, runs in groups if shared == common), None)
        if found is None:
            groups.append((common, [i]))
        else:
            found.append(i)
    with ThreadPool(parallelism) as pool:
        nets = pool.map(lambda g: fits(train, label, features, key, [{k: v for k, v in whole[i].items() if k in OWN} for i in g[1]],
                                       judge=judge, **g[0]), groups)
    by_run = {i: net.history for (_, runs), fitted in zip(groups, nets) for i, net in zip(runs, fitted)}
    histories = [by_run[i] for i in range(len(settings))]
    log = []
    for i, (setting, history) in enumerate(zip(settings, histories)):
        for name, value in setting.items():
            parts = [(f"{name}.{j}", v) for j, v in enumerate(value)] if isinstance(value, (list, tuple)) else [(name, value)]
            log += [(f"run-{i}", None, "param", k, float(v)) for k, v in parts]
        log += [(f"run-{i}", epoch + 1, "metric", k, float(v)) for epoch, found in enumerate(history) for k, v in found.items()]
        log += [(f"run-{i}", None, "metric", k, float(v)) for k, v in (history[-1] if history else {}).items()]
    return train.sparkSession.createDataFrame(log, "run string, step long, kind string, key string, value double")
