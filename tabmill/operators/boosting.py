"""Gradient boosting as aggregates: histograms of gradients per node, trees grown from their sums.

Rows are cut into bins once and written. A round grows one tree per output, all outputs at a time: for each level one aggregation adds
up gradients and hessians per (output, node, feature, bin), map-side first, and the driver, which sees these sums only (outputs x nodes x features x bins),
picks the splits. After a round the margins are written again, so that a lost executor costs one round. Trees are plain data; scores and
contributions are expressions over them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabmill.operators.features import bin_of, exact_edges
from tabmill.session import cut

LOSSES = ("softmax", "logistic", "squared")
NEVER = -1  # feature of a node that is not split: all its rows go left, where the value stays


@dataclass
class Tree:
    """A whole binary tree by levels: node i has the children 2i and 2i + 1."""

    output: int
    features: list[list[int]]   # per level and node
    bins: list[list[int]]       # rows with a higher bin go right
    values: list[list[float]]   # per level, leaves included: what a row in the node gets, rate included


@dataclass
class Boosted:
    loss: str
    features: list[str]
    edges: list[list[float]]
    outputs: int
    trees: list[Tree]
    losses: list[dict[str, float]]  # per round if tracked, means over the rows that were fitted and those held out

    def binned(self) -> Column:
        return binned(self.features, self.edges)


def binned(features: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    return F.array(*[bin_of(F.col(c).cast("double"), e) for c, e in zip(features, edges)])


def numbers(values: Sequence, kind: str) -> Column:
    return F.lit(list(values)).cast(f"array<{kind}>")


def at(values: Column, place: Column) -> Column:
    """Value at a place counted from 0."""
    return F.element_at(values, (place + 1).cast("int"))


def levels_of(tree: Tree) -> Column:
    """The levels of a tree as an array of structs, children's values included."""
    return F.array(*[F.struct(numbers(f, "int").alias("feature"), numbers(b, "int").alias("bin"), numbers(v, "double").alias("value"),
                              numbers(w, "double").alias("below"))
                     for f, b, v, w in zip(tree.features, tree.bins, tree.values, tree.values[1:])])


def goes_right(x: Column, level: Column, node: Column) -> Column:
    feature = at(level["feature"], node)
    return F.when(feature >= 0, (at(x, feature) > at(level["bin"], node)).cast("int")).otherwise(F.lit(0))


def node_of(x: Column, tree: Tree) -> Column:
    """Node of the last level that a row of bins comes to."""
    if not tree.features:
        return F.lit(0)
    splits = F.array(*[F.struct(numbers(f, "int").alias("feature"), numbers(b, "int").alias("bin")) for f, b in zip(tree.features, tree.bins)])
    return F.reduce(splits, F.lit(0), lambda node, level: node * 2 + goes_right(x, level, node))


def with_derivatives(rows: DataFrame, loss: str) -> DataFrame:
    """Gradients ``g`` and hessians ``h`` of every output, times the weight, from margins ``m``, label ``y`` and weight ``w``."""
    first = at(F.col("m"), F.lit(0))
    if loss == "squared":
        return rows.withColumns({"g": F.array((first - F.col("y")) * F.col("w")), "h": F.array(F.col("w"))})
    if loss == "logistic":
        rows = rows.withColumn("p", F.array(1 / (1 + F.exp(-first))))
        hit = lambda k: F.col("y")
    else:
        rows = rows.withColumn("top", F.array_max("m")).withColumn("e", F.transform("m", lambda v: F.exp(v - F.col("top"))))
        rows = rows.withColumn("all", F.reduce("e", F.lit(0.0), lambda s, v: s + v)).withColumn("p", F.transform("e", lambda v: v / F.col("all")))
        hit = lambda k: (F.col("y") == k).cast("double")
    return rows.withColumns({"g": F.transform("p", lambda v, k: (v - hit(k)) * F.col("w")), "h": F.transform("p", lambda v: v * (1 - v) * F.col("w"))})


def loss_of(loss: str, margins: Column, label: Column) -> Column:
    first = at(margins, F.lit(0))
    if loss == "squared":
        return (first - label) * (first - label)
    if loss == "logistic":
        return F.greatest(first, F.lit(0.0)) - first * label + F.log1p(F.exp(-F.abs(first)))
    top = F.array_max(margins)
    return top + F.ln(F.reduce(margins, F.lit(0.0), lambda s, m: s + F.exp(m - top))) - at(margins, label)


@dataclass
class Split:
    feature: int = NEVER
    bin: int = 0
    sides: tuple = ()  # gradient and hessian of the left and of the right child


def best_split(sums: list[dict[int, tuple[float, float]]], penalty: float, least: float) -> Split:
    """Split of the greatest gain of a node; ``sums`` holds gradient and hessian by bin for each feature."""
    found, best = Split(), 1e-9
    for f, held in enumerate(sums):
        order = sorted(held)
        g, h = (np.cumsum([held[b][i] for b in order]) for i in (0, 1))
        left, right = h[:-1], h[-1] - h[:-1]
        gain = g[:-1] ** 2 / (left + penalty) + (g[-1] - g[:-1]) ** 2 / (right + penalty) - g[-1] ** 2 / (h[-1] + penalty)
        gain = np.where((left >= least) & (right >= least), gain, 0.0)
        if len(gain) and gain.max() > best * (1 + 1e-9):  # equal gains go to the feature named first
            i = int(gain.argmax())
            best, found = float(gain.max()), Split(f, order[i], ((g[i], h[i]), (g[-1] - g[i], h[-1] - h[i])))
    return found


def grow(tree: Tree, sums: dict[tuple[int, int], dict], features: int, rate: float, penalty: float, least: float) -> None:
    """One more level: splits from the sums by bin of each (node, feature), and the values of the children from those of the sides."""
    value = lambda g, h: -rate * g / (h + penalty)
    if not tree.values:
        root = sums[0, 0].values()
        tree.values.append([value(sum(v[0] for v in root), sum(v[1] for v in root))])
    splits = [best_split([sums[node, f] for f in range(features)], penalty, least) if (node, 0) in sums else Split()
              for node in range(len(tree.values[-1]))]
    tree.features.append([x.feature for x in splits])
    tree.bins.append([x.bin for x in splits])
    tree.values.append([value(*x.sides[i]) if x.sides else own for x, own in zip(splits, tree.values[-1]) for i in (0, 1)])


def fit(df: DataFrame, label: str, features: Sequence[str], loss: str = "logistic", outputs: int = 1, depth: int = 6, rate: float = 0.3,
        rounds: int = 20, penalty: float = 1.0, least: float = 1.0, bins: int = 32, weight: str | None = None,
        held_out: str | None = None, patience: int | None = None, track: bool = False, merged: bool = False) -> Boosted:
    """Boosted trees for classes 0 to ``outputs`` - 1 (softmax), a 0/1 label (logistic) or a number (squared).

    ``weight`` multiplies a row's gradients. Rows where ``held_out`` is true are not fitted; with ``patience`` boosting ends after so many
    rounds without a smaller mean loss on them, and the trees of the best round stay. ``track`` keeps the mean losses of every round, at the
    cost of one more pass. ``merged`` first adds up the weights of rows with equal bins and label, which are alike in every round: a shuffle
    that pays if there are few combinations. Rows without a label are not used; a missing
    value has a bin of its own below all others. ``least`` is the hessian a child must have. Empty tables raise.
    """
    if loss not in LOSSES:
        raise ValueError(f"no loss {loss}")
    features, outputs = list(features), outputs if loss == "softmax" else 1
    df = df.where(F.col(label).isNotNull())
    edges = [e for e in exact_edges(df, features, bins).values()]
    own = F.col(weight).cast("double") if weight else F.lit(1.0)
    out = F.coalesce(F.col(held_out).cast("boolean"), F.lit(False)) if held_out else F.lit(False)
    rows = df.select(binned(features, edges).alias("x"), F.col(label).cast("double").alias("y"), own.alias("w"), out.alias("out"))
    if merged:
        rows = rows.groupBy("x", "y", "out").agg(F.sum("w").alias("w"))
    base = ["x", "y", "w", "out", "m", "g", "h"]
    rows = cut(with_derivatives(rows.withColumn("m", numbers([0.0] * outputs, "double")), loss).select(*base))
    model, best, since = Boosted(loss, features, edges, outputs, [], []), None, 0
    x, y, m = F.col("x"), F.col("y"), F.col("m")
    for number in range(rounds):
        trees = [Tree(k, [], [], []) for k in range(outputs)]
        graded = rows.where("not out")
        for _ in range(depth):
            placed = graded.select("x", F.explode(F.array(*[
                F.struct(F.lit(k).alias("k"), node_of(x, t).alias("node"), at(F.col("g"), F.lit(k)).alias("g"), at(F.col("h"), F.lit(k)).alias("h"))
                for k, t in enumerate(trees)])).alias("s"))
            each = placed.select("s.*", F.posexplode("x").alias("f", "bin"))
            sums: list[dict] = [{} for _ in trees]
            for r in each.groupBy("k", "node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():  # outputs x nodes x features x bins
                sums[r["k"]].setdefault((r["node"], r["f"]), {})[r["bin"]] = (r["g"], r["h"])
            if not any(sums):
                raise ValueError("no rows to fit")
            for tree, own in zip(trees, sums):
                grow(tree, own, len(features), rate, penalty, least)
        model.trees += trees
        added = F.array(*[at(m, F.lit(k)) + at(numbers(t.values[-1], "double"), node_of(x, t)) for k, t in enumerate(trees)])
        rows = cut(with_derivatives(rows.withColumn("m", added), loss).select(*base))
        if not track and not patience:
            continue
        means = rows.groupBy("out").agg((F.sum(loss_of(loss, m, y) * F.col("w")) / F.sum("w")).alias("loss")).collect()
        model.losses.append({"held_out" if r["out"] else "fitted": r["loss"] for r in means})
        if patience and "held_out" in model.losses[-1]:
            now = model.losses[-1]["held_out"]
            best, since = ((now, number), 0) if best is None or now < best[0] else (best, since + 1)
            if since >= patience:
                break
    if patience and best is not None:
        model.trees = model.trees[:(best[1] + 1) * outputs]
    return model


def forest(trees: Sequence[Tree]) -> Column:
    return F.array(*[F.struct(F.lit(t.output).alias("output"), levels_of(t).alias("levels"), numbers(t.values[-1], "double").alias("leaves")) for t in trees])


def margins(df: DataFrame, model: Boosted, out: str = "margins") -> DataFrame:
    """Sum of the leaves per output; a tree is walked by whole batches of rows."""
    outputs = model.outputs
    trees = [(t.output, list(zip(t.features, t.bins)), t.values[-1]) for t in model.trees]  # plain lists: tasks need no module of ours

    @F.pandas_udf("array<double>")
    def walk(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack(columns)
            sums, row = np.zeros((len(x), outputs)), np.arange(len(x))
            for output, levels, leaves in trees:
                node = np.zeros(len(x), dtype=np.int64)
                for features, bins in levels:
                    feature = np.array(features)[node]
                    node = node * 2 + ((feature >= 0) & (x[row, feature] > np.array(bins)[node]))
                sums[:, output] += np.array(leaves)[node]
            yield pd.Series(list(sums))

    return df.withColumn(out, walk(*[bin_of(F.col(c).cast("double"), e) for c, e in zip(model.features, model.edges)]))


def predictions(df: DataFrame, model: Boosted) -> DataFrame:
    """``margins`` and ``prediction``: the likeliest class (the first of equal ones), 1 above a margin of 0, or the number."""
    scored, m = margins(df, model), F.col("margins")
    first = F.struct(F.lit(0).alias("place"), F.lit(-1).alias("class"), F.lit(float("-inf")).alias("top"))  # the margins are read once
    likeliest = F.reduce(m, first, lambda s, v: F.struct(
        (s["place"] + 1).alias("place"), F.when(v > s["top"], s["place"]).otherwise(s["class"]).alias("class"), F.greatest(v, s["top"]).alias("top")))
    pick = {"softmax": likeliest["class"].cast("double"), "logistic": (at(m, F.lit(0)) > 0).cast("double"),
            "squared": at(m, F.lit(0))}
    return scored.withColumn("prediction", pick[model.loss])


def contributions(df: DataFrame, model: Boosted, output: int = 0) -> DataFrame:
    """Per row what each feature adds to a margin, ``by_<feature>``, and ``base``; together they are the margin.

    On a row's way through a tree every split changes the value of the node it is in; the change is the split column's. ``base`` is what all
    rows start from, the values of the roots.
    """
    trees = [t for t in model.trees if t.output == output]
    count = len(model.features)
    zero = F.array_repeat(F.lit(0.0), count)
    add = lambda a, b: F.zip_with(a, b, lambda p, q: p + q)

    def way(tree: Column) -> Column:
        def step(s: Column, level: Column) -> Column:
            to = s["node"] * 2 + goes_right(F.col("_x"), level, s["node"])
            change = at(level["below"], to) - at(level["value"], s["node"])
            by = F.transform(s["by"], lambda v, i: F.when(at(level["feature"], s["node"]) == i, v + change).otherwise(v))
            return F.struct(to.alias("node"), by.alias("by"))

        return F.reduce(tree["levels"], F.struct(F.lit(0).alias("node"), zero.alias("by")), step)["by"]

    total = F.reduce(forest(trees), zero, lambda s, tree: add(s, way(tree))) if trees else zero
    base = sum(t.values[0][0] for t in trees)
    return df.withColumn("_x", model.binned()).withColumn("_by", total).select(
        *df.columns, *[at(F.col("_by"), F.lit(i)).alias(f"by_{c}") for i, c in enumerate(model.features)], F.lit(float(base)).alias("base"))
