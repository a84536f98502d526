"""Skew and drift of feature distributions, anomaly counts and the retrain decision.

A distribution is a frame ``(keys..., feature, bin, n)``. It is counted map-side, so what is
shuffled is bins, not rows. Numbers are compared by Jensen-Shannon divergence on shared bins,
categories by the largest difference of shares.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabmill.functions.distance import jensen_shannon, largest_difference
from tabmill.operators.features import bin_of

DEFAULT_LIMIT = 0.001  # fixed value: the limit used for every feature unless one is given


def histogram(df: DataFrame, edges: Mapping[str, Sequence[float]], categories: Sequence[str] = (),
              by: Sequence[Column] = ()) -> DataFrame:
    """Counts per feature and bin, numeric features on given edges, for each ``by`` key."""
    each = [F.struct(F.lit(c).alias("feature"), F.lit("number").alias("kind"),
                     bin_of(c, e).cast("string").alias("bin")) for c, e in edges.items()]
    each += [F.struct(F.lit(c).alias("feature"), F.lit("category").alias("kind"),
                      F.coalesce(F.col(c).cast("string"), F.lit("")).alias("bin")) for c in categories]
    names = [f"k{i}" for i in range(len(by))]
    return (df.select(*[b.alias(n) for n, b in zip(names, by)], F.explode(F.array(*each)).alias("f"))
            .groupBy(*names, "f.feature", "f.kind", "f.bin").agg(F.count("*").alias("n")))


def compare(baseline: DataFrame, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distance per feature between two histograms: ``(by..., feature, kind, distance)``.

    A feature that one side has no rows of is as far away as can be: its distance is 1. With ``by``,
    nothing is said about a group that one side has no rows of at all, such as the day before the first.
    """
    sides = baseline.select(*by, "feature", "kind", "bin", F.col("n").alias("b"), F.lit(0).cast("long").alias("c")
                            ).unionByName(
        current.select(*by, "feature", "kind", "bin", F.lit(0).cast("long").alias("b"), F.col("n").alias("c")))
    bins = sides.groupBy(*by, "feature", "kind", "bin").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    # totals join back instead of a window: a category may have very many bins
    sizes = bins.groupBy(*by, "feature").agg(F.sum("b").alias("tb"), F.sum("c").alias("tc"))
    if by:
        whole = sizes.groupBy(*by).agg(F.sum("tb").alias("wb"), F.sum("tc").alias("wc")).where("wb > 0 and wc > 0")
        sizes = sizes.join(whole.drop("wb", "wc"), list(by))
    both = bins.join(F.broadcast(sizes) if not by else sizes, [*by, "feature"])  # without by, a row per feature
    p, q = (F.coalesce(F.try_divide(n, t), F.lit(0.0)) for n, t in (("b", "tb"), ("c", "tc")))
    return both.groupBy(*by, "feature", "kind").agg(
        jensen_shannon(p, q).alias("_js"), largest_difference(p, q).alias("_diff"),
        (F.min("tb") * F.min("tc") == 0).alias("_gone")
    ).select(*by, "feature", "kind",
             F.when(F.col("_gone"), F.lit(1.0)).when(F.col("kind") == "number", F.col("_js"))
             .otherwise(F.col("_diff")).alias("distance"))


def skew(training: DataFrame, serving: DataFrame, edges: Mapping[str, Sequence[float]],
         categories: Sequence[str] = ()) -> DataFrame:
    """Training against serving data."""
    return compare(histogram(training, edges, categories), histogram(serving, edges, categories))


def drift(df: DataFrame, window: Column, edges: Mapping[str, Sequence[float]],
          categories: Sequence[str] = ()) -> DataFrame:
    """Each window against the one before it: ``(window, feature, kind, distance)``.

    The first window has no baseline and no row.
    """
    counts = histogram(df, edges, categories, by=[window]).withColumnRenamed("k0", "window")
    # one row per window of the log
    steps = counts.select("window").distinct().withColumn(
        "_next", F.lead("window").over(Window.orderBy("window")))
    shifted = (counts.join(steps, "window").where("_next is not null")
               .drop("window").withColumnRenamed("_next", "window"))
    return compare(shifted, counts, by=["window"])


def with_limits(distances: DataFrame, limits: Mapping[str, float] | None = None,
                default: float = DEFAULT_LIMIT) -> DataFrame:
    """Add each feature's own limit and whether the distance is above it."""
    chain = F.lit(float(default))
    for feature, limit in (limits or {}).items():
        chain = F.when(F.col("feature") == feature, F.lit(float(limit))).otherwise(chain)
    return distances.withColumn("limit", chain).withColumn("anomaly", F.col("distance") > F.col("limit"))


def anomaly_counts(judged: DataFrame, objective: str) -> DataFrame:
    """``(feature, objective, anomaly_count)``, features without an anomaly at 0."""
    return (judged.groupBy("feature").agg(F.count_if("anomaly").alias("anomaly_count"))
            .select("feature", F.lit(objective).alias("objective"), "anomaly_count"))


def retrain(counts: DataFrame, enabled: bool, feature: str | None = None) -> DataFrame:
    """One row: retrain if the flag is on and an anomaly was counted (for one feature or any)."""
    watched = counts if feature is None else counts.where(F.col("feature") == feature)
    total = F.coalesce(F.sum("anomaly_count"), F.lit(0)).cast("long")
    return watched.agg(total.alias("anomaly_count")).withColumn(
        "retrain", F.lit(enabled) & (F.col("anomaly_count") > 0))


def hourly(df: DataFrame, time: str, keys: Sequence[str] = (), width: str = "1 hour") -> DataFrame:
    """Tumbling-window counts; works on batch and (watermarked) streaming frames."""
    return (df.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("window_start"), *keys, "n"))
