"""Sampling and splitting.

Every rule decides a row from a hash of its key (or content), so the same row is in the same
part after a retry, on any partitioning and in any later job. Fraction rules touch no other
row. Exact-count rules find the boundary hash first (see ``functions.order``) and then label
the rows in one map-only pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabmill.functions import hashing
from tabmill.functions.joins import lookup
from tabmill.functions.order import hash_cutoffs, order_statistics, sizes

Keys = Sequence[str]


def sample(df: DataFrame, fraction: float, key: Keys, seed: str = "2", fast: bool = True) -> DataFrame:
    """Seeded sample of about ``fraction`` of the keys."""
    return df.where(hashing.in_fraction(fraction, *key, seed=seed, fast=fast))


def complement(df: DataFrame, fraction: float, key: Keys, seed: str = "2", fast: bool = True) -> DataFrame:
    """The rows ``sample`` leaves out: no join needed, the rule is on the row itself."""
    return df.where(~hashing.in_fraction(fraction, *key, seed=seed, fast=fast))


def undersample(df: DataFrame, label: str, minority, fraction: float, key: Keys,
                seed: str = "2", fast: bool = True) -> DataFrame:
    """All rows of the minority class and a sample of the others, in one filter."""
    return df.where((F.col(label) == F.lit(minority))
                    | hashing.in_fraction(fraction, *key, seed=seed, fast=fast))


def shuffled(df: DataFrame, key: Keys, seed: str = "2") -> DataFrame:
    """Seeded random order. Only worth its sort where the order itself is the output."""
    return df.orderBy(hashing.digest(*key, seed=seed))


def exact_split(df: DataFrame, names: Sequence[str], key: Keys, shares: Sequence[float] | None = None,
                counts: Sequence[int] | None = None, seed: str = "2", by: Sequence[str] = (),
                out: str = "split") -> DataFrame:
    """Label rows by position in seeded order.

    ``shares`` or ``counts`` are cumulative ends of all parts but the last. With ``by`` the
    shares hold within each class (a stratified split).
    """
    spot = hashing.digest(*key, seed=seed)
    if not by:
        # one row per cut: known values make the labelling a plain map over the rows
        ends = {r["cut"]: r["cutoff"] for r in hash_cutoffs(df, spot, shares, counts).collect()}
        return df.withColumn(out, _part([F.lit(ends.get(i, "")) for i in range(len(names) - 1)], spot, names))
    # a null class is a class: its text is "{}"
    classed = df.withColumn("_class", F.to_json(F.struct(*by)))
    cuts = hash_cutoffs(classed, spot, shares, counts, by=["_class"])
    # one short array per class: as many entries as there are cuts
    per_class = cuts.groupBy("_class").agg(
        F.sort_array(F.collect_list(F.struct("cut", "cutoff"))).alias("_cuts"))
    ends = [F.col("_cuts")[i]["cutoff"] for i in range(len(names) - 1)]
    return (lookup(classed, per_class, ["_class"], how="inner")
            .withColumn(out, _part(ends, spot, names)).drop("_cuts", "_class"))


def _part(ends: Sequence[Column], spot: Column, names: Sequence[str]) -> Column:
    label = None
    for end, name in zip(ends, names):
        inside = spot <= end
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(names[-1])


def head_tail(df: DataFrame, key: Keys, head: float = 0.8, seed: str = "2") -> DataFrame:
    """First 80 % of the shuffled rows are ``train``, the rest ``test``."""
    return exact_split(df, ["train", "test"], key, shares=[head], seed=seed)


def take_skip(df: DataFrame, key: Keys, declared_size: int, take: float = 0.64,
              then: float = 0.16, seed: str = "2") -> DataFrame:
    """Parts counted from a declared size; what is left over goes to the last part."""
    first = int(declared_size * take)
    return exact_split(df, ["train", "validate", "test"], key,
                       counts=[first, first + int(declared_size * then)], seed=seed)


def holdout(df: DataFrame, key: Keys, n: int = 1000, seed: str = "2") -> DataFrame:
    """A fixed number of rows for validation."""
    return exact_split(df, ["validate", "train"], key, counts=[n], seed=seed)


def stratified(df: DataFrame, label: str, key: Keys, shares: Sequence[float] = (0.8, 0.9),
               names: Sequence[str] = ("train", "validate", "test"), seed: str = "2") -> DataFrame:
    """Exact shares within every class."""
    return exact_split(df, names, key, shares=shares, seed=seed, by=[label])


def fractions(df: DataFrame, key: Keys, shares: Sequence[float] = (0.8, 0.1, 0.1),
              names: Sequence[str] = ("train", "validate", "test"), seed: str = "2",
              out: str = "split", fast: bool = True) -> DataFrame:
    """Shares in expectation, decided row by row; ``fast`` as in ``hashing.in_fraction``."""
    spot = hashing.fast_hash(*key, seed=seed) if fast else hashing.digest(*key, seed=seed)
    below = hashing.fast_below if fast else hashing.below
    label, end = None, 0.0
    for share, name in zip(shares[:-1], names[:-1]):
        end += share
        label = F.when(below(spot, end), name) if label is None else label.when(below(spot, end), name)
    return df.withColumn(out, label.otherwise(names[-1]))


def chronological(df: DataFrame, time: str, shares: Sequence[float] = (0.8, 0.9),
                  names: Sequence[str] = ("train", "validate", "test"),
                  out: str = "split") -> DataFrame:
    """Oldest rows first; rows of one time stay together, with the first of them.

    Rows without a time go to the last part.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    timed = df.select(micros.alias("t")).where("t is not null")
    whole = sizes(timed, ["t"])
    last = [math.floor(whole["t"]["n"] * s + 1e-9) - 1 for s in shares]  # rank of each part's last row
    ends = order_statistics(timed, {"t": sorted({k for k in last if k >= 0})}, whole)
    label = None
    for k, name in zip(last, names):
        inside = micros <= F.lit(ends["t", k]) if k >= 0 else F.lit(False)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return df.withColumn(out, label.otherwise(names[-1]))


def content_split(df: DataFrame, cols: Sequence[str] | None = None, out: str = "split", fast: bool = True) -> DataFrame:
    """Split by a hash of the whole row: bucket 9 TEST, 8 VALIDATE, the rest TRAIN.

    Equal rows always share a part.
    """
    # The buckets 9 and 8 of 10, and the names of the parts.
    number = hashing.fast_bucket if fast else hashing.bucket
    spot = number(10, *hashing.content(df, list(cols) if cols else None))
    return df.withColumn(
        out, F.when(spot == 9, "TEST").when(spot == 8, "VALIDATE").otherwise("TRAIN"))


def given_split(df: DataFrame, col: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per value of a split column the user brings."""
    return {n: df.where(F.col(col) == F.lit(n)) for n in names}


def folds(df: DataFrame, k: int, key: Keys, seed: str = "2", out: str = "fold", fast: bool = True) -> DataFrame:
    number = hashing.fast_bucket if fast else hashing.bucket
    return df.withColumn(out, number(k, *key, seed=seed).cast("int"))


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per part; a reader that filters on the part opens only its folder."""
    df.write.mode("errorifexists").partitionBy(split).parquet(path)
