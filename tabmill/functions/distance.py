"""Distances between two distributions given as shares of the same bins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _half_divergence(p: Column, q: Column) -> Column:
    return F.when(p > 0, p * F.ln(2 * p / (p + q))).otherwise(F.lit(0.0)) / 2


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence in nats (Lin 1991), as an aggregate over bins."""
    return F.sum(_half_divergence(p, q) + _half_divergence(q, p))


def largest_difference(p: Column, q: Column) -> Column:
    """Largest absolute difference of shares, as an aggregate over bins."""
    return F.max(F.abs(p - q))
