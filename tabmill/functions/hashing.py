"""Seeded, portable row hashing.

A hash of a key gives the same bucket whatever the partitioning, after a retry and in
other engines. Splits and routing use xxhash64 by default, several times cheaper; with
``fast=False`` they use md5, where other engines must give the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

HASH_RANGE = 1 << 32


def digest(*cols: Column | str, seed: str = "") -> Column:
    """32 hex digits for a seed and some columns; nulls read as empty text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    if seed:
        parts = [F.lit(seed), *parts]
    return F.md5(F.concat_ws("#", *parts))


def hash_int(text: Column) -> Column:
    """The first 8 hex digits of a digest as a long in [0, 2**32)."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long")


def bucket(n: int, *cols: Column | str, seed: str = "") -> Column:
    """Bucket number in [0, n)."""
    return hash_int(digest(*cols, seed=seed)) % F.lit(n).cast("long")


def fast_bucket(n: int, *cols: Column | str, seed: str = "") -> Column:
    """Bucket number by xxhash64: Spark only, no hex text on the way."""
    return F.pmod(fast_hash(*cols, seed=seed), F.lit(n).cast("long"))


def below(text: Column, fraction: float) -> Column:
    """True if a digest lies in the first ``fraction`` of the hash range.

    Hex digits sort like the numbers they stand for, so the texts are compared as they are.
    """
    limit = round(fraction * HASH_RANGE)
    return text < F.lit(f"{limit:08x}" if limit < HASH_RANGE else "g")


def fast_below(number: Column, fraction: float) -> Column:
    """The same for a 64-bit hash, which may be negative."""
    limit = round(fraction * 2**64) - 2**63
    return F.lit(True) if limit >= 2**63 else number < F.lit(limit)


def fast_hash(*cols: Column | str, seed: str = "") -> Column:
    return F.xxhash64(F.lit(seed), *[_col(c) for c in cols])


def in_fraction(fraction: float, *cols: Column | str, seed: str = "", fast: bool = False) -> Column:
    """True for about ``fraction`` of all keys, always the same ones.

    ``fast`` hashes with xxhash64, several times cheaper, where no other engine must agree.
    """
    if fast:
        return fast_below(fast_hash(*cols, seed=seed), fraction)
    return below(digest(*cols, seed=seed), fraction)


def content(df: DataFrame, cols: list[str] | None = None, scale: int = 2) -> list[Column]:
    """Columns of a row in a form whose text is the same in every engine.

    Doubles become whole numbers of 10**-scale, as their text form is engine-specific.
    """
    out = []
    for field in df.schema.fields:
        if cols is not None and field.name not in cols:
            continue
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column * 10**scale).cast("long")
        out.append(column)
    return out


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
