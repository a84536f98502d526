"""Filters, projections and cleaning: map-only column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
TEXT = (T.StringType,)


def two_classes(df: DataFrame, col: str, value) -> tuple[DataFrame, DataFrame]:
    """Rows where ``col`` equals ``value``, and the others (nulls included)."""
    same = F.col(col).eqNullSafe(F.lit(value))
    return df.where(same), df.where(~same)


def columns_of(df: DataFrame, kinds: tuple[type, ...]) -> list[str]:
    """Names of the columns of some types, read from the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def as_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def trim_text(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    names = columns_of(df, TEXT)
    return df.withColumns({c: F.trim(c) for c in names}) if names else df


def binary_label(df: DataFrame, col: str, value: str, out: str = "label") -> DataFrame:
    """1.0 where the trimmed text equals ``value``, else 0.0."""
    return df.withColumn(out, F.when(F.trim(col) == F.lit(value), 1.0).otherwise(0.0))


def name_codes(df: DataFrame, col: str, names: Mapping, out: str) -> DataFrame:
    """Map codes to names; a code without a name gives null."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.withColumn(out, F.try_element_at(table, F.col(col)))


def relabel(df: DataFrame, col: str, names: Mapping[str, str]) -> DataFrame:
    """Keep the rows whose label is in ``names`` and rename the label."""
    chain = None
    for old, new in names.items():
        hit = F.col(col) == F.lit(old)
        chain = F.when(hit, new) if chain is None else chain.when(hit, new)
    return df.where(F.col(col).isin(*names)).withColumn(col, chain)


def clip(col: Column | str, low: float = -5.0, high: float = 5.0) -> Column:
    """Nulls stay null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest key."""
    return df.orderBy(key).limit(n)
