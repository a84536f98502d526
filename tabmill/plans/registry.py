"""Named queries and the SQL that another engine answers them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabmill.functions.hashing import HASH_RANGE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if SQL can say it."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One of the given tables, as the scan deals it out."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- the hashing rules in the oracle's SQL --------------------------------------------------

def sql_digest(*exprs: str, seed: str = "") -> str:
    parts = [f"'{seed}'"] if seed else []
    parts += [f"coalesce(cast({e} as varchar), '')" for e in exprs]
    return f"md5(concat_ws('#', {', '.join(parts)}))"


def sql_int(digest: str) -> str:
    return f"cast('0x' || substr({digest}, 1, 8) as bigint)"


def sql_bucket(n: int, *exprs: str, seed: str = "") -> str:
    return f"({sql_int(sql_digest(*exprs, seed=seed))} % {n})"


def sql_in_fraction(fraction: float, *exprs: str, seed: str = "") -> str:
    return f"({sql_int(sql_digest(*exprs, seed=seed))} < {round(fraction * HASH_RANGE)})"


def sql_cents(expr: str) -> str:
    return f"cast(round({expr} * 100) as bigint)"
