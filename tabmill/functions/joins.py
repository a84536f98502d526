"""Joining a big, possibly skewed frame with a fitted lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabmill.session import cut

BROADCAST_BYTES = 64 << 20
TASK_ROWS = 4_000_000  # of one key, that a task should meet


def lookup(df: DataFrame, table: DataFrame, on: list[str], how: str = "left",
           max_bytes: int = BROADCAST_BYTES, task_rows: int = TASK_ROWS,
           written: bool = False) -> DataFrame:
    """Join ``df`` with ``table``, whose rows are unique in ``on``.

    The table is written once and measured. A small one is broadcast. Beyond that, the rows of
    keys with more than ``task_rows`` are counted and shared by as many tasks as they need, by
    a salt that depends on the row alone: a task that runs again deals its rows as before. All
    other rows are joined as they are. ``written`` says that the table comes from the shared folder already.
    """
    table = table if written else cut(table)
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(16)
                 for c in table.columns), F.lit(0))
    size = table.agg(F.sum(width.cast("long"))).first()[0] or 0
    if size <= max_bytes:
        return df.join(F.broadcast(table), on, how)
    # at most (rows / task_rows) keys are hot
    hot = cut(df.groupBy(*on).count().where(F.col("count") > task_rows)
              .select(*on, F.ceil(F.col("count") / task_rows).cast("int").alias("_spread")))
    spread = F.coalesce("_spread", F.lit(1))
    salted = (table.join(F.broadcast(hot), on, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), spread - 1))).drop("_spread"))
    return (df.join(F.broadcast(hot), on, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*df.columns), spread).cast("int")).drop("_spread")
            .join(salted, [*on, "_salt"], how).drop("_salt"))
