"""Sharding by jump consistent hashing, as column expressions only.

A stable key and the number of shards decide the shard; there is no ring table. When a shard
is appended, a key stays or moves into the new one, and 1 in ``shards + 1`` moves.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabmill.session import cut

# Fixed values of the published generator: a 64-bit linear congruential step.
STEP = 2862933555777941757
WORD64 = Decimal(1 << 64)
HALF = 1 << 31

PARTS = 4096  # groups a shard is numbered in: tasks of one shard, and the size of the offset table


def jump(key: Column, shards: int) -> Column:
    """Shard in [0, shards) of a 64-bit key.

    The generator's state is kept as a decimal, as its product needs more than 64 bits. A jump
    moves ahead by one shard at least, so ``shards`` steps always suffice.
    """
    unsigned = F.when(key < 0, key.cast("decimal(20,0)") + F.lit(WORD64)) \
        .otherwise(key.cast("decimal(20,0)")).cast("decimal(20,0)")

    def advance(state: Column) -> Column:
        product = state * F.lit(STEP).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        return (product % F.lit(WORD64)).cast("decimal(20,0)")

    def step(acc: Column, _: Column) -> Column:
        high = F.floor(acc["state"] / F.lit(1 << 33).cast("decimal(10,0)")).cast("double")
        ahead = F.floor((acc["j"] + 1).cast("double") * (F.lit(float(HALF)) / (high + 1))).cast("long")
        moved = F.struct(acc["j"].alias("b"), ahead.alias("j"), advance(acc["state"]).alias("state"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     advance(unsigned).alias("state"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda acc: acc["b"].cast("int"))


def stable_key(key: str, fallback: str) -> Column:
    """64 bits of a whole-number key, of whatever width; rows without one are spread by what they hold."""
    return F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("long"))).otherwise(F.xxhash64(F.lit("none"), F.col(fallback)))


def place(docs: DataFrame, shards: int) -> DataFrame:
    """Shard and place of each document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8; a null text has none and a checksum of 0. ``slot`` runs from 0 without a
    gap within a shard, by (hash group of the id, id). Rows without ``doc_id`` go by their text. Repeated rows
    go to one shard, in slots next to each other. An empty table gives no rows; other columns are not read.
    Only ids and sizes are moved: groups of a shard are numbered apart and shifted by the counts before them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = stable_key("doc_id", "text")
    placed = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump(key, shards).alias("shard"), jump(key, shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("part"), key), F.lit(PARTS)).cast("int").alias("part")))
    counts = placed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("spot", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first") + F.col("spot")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int) -> None:
    """The rows themselves, a folder per shard, each written by several tasks."""
    key = stable_key("doc_id", "text")
    docs.withColumn("shard", jump(key, shards)).write.partitionBy("shard").parquet(path)
