"""Mixing sources to target weights, as DataFrame and SQL functions only.

The words of a source, its documents one after the other, are cut into blocks of fixed length.
Each output shard draws how many blocks it takes of each source; the slots of a source are
numbered over all shards and mapped through a pseudorandom permutation of its block numbers;
the blocks drawn are then joined by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabmill.llm.common import WORD, quoted, text_key
from tabmill.session import cut

BLOCK = 256        # words of a block
SHARD = 65_536     # blocks of an output shard, about
REPEATS = 3        # times a source, and so a block, may be taken at most
WEIGHTS = (1, 2, 3)
ROUNDS = 24        # of the permutation
PARTS = 4096       # groups in which the documents of a source are laid out
SEED = "mix"


def targets(sources: DataFrame) -> DataFrame:
    """Words wanted of each source: ``src, source, source_size, target``, from ``src, source, source_size``.

    Sources weigh 1, 2, 3, 1, ... in code point order, null last. Shares above ``REPEATS`` times the source are
    cut there and the rest is shared anew by weight until none is above. That ends at one level ``target / weight`` for
    all sources that are not cut, and the sources with the smallest limit per weight are cut first, so running
    sums find it. A row per source meets in one task, never a row per document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight.cast("double")).withColumn(
        "cap", F.col("source_size").cast("double") * REPEATS)
    order = [F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) \
        / F.sum("weight").over(onward)
    leveled = weighed.withColumn("level", level)
    open_ = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    common = F.max(open_).over(whole)  # none only if there are no words at all
    return leveled.select("src", "source", "source_size",
                          F.least("cap", F.coalesce(common, F.lit(0.0)) * F.col("weight")).alias("target"))


def permute(index: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of [0, size) at ``index``: the swap-or-not shuffle.

    A round pairs x with (k - x) mod size and swaps the pair if a hash of its larger member is odd, so every
    round is a permutation of just these numbers.
    """
    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), size) - x, size)
        odd = F.xxhash64(key, r, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(odd, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, step)


def draws(wanted: DataFrame, block: int, shard: int) -> DataFrame:
    """Times each block is taken: ``src, block, times``.

    A source is expected to fill ``target / (words of its mean block)`` slots. Each shard draws its counts
    with one random offset over evenly spaced points of the sources' cumulative shares: every source's count has the
    multinomial's mean, and lies within one of it, where independent draws would stray by the square root.
    """
    spark = wanted.sparkSession
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    sized = wanted.where("source_size > 0").select(
        "src", "source", blocks.alias("blocks"),
        (F.col("target") * blocks / F.col("source_size")).alias("slots"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    shared = sized.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.sum("slots").over(whole) / shard))) \
        .withColumn("high", F.sum("slots").over(upto) / F.col("shards")) \
        .withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy(F.col("source").isNull(), "source")), F.lit(0.0)))
    each = shared.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards").cast("long") - 1)))
    offset = F.pmod(F.xxhash64(F.lit(SEED), F.lit("shard"), "shard"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    counted = each.withColumn("count", (F.ceil(F.col("high") - offset) - F.ceil(F.col("low") - offset)).cast("long"))
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranged = counted.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))) \
        .withColumn("last", F.least(F.col("first") + F.col("count"), F.col("blocks") * REPEATS) - 1) \
        .where("last >= first")
    # a row stands for up to a shard's slots: dealt out before they are spelled out
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = ranged.select("src", "blocks", "shard", "first", "last").repartition(parts, "src", "shard") \
        .select("src", "blocks", F.explode(F.sequence("first", "last")).alias("slot"))
    epoch = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    key = F.xxhash64(F.lit(SEED), F.col("src"), epoch)
    picked = slots.select("src", permute(F.pmod("slot", "blocks"), F.col("blocks"), key).alias("block"))
    return picked.groupBy("src", "block").agg(F.count("*").alias("times"))


def named_source() -> Column:
    """A row's source as text that is never null."""
    source = F.col("source").cast("string")
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Words of each document that the mix takes: ``doc_id, size, source_size, target, taken``.

    A null text has no words and is never taken, like an empty one. Documents without a source form the last source.
    Repeated rows are documents of their own. Null ids sort first. An empty table gives no rows; other columns
    are not read. A long document spans many blocks. No block is taken more than ``REPEATS`` times. Draws
    depend on the rows alone, so reruns agree.
    """
    return drawn(docs, block, shard).select("doc_id", "size", "source_size", "target", "taken")


def drawn(docs: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The rows of ``mix`` with what names a row besides its id: ``text_key, src``."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    source = F.col("source").cast("string")
    sized = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), size.alias("size"),
        named_source().alias("src"), text_key().alias("text_key"),
        F.pmod(F.xxhash64(F.lit(SEED), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))), F.lit(PARTS)).cast("int").alias("part")))
    groups = sized.groupBy("src", "source", "part").agg(F.sum("size").alias("group_size"))
    wanted = cut(targets(groups.groupBy("src", "source").agg(F.sum("group_size").alias("source_size"))))
    times = draws(wanted, block, shard)
    # the words of a source in one line: groups by number, documents by id within
    before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("src", "part", F.coalesce(F.sum("group_size").over(before), F.lit(0)).alias("first"))
    upto = Window.partitionBy("src", "part").orderBy("doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    laid = sized.withColumn("end", F.sum("size").over(upto)).join(offsets.hint("merge"), ["src", "part"]).select(
        "doc_id", "text_key", "src", "size", (F.col("first") + F.col("end") - F.col("size")).alias("start"))
    laid = cut(laid)
    span = F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))
    pieces = laid.where("size > 0").select("src", "start", "size", F.explode(span).alias("block"))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) \
        - F.greatest(F.col("start"), F.col("block") * block)
    taken = pieces.join(times.hint("merge"), ["src", "block"]).groupBy("src", "start").agg(F.sum(words * F.col("times")).alias("words"))
    return laid.join(taken.hint("merge"), ["src", "start"], "left").join(
        wanted.select("src", "source_size", "target"), "src").select(
        "doc_id", "text_key", "src", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(0).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **settings: int) -> DataFrame:
    """The documents of the mix, each as often as its words are taken: same columns as ``docs``.

    A document of which the blocks hold a part is taken whole or not, by a hash of its id, text and source, with that
    part as its chance, so the words of a source stay near its target. Rows equal in these share one draw. Null and empty
    texts have no words and go; a null id or source is a value like others; an empty table gives no rows. Other columns
    may have any name.
    """
    key = ["doc_id", "text_key", "src"]
    shares = drawn(docs, **settings).groupBy(*key).agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
    share = F.coalesce(F.try_divide("t", "s"), F.lit(0.0))
    chance = F.pmod(F.xxhash64(F.lit(SEED), F.lit("part"), *key), F.lit(1 << 52)) / F.lit(float(1 << 52))
    copies = shares.select(F.col("doc_id").alias("mix_id"), F.col("text_key").alias("mix_text"), F.col("src").alias("mix_src"),
                           (F.floor(share) + (chance < share - F.floor(share)).cast("int")).cast("int").alias("mix_copies")) \
        .where("mix_copies > 0")
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns])  # one column, so names cannot clash with those used here
    rows = docs.select(whole.alias("row"), F.col("doc_id").cast("long").alias("own_id"), text_key().alias("own_text"),
                       named_source().alias("own_src"))
    taken = rows.join(copies, F.col("own_id").eqNullSafe(F.col("mix_id")) & (F.col("own_text") == F.col("mix_text"))
                      & (F.col("own_src") == F.col("mix_src")))
    return taken.select("row", F.explode(F.sequence(F.lit(1), "mix_copies")).alias("copy")).select("row.*")
