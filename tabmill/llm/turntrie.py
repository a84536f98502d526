"""Prefix trie of conversations: who shares which first turns.

A turn is a fixed-width id of 16 bytes, big-endian, from a hash of role and text; a conversation is the key of its turns' ids. The distinct
keys are dealt in key order into ranges of about equal numbers, and every task builds an adaptive radix tree of its range; byte depths that are whole
numbers of turns are the nodes of the trie. A popular first turn is thus shared by as many tasks as its keys need. What two ranges can have in
common is only on the way to the first or last key of a range: these nodes are given in part by each task and added up in a small table,
from which the others take their parents' names. Equal conversations are one key; their ids are hashed in order, piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabmill.functions.joins import lookup
from tabmill.llm.common import WORD, arrow_type
from tabmill.llm.radix import Tree, common
from tabmill.session import cut

WIDTH = 16                 # bytes of a turn id
RANGE_BYTES = 16 << 20     # of keys of which a task makes one tree
PIECE_BYTES = 1 << 16      # of ids that are handed on to be hashed at a time

SEQUENCES = "conv_id long, key binary, words array<long>"
PARTS = ("shared boolean, path binary, ancestors array<binary>, up binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, last_words long")


def digest(column: Column) -> Column:
    return F.unhex(F.substring(F.sha2(column, 256), 1, 2 * WIDTH))


def schema_of(text: str) -> pa.Schema:
    return pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in text.split(", ")])


def ranges(df: DataFrame, size: int) -> int:
    """Tasks for ``size`` bytes: as many as they need, but all that the session has."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, words`` of every conversation: the ids of its turns by turn, role and text, null turns first, and the words in each.

    Null roles and texts are empty; rows without a conversation id belong to none and are left out; repeated rows are turns like
    others; other columns are not read. A conversation's turns are sorted where they may spill, and only its key is held whole.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")) \
        .select("*", digest(F.concat_ws(":", F.octet_length("role").cast("string"), F.concat("role", "text"))).alias("id"),
                F.regexp_count("text", F.lit(WORD)).cast("long").alias("n"))
    placed = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", "id", "n")
    schema = schema_of(SEQUENCES)

    def row(conv_id: int, ids: list[bytes], words: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((conv_id, b"".join(ids), words), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, words = None, [], []
        for batch in batches:
            done = []
            for conv_id, own, n in zip(*[c.to_pylist() for c in batch.columns]):
                if conv_id != last:
                    if last is not None:
                        done.append(row(last, ids, words))
                    last, ids, words = conv_id, [], []
                ids.append(own)
                words.append(n)
            yield from done
        if last is not None:
            yield row(last, ids, words)

    return placed.mapInArrow(run, SEQUENCES)


def endings(keyed: DataFrame) -> DataFrame:
    """``name, n, least, ends_sha256`` of each distinct key: number, smallest and hash of the ids of its conversations, in order.

    Ids are sorted by range and joined into pieces there; the hash of a key with very many conversations reads few, long pieces.
    """
    ids = keyed.select("name", "conv_id")
    pieces = schema_of("name binary, first long, n long, ids binary")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size = None, [], 0

        def piece() -> tuple:
            return last, held[0], len(held), ",".join(map(str, held)).encode()

        for batch in batches:
            done = []
            for name, conv_id in zip(*[c.to_pylist() for c in batch.columns]):
                if name != last or size >= PIECE_BYTES:
                    if held:
                        done.append(piece())
                    last, held, size = name, [], 0
                held.append(conv_id)
                size += len(str(conv_id)) + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), pieces.types)], schema=pieces)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(piece(), pieces.types)], schema=pieces)

    out = schema_of("name binary, n long, least long, ends_sha256 string")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, least, hashed = None, 0, None, None
        for batch in batches:
            done = []
            for name, first, count, text in zip(*[c.to_pylist() for c in batch.columns]):
                if name != last:
                    if last is not None:
                        done.append((last, n, least, hashed.hexdigest()))
                    last, n, least, hashed = name, 0, first, hashlib.sha256()
                hashed.update(b"," * (n > 0) + text)
                n += count
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), out.types)], schema=out)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((last, n, least, hashed.hexdigest()), out.types)], schema=out)

    size = 24 * ids.count()
    joined = ids.repartitionByRange(ranges(ids, size), "name", "conv_id").sortWithinPartitions("name", "conv_id") \
        .mapInArrow(cut_up, "name binary, first long, n long, ids binary")
    return joined.repartition("name").sortWithinPartitions("name", "first").mapInArrow(add_up, "name binary, n long, least long, ends_sha256 string")


class Bundle:
    """What the nodes above need to know of a subtree."""

    __slots__ = ("n", "least", "kids", "leaves", "saved", "open", "words", "low", "high")

    def __init__(self) -> None:
        self.n, self.least, self.kids, self.leaves, self.saved = 0, None, 0, 0, 0
        self.open: list[list] = []             # rows whose parent is not known yet
        self.words: list[int] = []             # words of the turns of a member
        self.low, self.high = -1, -1           # how far a member goes with the first and with the last key of the range

    def add(self, other: Bundle) -> None:
        self.n += other.n
        self.least = other.least if self.least is None else min(self.least, other.least)
        self.kids, self.leaves, self.saved = self.kids + other.kids, self.leaves + other.leaves, self.saved + other.saved
        if len(other.open) > len(self.open):
            self.open, other.open = other.open, self.open
        self.open += other.open
        self.words = self.words or other.words
        self.low, self.high = max(self.low, other.low), max(self.high, other.high)


def trie_rows(keys: list[tuple[bytes, int, int, str, list[int]]]) -> list[list]:
    """Rows as in ``PARTS`` of the nodes of a sorted range of ``key, n, least, ends, words``."""
    tree = Tree()
    low, high = keys[0][0], keys[-1][0]
    for key, *value in keys:
        tree.insert(key, value)
        value += [common(key, low), common(key, high)]
    ways = [[hashlib.sha256(end[:at]).digest()[:WIDTH] for at in range(0, len(end) + 1, WIDTH)] for end in (low, high)]
    done: list[list] = []

    def emit(b: Bundle, depth: int, ends: str | None) -> None:
        last_words = b.words[depth - 1] if depth else 0
        if max(b.low, b.high) >= depth * WIDTH:  # other ranges may have the node too
            way = ways[0] if b.low >= depth * WIDTH else ways[1]
            for row in b.open:
                row[3] = way[depth]
            done.append([True, way[depth], way[:depth + 1], way[depth - 1] if depth else None, b.least, depth, None, b.n, b.kids, b.leaves,
                         b.saved, ends, last_words])
            b.open, b.kids, b.leaves, b.saved = [], 0, 0, 0
            return
        for row in b.open:
            row[6] = b.least
        b.leaves, b.saved = b.leaves or 1, b.saved + (b.n - 1) * last_words
        done.append([False, None, None, None, b.least, depth, None, b.n, b.kids, b.leaves, b.saved, ends, last_words])
        b.open, b.kids = [done[-1]], 1

    waiting: dict[int, Bundle] = {}
    for above, depth, node in tree.climb():
        b, ends = Bundle(), None
        if node.value is not None:
            b.n, b.least, ends, b.words, b.low, b.high = node.value
        for _, child in node.children():
            b.add(waiting.pop(id(child)))
        for at in range(depth - depth % WIDTH, above, -WIDTH):
            emit(b, at // WIDTH, ends if at == depth else None)
        waiting[id(node)] = b
    return done


def nodes(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conv_id, key, words``, one row each.

    ``conv_id`` smallest conversation that begins with the node's turns; ``depth`` turns; ``parent_conv_id`` that of the parent (null at the
    root); ``n_convs`` conversations; ``n_children``; ``n_leaves`` childless nodes of the subtree, itself if it is one; ``saved_tokens`` words of the
    last turns of the subtree's nodes, each as often as conversations but one share it; ``ends_sha256`` of the comma-joined ids that end here,
    ascending. No conversations give no nodes, not even a root; conversations without turns end at the root. Rows with one id are one
    conversation each. A range's first and last key cost the square of their depth.
    """
    keyed = cut(seqs.select("conv_id", "key", "words", digest(F.col("key")).alias("name")))
    whole = cut(keyed.groupBy("name").agg(F.first("key").alias("key"), F.first("words").alias("words")).join(endings(keyed), "name")
                .select("key", "n", "least", "ends_sha256", "words"))
    size = whole.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    schema = schema_of(PARTS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])]
        rows = trie_rows(keys) if keys else []
        for at in range(0, len(rows), 10000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 10000]), schema.types)], schema=schema)

    parts = cut(whole.repartitionByRange(ranges(whole, size), "key").sortWithinPartitions("key").mapInArrow(build, PARTS))
    total = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    merged = cut(parts.where("shared").groupBy("path").agg(
        F.first("ancestors").alias("ancestors"), F.first("up").alias("up"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *total.values(), F.max("ends_sha256").alias("ends_sha256"), F.first("last_words").alias("last_words")))
    kids = merged.where("up is not null").groupBy(F.col("up").alias("path")).agg(F.count("*").alias("more"))
    counted = cut(merged.join(kids, "path", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
                  .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long"))
                  .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("last_words")))
    below = counted.select(F.explode("ancestors").alias("path"), "n_leaves", "saved_tokens").groupBy("path").agg(total["n_leaves"], total["saved_tokens"])
    named = counted.select(F.col("path").alias("up"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")]
    top = counted.drop("n_leaves", "saved_tokens").join(below, "path").join(named, "up", "left").withColumn("parent_conv_id", F.col("above"))
    own = parts.where("not shared")
    hung = lookup(own.where("up is not null").drop("path"), named, ["up"]).withColumn("parent_conv_id", F.col("above"))
    return top.select(*columns).unionByName(hung.select(*columns)).unionByName(own.where("up is null").select(*columns))
