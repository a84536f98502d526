"""Token ids in files of canonical, length-limited Huffman codes.

A file is a folder of two tables that any reader of Parquet can open. ``codebook`` holds a code length per token id;
canonical codes follow from the lengths. ``blocks`` holds the ids of whole documents in ascending id order: each row
is coded by itself and keeps the bit offset of every 256th id, so a reader starts anywhere and decodes all
spans between two offsets side by side, a table lookup per id.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from sys import byteorder

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabmill.llm.common import arrow_type, slices, texts
from tabmill.session import fresh_path

END = 1              # id that ends a document
BLOCK = 262_144      # ids after which a block is closed, at the end of a document
STRIDE = 256         # ids between two bit offsets
LONGEST = 18         # bits of a code; two more than 49,408 ids need
KNOWN = 1_000_000    # words of which a worker remembers the ids

RAW = "part int, seq int, at long, doc_ids array<long>, counts array<int>, ids binary, tokens array<int>, freqs array<long>"
BLOCKS = "part int, seq int, start long, doc_ids array<long>, counts array<int>, n int, offsets array<long>, bits binary"
# letters, then signs that are no apostrophe: the pre-tokenizer cuts such a word between the two
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class Learned(dict):
    """What ``learn`` gives for a key, asked once."""

    def __init__(self, learn: Callable):
        super().__init__()
        self.learn = learn

    def __missing__(self, key):
        got = self[key] = self.learn(key)
        return got


class Encoder:
    """Ids of a text as little-endian 32-bit integers, the way a tokenizer that drops white space gives them.

    Such a tokenizer treats what lies between white space by itself, so the library is asked once per
    new word and the answers are joined. Texts that spell a special token go to the library whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Learned(self.word)
        self.pieces = Learned(self.asked)

    def asked(self, text: str) -> bytes:
        ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        if byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def piece(self, text: str) -> bytes:
        if len(self.pieces) >= KNOWN:
            self.pieces.clear()
        return self.pieces[text]

    def word(self, raw: bytes) -> bytes:
        text = raw.decode()
        plain = PLAIN.fullmatch(text)
        if plain is None:
            return self.piece(text)
        letters, signs = plain.groups()
        got = self.piece(letters.lower())
        return got + self.piece(signs) if signs else got

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self.asked(text)
        if len(self.words) >= KNOWN:
            self.words.clear()
        return b"".join(map(self.words.__getitem__, text.encode().split()))


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """One per worker and tokenizer: what it has learned of words serves later tasks."""
    return Encoder(spec)


def tokenized(docs: DataFrame, spec: str, end: int = END) -> DataFrame:
    """Ids of all documents in id order, in rows of about a block, with the id counts of each task."""
    given = docs.sparkSession.sparkContext.broadcast(spec)  # a vocabulary file: a few MB whatever the input
    closing = np.array([end], "<u4").tobytes()
    schema = pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in RAW.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(given.value), TaskContext.get().partitionId()
        codec = pa.Codec("zstd", 1)
        totals, at, seq = np.zeros(0, np.int64), 0, 0
        ids, keys, held = [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal totals, at, seq, ids, keys, held
            flat = np.frombuffer(b"".join(ids), "<u4")
            counts = np.bincount(flat) if len(flat) else np.zeros(0, np.int64)
            if len(counts) > len(totals):
                totals = np.pad(totals, (0, len(counts) - len(totals)))
            totals[:len(counts)] += counts
            row = (part, seq, at, keys, [len(x) // 4 for x in ids], pack(flat, codec), None, None)
            at, seq, ids, keys, held = at + len(flat), seq + 1, [], [], 0
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema=schema)

        for batch in batches:
            for some in slices(batch):
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids.append(coder.ids(text or "") + closing)
                    keys.append(key)
                    held += len(ids[-1]) // 4
                    if held >= BLOCK:
                        yield block()
        if keys:
            yield block()
        seen = np.flatnonzero(totals)
        if len(seen):
            row = (part, None, at, None, None, None, seen.astype(np.int32), totals[seen])
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema=schema)

    tie = F.xxhash64("text")
    ordered = texts(docs).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return ordered.mapInArrow(run, RAW)


def pack(ids: np.ndarray, codec: pa.Codec) -> bytes:
    """Ids on their way to the counts: low and high halves apart, compressed."""
    halves = ids.view("<u2").reshape(-1, 2)
    raw = np.ascontiguousarray(halves.T).tobytes()
    return len(ids).to_bytes(8, "little") + codec.compress(raw, asbytes=True) if len(ids) else b""


def unpack(data: bytes, codec: pa.Codec) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint32)
    n = int.from_bytes(data[:8], "little")
    raw = codec.decompress(data[8:], decompressed_size=4 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, "<u2").reshape(2, n).T).view("<u4").ravel()


def code_lengths(freqs: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code of at most ``longest`` bits, by package-merge.

    ``freqs`` are positive. Level by level, pairs of the last level's cheapest entries are merged with the single ids;
    going back, a level's ids among the entries in use get one bit more.
    """
    n = len(freqs)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    order = np.argsort(freqs, kind="stable")
    single = freqs[order].astype(np.float64)
    levels, weights = [], single
    is_single = np.ones(n, bool)
    levels.append(is_single)
    for _ in range(longest - 1):
        even = len(weights) // 2 * 2
        pairs = weights[:even:2] + weights[1:even:2]
        merged = np.concatenate([single, pairs])
        spots = np.argsort(merged, kind="stable")
        weights, is_single = merged[spots], spots < n
        levels.append(is_single)
    lengths, used = np.zeros(n, np.int64), 2 * n - 2
    for is_single in reversed(levels):
        ids = int(is_single[:used].sum())
        lengths[:ids] += 1
        used = 2 * (min(used, len(is_single)) - ids)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids by (length, id), their lengths and codes; codes of one length count up."""
    order = np.lexsort((tokens, lengths))
    tokens, lengths = tokens[order], lengths[order].astype(np.int64)
    steps = np.left_shift(np.int64(1), LONGEST - lengths)
    left = np.concatenate([[0], np.cumsum(steps)[:-1]]) if len(steps) else steps
    return tokens, lengths, left >> (LONGEST - lengths)


class Codebook:
    """Tables to code and decode with: by id, and by the next ``LONGEST`` bits."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        tokens, lengths, codes = canonical(np.asarray(tokens, np.int64), np.asarray(lengths, np.int64))
        width = int(tokens.max()) + 1 if len(tokens) else 0
        self.code, self.length = np.zeros(width, np.uint64), np.zeros(width, np.int64)
        self.code[tokens], self.length[tokens] = codes, lengths
        spans = 1 << (LONGEST - lengths)
        fill = (1 << LONGEST) - int(spans.sum())
        self.symbol = np.concatenate([np.repeat(tokens, spans), np.zeros(fill, np.int64)]).astype(np.uint32)
        self.bits = np.concatenate([np.repeat(lengths, spans), np.ones(fill, np.int64)])

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits, first bit highest, and the bit offset of every ``STRIDE``-th id."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        total = int(ends[-1]) if len(ends) else 0
        # a code lies in one or two words of 32 bits; no two codes share a bit, so sums put them together
        word, shift = starts >> 5, (64 - (starts & 31) - lengths).astype(np.uint64)
        placed = self.code[ids] << shift
        words = (total + 31) // 32 + 2
        high = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), words)
        low = np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
        return (high + low).astype(np.uint64).astype(">u4").tobytes(), starts[::STRIDE]

    def decode(self, bits: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """All ids of a block: the spans between two offsets advance together."""
        raw = np.frombuffer(bits, np.uint8).astype(np.uint32)
        ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]  # 32 bits from each byte on
        at = np.array(offsets, np.int64)
        out = np.zeros((STRIDE, len(at)), np.uint32)
        mask, left = np.uint32((1 << LONGEST) - 1), 32 - LONGEST
        last = n - (len(at) - 1) * STRIDE  # ids of the last span
        for i in range(min(STRIDE, n)):
            if i == last:
                at = at[:-1]
            index = (ahead[at >> 3] >> (left - (at & 7)).astype(np.uint32)) & mask
            out[i, :len(at)] = self.symbol[index]
            at = at + self.bits[index]
        return out.T.ravel()[:n]


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id counts of many tasks added up before they are spelled out."""
    totals = np.zeros(0, np.int64)
    for batch in batches:
        for tokens, freqs in zip(batch.column(0), batch.column(1)):
            ids = tokens.values.to_numpy()
            if len(ids):
                totals = np.pad(totals, (0, max(0, int(ids.max()) + 1 - len(totals))))
                totals[ids] += freqs.values.to_numpy()
    seen = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(totals[seen])], names=["token", "freq"])


def write_ids(docs: DataFrame, spec: str, path: str, end: int = END) -> None:
    """Encode all texts and write their ids, with ``end`` after each document, in ascending ``doc_id`` order.

    A null or empty text is the ``end`` id alone. A null id comes first; repeated ids follow one another by a hash of
    their text, and equal rows as often as they occur. An empty table writes an empty file. Other columns
    are not read. A document is never cut: a very long one is a block of its own.
    """
    spark = docs.sparkSession
    raw_path = fresh_path(spark, "ids")
    tokenized(docs, spec, end).write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    counts = raw.where("tokens is not null").select("tokens", "freqs").mapInArrow(summed, "token int, freq long") \
        .groupBy("token").agg(F.sum("freq").alias("freq"))
    known = counts.orderBy("token").collect()  # a row per id of the vocabulary at most
    tokens = np.array([r["token"] for r in known], np.int64)
    lengths = code_lengths(np.array([r["freq"] for r in known], np.int64))
    spark.createDataFrame([(int(t), int(n)) for t, n in zip(tokens, lengths)], "token int, length int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast((tokens, lengths))
    schema = pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, codec = Codebook(*book.value), pa.Codec("zstd", 1)
        for batch in batches:
            for one in slices(batch, 1):
                row = one.to_pylist()[0]
                ids = unpack(row["ids"], codec)
                bits, offsets = codes.encode(ids)
                out = (row["part"], row["seq"], row["start"], row["doc_ids"], row["counts"], len(ids), offsets, bits)
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, out))], schema=schema)

    # ids of all tasks before: a row per task
    ends = raw.where("seq is null").select("part", "at")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ends.select("part", F.coalesce(F.sum("at").over(before), F.lit(0)).alias("shift"))
    blocks = raw.where("seq is not null").join(F.broadcast(shifts), "part").select(
        "part", "seq", (F.col("at") + F.col("shift")).alias("start"), "doc_ids", "counts", "ids")
    blocks.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written file: ``doc_id, start, n_tokens, ids``, the ids as little-endian 32-bit integers."""
    known = spark.read.parquet(f"{path}/codebook").collect()  # a row per id of the vocabulary at most
    book = spark.sparkContext.broadcast((np.array([r["token"] for r in known], np.int64),
                                         np.array([r["length"] for r in known], np.int64)))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codebook(*book.value)
        for batch in batches:
            for one in slices(batch, 1):
                row = one.to_pylist()[0]
                ids = codes.decode(row["bits"], row["offsets"], row["n"])
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - counts),
                    pa.array(counts), pa.array([raw[4 * (e - c):4 * e] for e, c in zip(ends.tolist(), counts.tolist())],
                                               pa.binary())], schema=schema)

    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def encoded_documents(docs: DataFrame, spec: str, end: int = END) -> DataFrame:
    """Write all documents to a file, read it back and give ``doc_id, start, n_tokens, ids_crc32``."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_ids(docs, spec, path, end)
    return read_ids(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
