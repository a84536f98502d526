"""Benchmark decontamination over a positional inverted index of the training words.

The index is cut by documents: a segment holds some whole documents, the sorted distinct terms of these and
for each term the sorted places where it stands. A test phrase is looked up in every segment: places of its
rarest term there, shifted to where the phrase would start, are intersected with those of the next rarest, and so on.
No posting is moved between tasks, and a term that stands in every document is only looked up where a rarer one led.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabmill.llm.common import LOWER, arrow_type, slices, text_key, texts
from tabmill.session import cut, fresh_path

WINDOW = 10
SLOP = 1                   # words off its place that a term of a near hit may stand: one put in, left out or moved
MISSING = 1                # terms of a full window that a near hit may lack: one left out or changed
SEGMENT = 1_000_000        # words after which a segment is closed, at the end of a document
TEST_WORDS = 2_000_000     # words of the test items that are looked up in one pass: what is sent to each task
CANDIDATES = 4_000_000     # places followed at once

# Fixed set: A-Z become a-z; digits, a-z and all from code point 128 on are word characters
CLEAN = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in LOWER)

SEGMENTS = "segment long, doc_ids array<long>, starts array<long>, terms binary, firsts binary, places binary"
MATCHES = "segment long, ordinal int, doc_id long, item string, start long, stop long, exact boolean"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(CLEAN).split() if text else []


class Numbers(dict):
    """Numbers keys as they come."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def build_index(docs: DataFrame) -> DataFrame:
    """Write the index of all words of all documents and give its segments, a row each."""
    schema = pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in SEGMENTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        keys, starts, numbers, ids, held = [], [0], Numbers(), [], 0

        def close() -> pa.RecordBatch:
            nonlocal segment, keys, starts, numbers, ids, held
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            places = np.argsort(flat, kind="stable").astype(np.int32)
            firsts = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(numbers)))]).astype(np.int64)
            row = (segment, keys, starts, b" ".join(numbers), firsts.tobytes(), places.tobytes())
            segment, keys, starts, numbers, ids, held = segment + 1, [], [0], Numbers(), [], 0
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema=schema)

        for batch in batches:
            for some in slices(batch):
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    own = words(text)
                    ids.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
                    keys.append(key)
                    held += len(own)
                    starts.append(held)
                    if held >= SEGMENT:
                        yield close()
        if keys:
            yield close()

    path = fresh_path(docs.sparkSession, "index")
    texts(docs).mapInArrow(run, SEGMENTS).write.parquet(path)
    return docs.sparkSession.read.schema(SEGMENTS).parquet(path)


class Phrases(NamedTuple):
    """Test phrases: terms by number, with -1 behind the last, and the item of each phrase."""

    terms: list[bytes]
    grid: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    names: list[str]


def phrases(items: list[tuple[str, str]], window: int = WINDOW) -> Phrases:
    """Windows of the items' words; an item of fewer words, but not none, is one window."""
    numbers, rows, owners, names = Numbers(), {}, [], []
    for name, text in items:
        ids = [numbers[w] for w in words(text)]
        names.append(name)
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            rows.setdefault((len(names) - 1, tuple(ids[at:at + window])))
    grid = np.full((len(rows), window), -1, np.int64)
    lengths = np.zeros(len(rows), np.int64)
    for i, (owner, ids) in enumerate(rows):
        grid[i, :len(ids)], lengths[i] = ids, len(ids)
        owners.append(owner)
    return Phrases(list(numbers), grid, lengths, np.array(owners, np.int64), names)


def find(row: dict, asked: Phrases, slop: int = 0, missing: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases met in a segment and where they start: ``(phrase numbers, places)``, in parts.

    With ``slop`` a term may stand up to that many words off its place in the phrase, within the document. A phrase of a full
    window may lack ``missing`` of its terms, so one of its ``missing + 1`` rarest is there and leads. What would start before
    its document starts with it.
    """
    segment_terms = row["terms"].split(b" ") if row["terms"] else []
    if not segment_terms or not len(asked.grid):
        return
    firsts, places = np.frombuffer(row["firsts"], np.int64), np.frombuffer(row["places"], np.int32)
    starts = np.array(row["starts"], np.int64)
    local = pc.index_in(pa.array(asked.terms, pa.binary()), pa.array(segment_terms, pa.binary()))
    local = np.asarray(local.fill_null(-1)).astype(np.int64)
    sizes = np.append(np.where(local >= 0, firsts[local + 1] - firsts[local], 0), np.iinfo(np.int64).max)
    local = np.append(local, -1)
    # every posting as (term, place) in one sorted line
    line = (np.repeat(np.arange(len(segment_terms)), np.diff(firsts)) << 32) + places
    width = asked.grid.shape[1]
    allowed = np.where(asked.lengths == width, min(missing, width - 1), 0)
    counts = sizes[asked.grid]
    here = np.flatnonzero((counts == 0).sum(axis=1) <= allowed)
    if not len(here):
        return
    order = np.argsort(counts[here], axis=1, kind="stable")  # rarest first, what is no term last
    for lead in range(int(allowed[here].max()) + 1):
        rarest = np.where(lead <= allowed[here], counts[here, order[:, lead]], 0)
        groups = np.cumsum(rarest * (2 * slop + 1)) // CANDIDATES
        for g in np.unique(groups):
            some = np.flatnonzero((groups == g) & (rarest > 0))
            spread = np.repeat(some, rarest[some])
            offset = order[spread, lead]
            term = local[asked.grid[here[spread], offset]]
            nth = np.arange(len(spread)) - np.repeat(np.cumsum(rarest[some]) - rarest[some], rarest[some])
            place = places[firsts[term] + nth].astype(np.int64)
            doc = np.searchsorted(starts, place, "right") - 1
            spread, doc = np.repeat(spread, 2 * slop + 1), np.repeat(doc, 2 * slop + 1)
            start = ((place - offset)[:, None] + np.arange(-slop, slop + 1)).ravel()
            if not slop and not missing:
                fits = (start >= starts[doc]) & (start + asked.lengths[here[spread]] <= starts[doc + 1])
                spread, start, doc = spread[fits], start[fits], doc[fits]
            lacking = np.zeros(len(spread), np.int64)
            for k in range(width):
                if k == lead:
                    continue
                if not len(spread):
                    break
                at = order[spread, k]
                number = asked.grid[here[spread], at]
                base = local[number] << 32
                low = base + np.maximum(start + at - slop, starts[doc])  # not past the document's own words
                high = base + np.minimum(start + at + slop, starts[doc + 1] - 1)
                spot = np.searchsorted(line, low)
                got = line[np.minimum(spot, len(line) - 1)]
                met = (number < 0) | ((local[number] >= 0) & (spot < len(line)) & (got >= low) & (got <= high))
                lacking += ~met
                left = lacking <= allowed[here[spread]]
                spread, start, doc, lacking = spread[left], start[left], doc[left], lacking[left]
            yield here[spread], np.maximum(start, starts[doc])


def matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0,
            test_words: int = TEST_WORDS, missing: int = 0) -> DataFrame:
    """Where phrases of the items stand: ``segment, ordinal, doc_id, item, start, stop, exact``.

    Places are word numbers within a document, ``stop`` is one past the last; phrases of one item that overlap are
    joined. With ``slop`` or ``missing``, phrases whose terms stand up to that many words off, full windows that lack
    that many terms, are given as well, with ``exact`` false.
    The test items are looked up in passes of about ``test_words`` words, all of them against all segments.
    """
    spark = index.sparkSession
    tests = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                         F.col("text").cast("string").alias("text")).where("text is not null")
    rough = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-rough // (5 * test_words)))
    numbered = tests.withColumn("pass", F.pmod(F.xxhash64("item", "text"), F.lit(passes)))
    schema = pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in MATCHES.split(", ")])
    found = None
    for i in range(passes):
        own = sorted((r["item"], r["text"]) for r in numbered.where(F.col("pass") == i).collect())  # one pass's words
        asked = spark.sparkContext.broadcast(phrases(own, window))

        def run(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for one in slices(batch, 1):
                    row = one.to_pylist()[0]
                    rows = [r for exact in ([True, False] if slop or missing else [True])
                            for r in joined(row, asked.value, 0 if exact else slop, exact, 0 if exact else missing)]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema)

        part = index.mapInArrow(run, MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def joined(row: dict, asked: Phrases, slop: int, exact: bool, missing: int = 0) -> list[tuple]:
    """Match rows of a segment, phrases of an item that overlap in one row."""
    parts = list(find(row, asked, slop, missing))
    if not parts:
        return []
    number, start = (np.concatenate(p) for p in zip(*parts))
    if not len(number):
        return []
    item, stop = asked.items[number], start + asked.lengths[number]
    order = np.lexsort((start, item))
    item, start, stop = item[order], start[order], stop[order]
    starts = np.array(row["starts"], np.int64)
    doc = np.searchsorted(starts, start, "right") - 1
    stop = np.minimum(stop, starts[doc + 1])  # a near phrase may end past its document
    # windows of one length do not nest, and an item has one length
    fresh = np.ones(len(item), bool)
    fresh[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])
    heads = np.flatnonzero(fresh)
    ends = np.append(heads[1:], len(item)) - 1
    doc = doc[heads]
    return [(row["segment"], d, row["doc_ids"][d], asked.names[i], int(a - starts[d]), int(b - starts[d]), exact)
            for d, i, a, b in zip(doc.tolist(), item[heads].tolist(), start[heads], stop[ends])]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, missing: int = 0) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near``.

    A null or empty text has no words and no hit, as a null item has no window. Items without an id count as
    item ''. Repeated rows and ids are judged one by one; windows of items with one id are that item's. Empty tables give no rows
    or no hits; other columns are not read. ``n_near`` counts items met only within ``slop`` words, or
    without ``missing`` of a full window's terms; the other columns are about exact phrases.
    """
    index = build_index(docs)
    found = cut(matches(index, items, window, slop, missing=missing))
    exact = found.where("exact").groupBy("segment", "ordinal").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))

    def cover(acc, s):  # spans come by their start
        return F.struct((acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["upto"], s["start"]))).cast("long").alias("n"),
                        F.greatest(acc["upto"], s["stop"]).alias("upto"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    hits = exact.select("segment", "ordinal", "items", F.aggregate("spans", zero, cover, lambda a: a["n"]).alias("hit"))
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", F.slice("starts", F.lit(1), F.size("doc_ids")).alias("a"),
                                                             F.slice("starts", F.lit(2), F.size("doc_ids")).alias("b")))) \
        .select("segment", F.col("pos").alias("ordinal"), F.col("col.doc_ids").alias("doc_id"),
                (F.col("col.b") - F.col("col.a")).alias("n_words"))
    near = found.where("not exact").groupBy("segment", "ordinal").agg(F.collect_set("item").alias("near"))
    every = rows.join(hits, ["segment", "ordinal"], "left").join(near, ["segment", "ordinal"], "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return every.select(
        "doc_id", "n_words", F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"),
        F.size(F.array_except(F.coalesce("near", F.array().cast("array<string>")), items_)).cast("long").alias("n_near"))


def without_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents that hold no phrase of an item: rows of ``docs``, all columns, whatever their ids. Near hits stay."""
    keyed = docs.select(text_key().alias("doc_id"), "text").where("text is not null")
    found = matches(build_index(keyed), items, window)
    gone = cut(found.select(F.col("doc_id").alias("gone_key")).distinct())
    return docs.join(gone, text_key() == gone["gone_key"], "left_anti")
