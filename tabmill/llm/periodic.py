"""Periodic runs of words, found by minimizers of several scales.

A run is a stretch of words with smallest period q, at least ``times`` periods and ``least`` words long, that no neighbouring word
extends. The scale k, a power of two, finds the periods from k / 2 + 1 to k: grams of k words cover a whole period there, so those of
different phase differ, and the least gram of every window of k grams, its minimizer, comes back at the distance of the period. Two
minimizers that are equal and no more than k words apart overlap, which already proves the period of the stretch they cover; it is
extended to both sides on the words themselves. Periods up to ``SHORT`` have grams too short to tell anything: these lags are
compared one by one. Of one stretch found with several periods the smallest stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabmill.llm.common import slices
from tabmill.llm.setjoin import mix

SHORT = 8              # periods up to this are found by comparing lags; a power of two
TIMES = 4              # periods a run has at least; fewer would not hold two minimizers of its scale
LEAST = 6              # words a run has at least
BATCH_BYTES = 1 << 22  # of text whose words are searched together

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def window(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` consecutive values: running extremes of blocks, forwards and backwards."""
    pick, empty = (np.minimum, np.iinfo(np.uint64).max) if least else (np.maximum, 0)
    count = len(values) - width + 1
    blocks = np.full((-(-len(values) // width), width), empty, np.uint64)
    blocks.ravel()[:len(values)] = values
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:count], ahead[width - 1:width - 1 + count])


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places whose gram is the least of some window of ``width`` grams, all of several equal ones."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = window(grams, width, True)
    around = np.zeros(len(grams) + width - 1, np.uint64)
    around[width - 1:width - 1 + len(least)] = least
    return np.flatnonzero(window(around, width, False) == grams)


def lag_runs(words: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal stretches of ``least`` or more words with period ``lag``."""
    same = np.zeros(max(0, len(words) - lag) + 2, np.int8)
    same[1:-1] = words[lag:] == words[:-lag]
    edge = np.diff(same)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + lag
    long = end - start >= least
    return start[long], end[long]


def seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of equal minimizers next to each other that are more than half a scale and at most a scale apart."""
    places = minimizers(grams, scale)
    order = np.argsort(grams[places], kind="stable")
    places = places[order]
    distance = np.diff(places)
    found = np.flatnonzero((grams[places[1:]] == grams[places[:-1]]) & (distance > scale // 2) & (distance <= scale))
    return places[found], distance[found]


def find_runs(words: np.ndarray, lengths: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, ordered by start and period.

    ``words`` numbers the words of several texts, each followed by a number found nowhere else; ``lengths`` are the texts' word counts.
    """
    if times < TIMES:
        raise ValueError(f"minimizers find runs of {TIMES} periods or more")
    found = []
    for lag in range(1, min(SHORT, len(words)) + 1):
        start, end = lag_runs(words, lag, max(least, times * lag))
        found.append(np.stack([start, end, np.full(len(start), lag)], axis=1))
    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    grams, at, scale = mix(words.astype(np.uint64)), np.arange(len(words)), 1
    text = np.repeat(np.arange(len(lengths)), lengths + 1)
    while True:
        with np.errstate(over="ignore"):  # grams of twice as many words; one that leaves its text holds the number that is found nowhere else
            after = np.concatenate([grams[scale:], mix(at[len(grams) - min(scale, len(grams)):].astype(np.uint64))])
            grams = mix(grams * np.uint64(3) + after)
        scale *= 2
        if scale <= SHORT:
            continue
        enough = lengths[text] >= times * (scale // 2 + 1)
        if not enough.any():
            break
        grams, at, text = grams[enough], at[enough], text[enough]
        place, distance = seeds(grams, scale)
        pairs = np.unique(np.stack([text[place], distance, at[place]], axis=1), axis=0) if len(place) else np.zeros((0, 3), np.int64)
        cuts = np.flatnonzero(np.any(np.diff(pairs[:, :2], axis=0) != 0, axis=1)) + 1
        for some in np.split(pairs, cuts) if len(pairs) else []:
            number, lag = some[0, :2]
            own = words[first[number]:first[number] + lengths[number]]
            broken = np.concatenate([[-1], np.flatnonzero(own[lag:] != own[:-lag]), [len(own) - lag]])
            spot = np.unique(np.searchsorted(broken, some[:, 2] - first[number]))
            start, end = broken[spot - 1] + 1, broken[spot] + lag
            long = end - start >= max(least, times * lag)
            found.append(np.stack([start[long] + first[number], end[long] + first[number], np.full(long.sum(), lag)], axis=1))
    runs = np.concatenate(found).astype(np.int64) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = np.any(runs[1:, :2] != runs[:-1, :2], axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def runs(docs: DataFrame, rewrite: Rewrite | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document: its runs by start and period, and its text with one period of each.

    ``runs`` holds ``start, length, period`` in words; ``collapsed`` joins the words that stay by one blank. Whole texts, whatever their length, cut at ASCII white
    space; words are equal if their bytes are. ``rewrite`` changes the words of a document before the search. Null and empty texts
    have no words, no runs and an empty ``collapsed``; repeated rows and null ids are rows like others; an empty table gives no rows;
    other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.binary())])

    def search(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        lengths = np.array([len(t) for t in texts], np.int64)
        numbers = np.zeros(int(lengths.sum()) + len(texts), np.int64)
        first = 0
        for i, own in enumerate(texts):
            numbers[first:first + len(own)] = [known.setdefault(w, len(known)) for w in own]
            numbers[first + len(own)] = -1 - i
            first += len(own) + 1
        found = find_runs(numbers, lengths, least, times)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
        ends = np.searchsorted(found[:, 0], starts)
        collapsed = []
        for i, own in enumerate(texts):
            mine = found[ends[i]:ends[i + 1]] - np.array([starts[i], starts[i], 0])
            found[ends[i]:ends[i + 1]] = mine
            collapsed.append(b" ".join(kept_words(own, mine)))
        spans = pa.StructArray.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], fields=list(RUN))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans),
                                           pa.array(collapsed, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                ids, texts, held = [], [], 0
                for doc_id, text in zip(*[c.to_pylist() for c in some.columns]):
                    words = text.split() if text else []
                    ids.append(doc_id)
                    texts.append(rewrite(doc_id, words) if rewrite else words)
                    held += len(text or b"")
                    if held >= BATCH_BYTES:
                        yield search(ids, texts)
                        ids, texts, held = [], [], 0
                if ids:
                    yield search(ids, texts)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return given.mapInArrow(run, RUNS.replace("collapsed string", "collapsed binary")) \
        .withColumn("collapsed", F.col("collapsed").cast("string"))
