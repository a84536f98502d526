"""Language proportions of each document by expectation-maximisation over letter trigrams.

A language is a distribution over trigrams, learned from labelled texts. A document is a mixture of languages;
its proportions maximise the likelihood of its trigrams, and the set of languages is the one whose likelihood,
less a penalty for each language, is largest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabmill.llm.common import arrow_type, quoted, slices, texts

BINS = 1 << 16         # a trigram is one of so many hashes
SMOOTH = 0.5           # added to each count
PIECE = 1_000_000      # characters of a text taken at a time
PENALTY = 2.0          # log likelihood, times the log of the number of trigrams, that a language must bring
STEPS = 30             # of expectation-maximisation
SMALL = 0.01           # a language below this share is left out at once
DOUBT = 10.0           # log likelihood by which evenly drawn trigrams must be likelier before a text is of no language
NONE = "und"

FIT = "lang string, gram int, n long"
OUT = "doc_id long, lang_pred string, score double, shares string"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """True for code points that are letters."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def grams(text: str) -> np.ndarray:
    """Hashes of the trigrams of the lower-cased text; what is no letter counts as one blank."""
    parts = []
    for at in range(0, len(text), PIECE):
        code = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        code = np.where(letters()[code], code, 0)
        parts.append(code)
    code = np.concatenate([[0], *parts, [0]]).astype(np.uint32)
    code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]
    mixed = code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) ^ code[2:] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> 15)) * np.uint32(0x27D4EB2F)
    return ((mixed ^ (mixed >> 13)) >> 16)[code[1:-1] != 0]


class Languages:
    """What was learned: names, and the probability of each trigram hash in each language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + SMOOTH
        self.chance = np.ascontiguousarray((smooth / smooth.sum(axis=1, keepdims=True)).T) if names else np.zeros((BINS, 0))


def fit(docs: DataFrame) -> Languages:
    """Count the trigrams of all texts by their ``lang``; rows without a text or a lang teach nothing.

    Each task adds up its own rows, so a language of most rows is no hot key. What comes to the driver is a number per
    language and trigram hash, whatever the rows.
    """
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for some in slices(batch):
                for text, lang in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    if lang not in totals:
                        totals[lang] = np.zeros(BINS, np.int64)
                    totals[lang] += np.bincount(grams(text), minlength=BINS)
        for lang, n in totals.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)),
                                              pa.array(n[seen])], schema=schema)

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .where("text is not null and lang is not null").mapInArrow(run, FIT) \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(rows["lang"].to_pylist()))
    counts = np.zeros((len(names), BINS))
    spot = {name: i for i, name in enumerate(names)}
    counts[[spot[x] for x in rows["lang"].to_pylist()], np.asarray(rows["gram"])] = np.asarray(rows["n"])
    return Languages(names, counts)


def proportions(chance: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the columns of ``chance`` that best explain ``n``, and the log likelihood they reach."""
    share = start
    for _ in range(STEPS):
        mixed = chance @ share
        new = share * ((n / mixed) @ chance) / n.sum()
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(chance @ share))


def infer(model: Languages, text: str | None, penalty: float = PENALTY) -> list[tuple[str, float]]:
    """Languages of a text and their shares, largest first; nothing without a letter or a language to choose."""
    return mixture(model, text, penalty)[0]


def mixture(model: Languages, text: str | None, penalty: float = PENALTY) -> tuple[list[tuple[str, float]], float]:
    """Languages of a text as ``infer`` gives them, and by what log likelihood they beat trigrams drawn evenly.

    Starts from all languages and leaves out the smallest as long as the penalised likelihood grows.
    """
    found = grams(text) if text else np.zeros(0, np.uint32)
    if not len(found) or not model.names:
        return [], 0.0
    bins, n = np.unique(found, return_counts=True)
    n = n.astype(float)
    chance = model.chance[bins]
    price = penalty * np.log(len(found) + 1)
    kept = np.arange(len(model.names))
    share, fit_ = proportions(chance, n, np.full(len(kept), 1 / len(kept)))
    while len(kept) > 1:
        fewer = share >= SMALL
        if fewer.all():
            fewer[np.argmin(share)] = False  # the first of equal ones
        left = share[fewer] / share[fewer].sum()
        fewer_share, fewer_fit = proportions(chance[:, kept[fewer]], n, left)
        if fewer_fit + price * (len(kept) - fewer.sum()) <= fit_:
            break
        kept, share, fit_ = kept[fewer], fewer_share, fewer_fit
    order = np.lexsort((kept, -share))
    return [(model.names[kept[i]], float(min(1.0, share[i]))) for i in order], float(fit_ + len(found) * np.log(BINS))


def held_out() -> Column:
    """Rows that teach nothing and are for testing: crc32 of the id as text, modulo 3, is 1."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def predict(docs: DataFrame, model: Languages, *extra: str) -> DataFrame:
    """``doc_id, lang_pred, score, shares`` of every whole text, and columns named in ``extra``.

    ``lang_pred`` is the language with the largest share, the first by name of equal ones, and ``score`` that share;
    ``shares`` lists all of the set. A null or empty text, one without a letter, and any text when nothing was learned are
    ``und`` with score 0. Very long texts are read in pieces. Repeated rows are judged alike; an empty table gives no rows.
    """
    given = docs.sparkSession.sparkContext.broadcast(model)  # trigram hashes times languages, whatever the rows
    kinds = dict(docs.dtypes)
    schema = ", ".join([OUT, *[f"{c} {kinds[c]}" for c in extra]])
    types = [arrow_type(f.split()[1]) for f in OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                rows = []
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    own = infer(given.value, text)
                    first = own[0] if own else (NONE, 0.0)
                    rows.append((key, *first, " ".join(f"{name}:{share:.4f}" for name, share in own)))
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*arrays, *some.columns[2:]],
                                                 names=[*(f.split()[0] for f in OUT.split(", ")), *extra])

    return texts(docs, *extra).mapInArrow(run, schema)


def identified(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all: ``doc_id, held_out, lang_pred, score, shares``."""
    model = fit(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "shares")


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents of which one language makes up ``least`` or more: rows of ``docs``, all columns.

    The languages are learned from all rows that have a ``lang``. Texts without a letter (null and empty ones too) go, and
    texts that no language explains by that share, and those to which evenly drawn trigrams are likelier than any mixture by
    ``DOUBT``: a language that was never learned, or none. Without any ``lang`` nothing is learned and all rows go. Equal
    texts are judged alike, an empty table gives no rows. Columns of any name and type are kept as they are: only the text
    goes to Python, with the whole row beside it.
    """
    model = fit(docs)
    whole = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"))
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                keep = []
                for text in some.column(0).to_pylist():
                    own, gain = mixture(given.value, text)
                    keep.append(bool(own) and own[0][1] >= least and gain > -DOUBT)
                yield some.select([1]).filter(pa.array(keep, pa.bool_()))

    return whole.select(F.col("row.text").cast("string").alias("text"), "row").mapInArrow(
        run, whole.schema).select("row.*")
