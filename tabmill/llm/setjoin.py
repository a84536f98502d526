"""Exact Jaccard join of word shingle sets by universe partitioning.

Two sets linked by Jaccard differ in at most t shingles, and t follows from their sizes. The universe of shingles is
cut into segments by hash; if the thresholds of the segments, each plus one, add up to more than t, some segment of two linked
sets differs by no more than its threshold. A segment with threshold 0 is indexed by its subset; one with threshold 1 by its
subset and all subsets with one shingle less. Sets are joined within bands of similar size; how many segments of
either kind a band has is the cheapest of all sufficient choices for the number of sets in it.

Unrelated sets agree in segments that are empty in both, the more pairs of them the more sets there are. With spare segments two
linked sets agree in more than one; a set with no more empty segments than it has to spare agrees in one that is not empty,
whatever it is linked with. Its empty segments are not indexed.

Sets that meet under a key are candidates. Those of a bucket are compared among themselves, in blocks, by parity sketches that
never exclude a linked pair; what passes is verified on the words. ``links`` gives all linked pairs. ``rooted`` gives components only:
there all sets of a bucket are first checked against one, and only those still apart after that are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabmill.llm.common import LOWER, TEXTS, WORD, arrow_type, slices, text_key, texts
from tabmill.session import cut

SHINGLE = 4
LIMIT = (85, 100)      # least similarity, as a fraction
LARGE = 64             # sets from which a bucket is large
BLOCK = 512            # sets of a bucket that are compared with as many others at a time
CHECK_COST = 0.02      # cost of comparing the sketches of two sets of a bucket, in index entries
MEET_COST = 10         # cost of a set in a bucket of several, in index entries
DEALS = 4              # parts in which the sets of a block are dealt for the verification of all pairs
SHARES = 4             # of the keys, whose sets are compared one share after the other where only components are asked for
WORD_BYTES = 6         # of a text, about: only to guess set sizes for the costs
ROWS = 10_000          # rows without texts that go to Python at a time
KNOWN = 200_000        # words of which a worker remembers the hash, and sets whose keys a task has given

# Fixed odd multipliers of a published 64-bit mixer
MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

SETS = "doc_id long, text_key long, n int, h long, sketch binary"
PAIRS = "key long, i int, j int, a long, b long"


def mix(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of 64 bits."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + STEP
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def shingle_set(own: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    if len(own) < width:
        return {tuple(own)} if own else set()
    return set(zip(*[own[i:] for i in range(width)]))


@lru_cache(maxsize=16)
def multipliers(width: int) -> np.ndarray:
    """An odd one for each place of a shingle."""
    return mix(np.arange(width, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(own: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words are one shingle."""
    if not own:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, own), np.uint64, len(own))
    spots = max(1, len(h) - width + 1)
    odd = multipliers(width)
    with np.errstate(over="ignore"):
        total = np.full(spots, len(h) if len(h) < width else width, np.uint64)
        for i in range(min(width, len(h))):  # the words' hashes are mixed well already: an odd multiplier for each place is enough
            total += h[i:i + spots] * odd[i]
    return np.unique(mix(total))


def apart(size: int, limit: tuple[int, int]) -> int:
    """Shingles that are in one of two linked sets only, at most, if the sets have ``size`` together."""
    return (limit[1] - limit[0]) * size // (limit[1] + limit[0])


@lru_cache(maxsize=4096)
def band_start(number: int, limit: tuple[int, int]) -> int:
    """Least size of a band; a band spans the square of the size ratio of linked sets."""
    start = 1
    for _ in range(number):
        start = start * limit[1] ** 2 // limit[0] ** 2 + 1
    return start


def bands(size: int, limit: tuple[int, int]) -> list[int]:
    """Bands a set takes part in: its own, and the next if a linked set may be there."""
    low = 0
    while band_start(low + 1, limit) <= size:
        low += 1
    return [low, low + 1] if size * limit[1] >= limit[0] * band_start(low + 1, limit) else [low]


@lru_cache(maxsize=4096)
def allocation(number: int, sets: int, limit: tuple[int, int]) -> tuple[int, int, bool]:
    """Segments indexed by subset, those indexed by subset and deletions, and whether empty subsets are refined.

    The least of what ``sets`` sets of the band cost: entries per set, and pairs of unrelated sets that agree in a segment as both
    are empty there. Subsets that are empty are indexed of sets only that have more of them than segments to spare. Refined,
    such a subset is indexed together with each segment of a second partition, of which two linked sets agree in one as well.
    """
    top = band_start(number + 1, limit) - 1
    need = apart(2 * top, limit) + 1
    low = max(1, limit[0] * band_start(number, limit) // limit[1])
    sizes = [round(low * (top / low) ** (i / 8)) for i in range(9)]
    choices = []
    for deletions in sorted({round(need / 2 * i / 16) for i in range(17)} | {(need + 1) // 2}):
        for spare in sorted({round(need * i / 80) for i in range(13)} | set(range(5))):
            plain = max(0, need - 2 * deletions) + spare
            filled = many = meet = both = 0.0  # means over sizes of the band
            for size in sizes:
                mean = size / (plain + deletions)
                empty = plain * math.exp(-mean)
                room = to_spare(size, number, plain, deletions, limit) + 0.5 - empty
                part = math.erfc(room / math.sqrt(2 * empty)) / 2 if empty else 0.0
                filled += (plain - empty + deletions * (1 + mean)) / len(sizes)
                many += part / len(sizes)
                meet += part * max(empty, empty + room) / len(sizes)
                both += deletions * math.exp(-2 * mean) * (1 + mean) ** 2 / len(sizes)
            for refined in (False, True):
                chance = many ** 2 * min(1.0, (meet / many) ** 2 / plain) * (math.exp(-2 * low / need) if refined else 1) if many else 0.0
                cost = filled + meet * (need if refined else 1 + MEET_COST) + CHECK_COST * sets / 2 * min(1.0, chance + both)
                choices.append((cost, plain, deletions, refined))
    return min(choices)[1:]


def to_spare(size: int, number: int, plain: int, deletions: int, limit: tuple[int, int]) -> int:
    """Segments that a set of ``size`` agrees in with any linked one of the band, less one: of those indexed by deletions, one counts as two."""
    other = min(band_start(number + 1, limit) - 1, size * limit[1] // limit[0])
    return plain + 2 * deletions - 1 - apart(size + other, limit)


def segment_sums(values: np.ndarray, seed: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each value, the values' mixed forms, and per segment the sum of these and their number."""
    with np.errstate(over="ignore"):
        own = mix(values ^ mix(np.array([seed], np.uint64)))
        segment = ((own >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(count, np.uint64)
        np.add.at(sums, segment, own)
    return segment, own, sums, np.bincount(segment, minlength=count)


def index_keys(values: np.ndarray, limit: tuple[int, int], plan: dict[int, tuple[int, int, bool]]) -> np.ndarray:
    """Keys of a set in all its bands."""
    out = []
    for number in bands(len(values), limit):
        plain, deletions, refined = plan.get(number) or allocation(number, 1, limit)
        segment, own, sums, counts = segment_sums(values, 2 * number + 1, plain + deletions)
        with np.errstate(over="ignore"):
            tag = mix(np.arange(plain + deletions, dtype=np.uint64) + np.uint64(number) * STEP)
            keys = mix(sums ^ tag)
            exact, empty = keys[:plain], counts[:plain] == 0
            bare = exact[:0]
            if empty.sum() <= to_spare(len(values), number, plain, deletions, limit):
                exact = exact[~empty]
            elif refined:
                exact, bare = exact[~empty], exact[empty]
            out.append(exact)
            if len(bare):
                _, _, again, _ = segment_sums(values, 2 * number + 2, apart(2 * (band_start(number + 1, limit) - 1), limit) + 1)
                second = mix(again ^ mix(np.arange(len(again), dtype=np.uint64) + STEP))
                out.append(mix(bare[:, None] + second[None, :] * np.uint64(3)).ravel())
            if deletions:
                out.append(keys[plain:])
                inside = segment >= plain
                out.append(mix((sums[segment[inside]] - own[inside]) ^ tag[segment[inside]]))
    return np.unique(np.concatenate(out))


def sketch(values: np.ndarray, limit: tuple[int, int]) -> bytes:
    """Parity of the number of values per cell: two sketches differ in no more cells than the sets in values."""
    cells = 64
    while cells < 8 * apart(2 * len(values), limit):
        cells *= 2
    odd = np.bincount((values & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(sketches: list[bytes]) -> np.ndarray:
    """Sketches brought to the least size among them, a row of 64-bit words each."""
    least = min(map(len, sketches))
    out = np.zeros((len(sketches), least // 8), np.uint64)
    for i, s in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, least // 8), axis=0)
    return out


def banded(docs: DataFrame, limit: tuple[int, int]) -> dict[int, tuple[int, int, bool]]:
    """How each band is indexed, by the number of its sets as the length of their texts tells: a row per band comes here."""
    n = F.greatest(F.lit(1.0), F.octet_length(F.col("text").cast("string")) / WORD_BYTES)
    step = 2 * math.log(limit[1] / limit[0])
    sizes = docs.where("text is not null").groupBy(F.floor(F.log(n) / step).alias("size")).count().collect()
    many: dict[int, int] = {}
    for r in sizes:
        for number in bands(max(1, round(math.exp(r["size"] * step))), limit):
            many[number] = many.get(number, 0) + r["count"]
    return {number: allocation(number, n, limit) for number, n in many.items()}


def set_hash(values: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(values ^ STEP).sum() + np.uint64(len(values))])).view(np.int64)[0])


def sets(docs: DataFrame, width: int, limit: tuple[int, int], plan: dict[int, tuple[int, int, bool]] | None = None) -> DataFrame:
    """Set size, set hash and sketch of every document, and the key of its text; with ``plan`` also the keys of its set in the index, ``keys``.

    A task gives the keys of a set once, as long as it remembers the set; what it forgets is only given again.
    """
    fields = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int32()), ("h", pa.int64()), ("sketch", pa.binary())]
    schema = pa.schema(fields + [("keys", pa.list_(pa.int64()))] * (plan is not None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for some in slices(batch, 64 if plan is not None else 512):
                rows = []
                for doc_id, text, key in zip(*[c.to_pylist() for c in some.columns]):
                    values, keys = shingle_hashes(words(text), width), None
                    row = (doc_id, key, len(values), set_hash(values), sketch(values, limit)) if len(values) else (doc_id, key, 0, None, None)
                    if plan is not None:
                        if len(values) and row[3] not in given:
                            if len(given) >= KNOWN:
                                given.clear()
                            given.add(row[3])
                            keys = index_keys(values, limit, plan).view(np.int64)
                        row = (*row, keys)
                    rows.append(row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return texts(docs).withColumn("text_key", text_key()).mapInArrow(run, SETS + ", keys array<long>" * (plan is not None))


def entries(docs: DataFrame, width: int, limit: tuple[int, int], plan: dict[int, tuple[int, int, bool]]) -> DataFrame:
    """The index, ``key, h``, made from the texts.

    A task gives the keys of a set once, as long as it remembers the set; what it forgets is only given again.
    """
    schema = pa.schema([("key", pa.int64()), ("h", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for some in slices(batch, 64):
                keys, hs = [], []
                for text in some.column(0).to_pylist():
                    values = shingle_hashes(words(text), width)
                    if not len(values) or (h := set_hash(values)) in given:
                        continue
                    if len(given) >= KNOWN:
                        given.clear()
                    given.add(h)
                    keys.append(index_keys(values, limit, plan).view(np.int64))
                    hs.append(np.full(len(keys[-1]), h, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, hs)], schema=schema)

    return docs.select(F.col("text").cast("string").alias("text")).where("text is not null").mapInArrow(run, "key long, h long")


def cut_clean(df: DataFrame, batch: int | None = None) -> DataFrame:
    """Write and go on from what was written; the exchanges of the write are deleted with its end.

    ``batch``: rows that go to Python at a time, of which both sides hold a batch whole; else as the session has it.
    """
    conf = df.sparkSession.conf
    now = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch:
        now["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch)
    before = {name: conf.get(name, None) for name in now}
    for name, value in now.items():
        conf.set(name, value)
    try:
        return cut(df)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def held_texts(needed: DataFrame, own: DataFrame, docs: DataFrame) -> DataFrame:
    """``h, text``: a text of each set hash in ``needed``."""
    found = needed.distinct().join(own.select("h", "text_key"), "h")
    whole = docs.select(text_key().alias("text_key"), F.col("text").cast("string").alias("text")).where("text is not null")
    return cut_clean(found.join(whole, "text_key").select("h", "text").dropDuplicates(["h"]))


def verified(pairs: DataFrame, own: DataFrame, docs: DataFrame, width: int, limit: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b`` of set hashes that are linked, by the words of one document of each."""
    short = pairs.join(own.select(F.col("h").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a") \
        .join(own.select(F.col("h").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [apart(na + nb, limit) >= int(np.bitwise_count(np.bitwise_xor(*fold([x, y]))).sum())
                    for na, nb, x, y in zip(*[batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb")])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = cut_clean(short.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(near, "a long, b long"), ROWS)
    held = held_texts(close.select(F.col("a").alias("h")).union(close.select(F.col("b").alias("h"))), own, docs)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            for some in slices(batch):
                keep = []
                for x, y in zip(some.column(2).to_pylist(), some.column(3).to_pylist()):
                    if y != last:
                        last, known = y, shingle_set(words(y), width)
                    other = shingle_set(words(x), width)
                    both = len(other & known)
                    keep.append(limit[1] * both >= limit[0] * (len(other) + len(known) - both))
                yield some.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return cut_clean(close.join(held.select(F.col("h").alias("a"), F.col("text").alias("ta")), "a")
               .join(held.select(F.col("h").alias("b"), F.col("text").alias("tb")), "b")
               .select("a", "b", "ta", "tb").mapInArrow(exact, "a long, b long"), TEXTS)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of an edge: the smallest node it is connected with.

    Large and small stars by turns: every node's neighbours are tied to the smallest of them, until nothing changes. A hot
    node is a key of a partial minimum and of a join, never a list.
    """
    now = cut_clean(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut_clean(large)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .union(lowest.select("a", F.col("m").alias("b"))).where("a <> b")
        now = cut_clean(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b"), F.col("b")).distinct())
        state = seen


def still_apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """Of ``key, h``: the buckets that hold sets of several components, ``key, h, root, many``."""
    placed = members.join(components(links).withColumnRenamed("node", "h"), "h", "left").select(
        "key", "h", F.coalesce("root", "h").alias("root"))
    split = placed.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count("*").alias("many")) \
        .where("r1 < r2").select("key", "many")
    return cut_clean(placed.join(split, "key").select("key", "h", "root", "many"))


def apart_pairs(members: DataFrame, own: DataFrame, limit: tuple[int, int]) -> DataFrame:
    """``key, i, j, a, b``: pairs of sets that share a key, have different roots, and whose sketches do not exclude a link.

    ``members`` are ``key, h, root, many``; the pairs come with the bucket and blocks they were found in, maybe several times. A large bucket is split into blocks; each pair of blocks is one group of rows. Sets
    of a family meet in many large buckets: there a pair is given under the least of the large keys it shares only.
    """
    large = members.where(F.col("many") >= LARGE).groupBy("h").agg(F.array_sort(F.collect_list("key")).alias("large"))
    blocks = F.ceil(F.col("many") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("h"), blocks).cast("int")
    spread = members.select("key", "h", "root", block.alias("own_block"),
                            F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")) \
        .select("key", "h", "root", "own_block", F.least("own_block", "other").alias("i"), F.greatest("own_block", "other").alias("j"))
    held = spread.join(own.select("h", "n", "sketch"), "h").join(large, "h", "left") \
        .select("key", "i", "j", "h", "root", "n", "sketch", "large") \
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "h")

    def compare(key: int, i: int, j: int, rows: list[tuple]) -> Iterator[tuple[int, int, int, int, int]]:
        if len(rows) < 2:
            return
        h, root, n = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        bits = fold([r[3] for r in rows])
        for x in range(len(rows) - 1):
            other = np.flatnonzero(root[x + 1:] != root[x]) + x + 1
            if len(other):
                differ = np.bitwise_count(bits[other] ^ bits[x]).sum(axis=1)
                total = n[other] + n[x]
                for y in other[differ <= (limit[1] - limit[0]) * total // (limit[1] + limit[0])]:
                    shared = set(rows[x][4] or ()).intersection(rows[y][4] or ())
                    if key not in shared or key == min(shared):
                        yield key, i, j, *sorted((int(h[x]), int(h[y])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split()[0], arrow_type(f.split()[1])) for f in PAIRS.split(", ")])
        last, rows = (0, 0, 0), []
        for batch in batches:
            found = []
            for key, i, j, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                if (key, i, j) != last:
                    found += compare(*last, rows)
                    last, rows = (key, i, j), []
                rows.append(rest)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)
        found = list(compare(*last, rows))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)

    return held.mapInArrow(run, PAIRS)


def all_verified(pairs: DataFrame, own: DataFrame, docs: DataFrame, width: int, limit: tuple[int, int]) -> DataFrame:
    """Of pairs as ``apart_pairs`` gives them the linked ones, ``a, b``, by the words of one document of each.

    Pairs meet with the texts of their sets in the blocks they were found in: a text goes to blocks, not to pairs.
    """
    deal = F.pmod(F.xxhash64("a"), F.lit(DEALS)) * DEALS + F.pmod(F.xxhash64("b"), F.lit(DEALS))
    group = ["key", "i", "j", "deal"]
    once = cut_clean(pairs.groupBy("a", "b").agg(F.min(F.struct("key", "i", "j")).alias("g")).select("g.*", deal.alias("deal"), "a", "b"), ROWS)
    ends = once.select(*group, F.col("a").alias("h")).union(once.select(*group, F.col("b").alias("h"))).distinct()
    met = ends.join(held_texts(ends.select("h"), own, docs), "h").select(*group, F.col("h").alias("a"), F.lit(None).cast("long").alias("b"), "text") \
        .union(once.select(*group, "a", "b", F.lit(None).cast("string"))) \
        .repartition(*group).sortWithinPartitions(*group, F.col("b").asc_nulls_first(), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, numbers, sets_, here = None, None, {}, {}, np.zeros(0, bool)
        for batch in batches:
            for some in slices(batch):
                out = []
                for *own_group, a, b, text in zip(*[c.to_pylist() for c in some.columns]):
                    if own_group != group:
                        group, last, numbers, sets_ = own_group, None, {}, {}
                    if b is None:  # texts come before the pairs
                        found = shingle_set(words(text), width)
                        sets_[a] = np.fromiter((numbers.setdefault(x, len(numbers)) for x in found), np.int32, len(found))
                        continue
                    if b != last:
                        last, here = b, np.zeros(len(numbers), bool)
                        here[sets_[b]] = True
                    both = int(here[sets_[a]].sum())
                    if limit[1] * both >= limit[0] * (len(sets_[a]) + len(sets_[b]) - both):
                        out.append((a, b))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return cut_clean(met.mapInArrow(run, "a long, b long"), TEXTS)


def meeting(index: DataFrame) -> DataFrame:
    """Of the index ``key, h`` the entries of keys that several sets have, ``key, h, lo``, each once, with the least set of the key.

    All entries are exchanged once, sixteen bytes each; what a task holds of a key is its least set, however many have it.
    """
    schema = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("lo", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least, held = None, None, False  # last entry, the least set of its key, and whether it is the key's only one so far
        for batch in batches:
            key, h = (c.to_numpy() for c in batch.columns)
            if last:
                key, h = (np.concatenate([[x], c]) for x, c in zip(last, (key, h)))
            new = np.concatenate([[held or not last], (key[1:] != key[:-1]) | (h[1:] != h[:-1])])
            key, h = key[new], h[new]
            if not len(key):
                continue
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            many = np.diff(np.append(start, len(key)))
            several, lo = many > 1, h[start]
            if last and not held and key[0] == last[0]:  # a key of which some entries are given already
                several[0], lo[0] = True, least
            given = np.repeat(several, many)
            if given.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[given]) for x in (key, h, np.repeat(lo, many))], schema=schema)
            last, least, held = (key[-1], h[-1]), lo[-1], not several[-1]

    return index.repartition("key").sortWithinPartitions("key", "h").mapInArrow(run, "key long, h long, lo long")


def bucketed(docs: DataFrame, width: int, limit: tuple[int, int], kept: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, their distinct sets, and the members ``key, h, lo`` of buckets of several sets, with the least of each.

    ``kept``, the index is made in the pass over the texts that makes the sets, and written with the documents: less time, and more disk.
    """
    plan = banded(docs, limit)
    whole = cut_clean(sets(docs, width, limit, plan if kept else None), TEXTS)
    own = whole.where("h is not null").groupBy("h").agg(F.min("text_key").alias("text_key"), F.first("n").alias("n"),
                                                       F.first("sketch").alias("sketch"))
    own = cut_clean(own)
    index = whole.select(F.explode("keys").alias("key"), "h") if kept else entries(docs, width, limit, plan)
    return whole, own, cut_clean(meeting(index), ROWS if kept else TEXTS)


def links(docs: DataFrame, width: int = SHINGLE, limit: tuple[int, int] = LIMIT) -> tuple[DataFrame, DataFrame]:
    """All links: documents ``doc_id, text_key, n, h``, and the linked pairs ``a, b`` of set hashes ``h``, each once, ``a < b``.

    In a family of n different sets these are up to n (n - 1) / 2.
    """
    whole, own, members = bucketed(docs, width, limit, kept=True)
    many = members.groupBy("key").agg(F.count("*").alias("many"))
    every = members.join(many, "key").select("key", "h", F.col("h").alias("root"), "many")  # each set its own root
    return whole.select("doc_id", "text_key", "n", "h"), all_verified(apart_pairs(every, own, limit), own, docs, width, limit)


def with_roots(whole: DataFrame, pairs: DataFrame) -> DataFrame:
    roots = cut_clean(components(pairs))
    return whole.select("doc_id", "text_key", "n", "h").join(roots.withColumnRenamed("node", "h"), "h", "left") \
        .withColumn("root", F.coalesce("root", "h"))


def rooted(docs: DataFrame, width: int, limit: tuple[int, int]) -> DataFrame:
    """``doc_id, text_key, n, h, root`` of every document: ``root`` is one of its component's set hashes, null without words.

    Components only: pairs that are connected already are not compared, so most links of a family are never looked for.
    """
    whole, own, members = bucketed(docs, width, limit, kept=True)
    stars = cut_clean(members.where("h <> lo").select(F.col("lo").alias("a"), F.col("h").alias("b")).distinct())
    found = verified(stars, own, docs, width, limit)
    left = still_apart(members.drop("lo"), found)
    near = None
    for i in range(SHARES):  # sets are moved to a share of the keys at a time, as each is moved with its sketch to every bucket it is in
        some = left.where(F.pmod(F.xxhash64("key"), F.lit(SHARES)) == i)
        pairs = cut_clean(apart_pairs(some, own, limit).select("a", "b").distinct(), ROWS)
        near = pairs if near is None else near.union(pairs)
    rest = near.distinct().join(stars, ["a", "b"], "left_anti")
    return with_roots(whole, found.union(verified(rest, own, docs, width, limit)))


def linked(docs: DataFrame, width: int = SHINGLE, limit: tuple[int, int] = LIMIT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document, whole texts.

    Documents link when the Jaccard similarity of their sets of ``width``-word shingles is ``limit`` or more. A text of fewer words
    is one shingle. Null texts and texts without words have no set and stay alone. Equal sets are one class, so copies are never
    paired; repeated rows and ids are in one class. A null id takes the smallest id of its component, if any. An empty table
    gives no rows; other columns are not read. Sets and texts are told apart by 64-bit hashes, whatever the ids; links are
    verified on words. ``n_links`` counts the other sets that a document's set is linked with, all of them.
    """
    whole, pairs = links(docs, width, limit)
    counts = pairs.select(F.col("a").alias("h")).union(pairs.select(F.col("b"))).groupBy("h").agg(F.count("*").alias("n_links"))
    placed = with_roots(whole, pairs).join(counts, "h", "left").withColumn("n_shingles", F.col("n").cast("long"))
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def one_of_each(docs: DataFrame, width: int = 5, limit: tuple[int, int] = (4, 5)) -> DataFrame:
    """Documents without their near duplicates: the one with the smallest id of each component, all columns.

    Ids that are null come last; of texts with that id, the one with the smallest hash stays. Of equal rows one stays. Documents
    without words are no duplicates of anything and stay.
    """
    placed = cut_clean(rooted(docs, width, limit).where("root is not null").select("root", "doc_id", "text_key").distinct())
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    first = placed.groupBy("root").agg(F.min(rank).alias("first"))
    gone = placed.join(first, "root").where(rank != F.col("first")).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
    left = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (text_key() == gone["gone_key"]), "left_anti")
    named = left["doc_id"].isNotNull() | F.coalesce(left["text"].cast("string").rlike(WORD), F.lit(False))
    return left.where(named).dropDuplicates(["doc_id", "text"]).unionByName(left.where(~named))
