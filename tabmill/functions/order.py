"""Rules about position, without ever sorting all rows in one task.

Spark rows have no order, so every rule names a key. Cut-off rules (first n, first 80 %)
need only counts per hash prefix and one sorted prefix; the rows themselves are never
shuffled. Running totals use a range-partitioned sort plus one offset per partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tabmill.functions.joins import lookup
from tabmill.session import cut

PREFIX_DIGITS = 4  # 65,536 prefixes: the count table is bounded whatever the input


def hash_cutoffs(df: DataFrame, hash_text: Column, shares: Sequence[float] | None = None,
                 counts: Sequence[int] | None = None, by: Sequence[str] = (),
                 digits: int = PREFIX_DIGITS) -> DataFrame:
    """Hash value of the last row inside each cut, exactly.

    One row ``(by..., cut, cutoff)`` per cut. ``shares`` are cumulative shares of the rows of
    a class, rounded down; ``counts`` are cumulative row numbers. A cut of no rows gives an
    empty ``cutoff``, which no hash is below. Hashes should come from a unique key: rows with
    one key stay on one side.
    """
    by = list(by)
    hashed = df.select(*by, hash_text.alias("_hash")).withColumn(
        "_prefix", F.substring("_hash", 1, digits))
    per_prefix = hashed.groupBy(*by, "_prefix").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    ranges = per_prefix.select(
        *by, "_prefix", "_n",
        F.sum("_n").over(so_far).alias("_end"),
        F.sum("_n").over(whole).alias("_total"))
    wanted = [F.struct(F.lit(i).alias("cut"), _target(v, shares is not None).alias("_k"))
              for i, v in enumerate(shares if shares is not None else counts)]
    start, first = F.col("_end") - F.col("_n"), F.col("_end") == F.col("_n")
    last = F.col("_end") == F.col("_total")
    holds = (F.col("_k") > start) & (F.col("_k") <= F.col("_end"))
    # a cut before all rows, or past them, needs no look at the rows; "g" is above every hex digit
    known = F.when(F.col("_k") <= 0, F.lit("")).when(F.col("_k") > F.col("_total"), F.lit("g"))
    # one row per class and cut
    picked = cut(ranges.select("*", F.explode(F.array(*wanted)).alias("_w"))
                 .select(*by, "_prefix", "_n", "_end", "_total", "_w.cut", "_w._k")
                 .where(holds | (first & (F.col("_k") <= 0)) | (last & (F.col("_k") > F.col("_total"))))
                 .select(*by, "_prefix", "cut", (F.col("_k") - start).alias("_nth"), known.alias("cutoff")))
    # at most one prefix per class and cut is looked into
    inside = lookup(hashed, picked.where("cutoff is null").drop("cutoff"), [*by, "_prefix"], "inner", written=True)
    spot = F.row_number().over(Window.partitionBy(*by, "cut").orderBy("_hash"))
    found = inside.withColumn("_pos", spot).where("_pos = _nth").select(*by, "cut", F.col("_hash").alias("cutoff"))
    return found.unionByName(picked.where("cutoff is not null").select(*by, "cut", "cutoff"))


def _target(value: float, is_share: bool) -> Column:
    if is_share:
        # tiny slack so that 0.8 * 10 is 8, not 7.999...
        return F.floor(F.col("_total") * F.lit(float(value)) + F.lit(1e-9)).cast("long")
    return F.lit(int(value)).cast("long")


def running_totals(df: DataFrame, order: Sequence[Column | str], totals: dict[str, Column | str],
                   within: Sequence[str] = ()) -> DataFrame:
    """Running sums (current row included) over a global order, exactly and in parallel.

    The rows are range-partitioned, sorted and written once; each partition then needs only
    the totals of those before it. ``within`` restarts the sums and must be columns with few
    distinct values (features, classes) that lead the order. Rows should be distinct in
    ``order``; group equal ones first.
    """
    within = list(within)
    sized = df.select("*", *[_expr(e).alias(f"_one_{n}") for n, e in totals.items()])
    # partition and place in it, written with the rows
    slot = F.monotonically_increasing_id()
    flat = cut(sized.orderBy(*within, *order).withColumn("_slot", slot)
               .withColumn("_part", F.shiftright("_slot", 33)))
    part_sums = flat.groupBy(*within, "_part").agg(
        *[F.sum(f"_one_{n}").alias(f"_sum_{n}") for n in totals])
    earlier = (Window.partitionBy(*within).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = part_sums.select(
        *within, "_part",
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}")
          for n in totals])
    inner = (Window.partitionBy(*within, "_part").orderBy("_slot")
             .rowsBetween(Window.unboundedPreceding, 0))
    kept = [c for c in df.columns]
    # one offset row per sorted partition (and restart): bounded by the partition count
    return flat.join(F.broadcast(offsets), [*within, "_part"]).select(
        *kept,
        *[(F.sum(f"_one_{n}").over(inner) + F.col(f"_before_{n}")).alias(n) for n in totals])


BINS = 1024


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]],
                     ends: Row | None = None) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ranks of numeric columns, nulls left out: ``{(col, rank): value}``.

    Columns hold no NaN. No value is shuffled or sorted. A pass counts the rows of the interval
    around a rank in ``BINS`` bins, map-side, and the next one goes on with the values of the one
    bin that holds the rank, until they are all equal. A few passes over the pruned columns are
    usual. ``ends`` is the row of ``sizes`` if it is known already.
    """
    ends = ends or sizes(df, list(ranks))
    # (column, rank) -> smallest and largest value of its interval, rows below the interval
    spans = {(c, k): (ends[c]["lo"], ends[c]["hi"], 0) for c in ranks for k in ranks[c]}
    while True:
        unsettled = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in spans.items() if lo != hi})
        if not unsettled:
            return {target: lo for target, (lo, _, _) in spans.items()}
        bins = _count_bins(df, unsettled)
        for target, (lo, hi, below) in spans.items():
            for n, first, last in bins.get((target[0], lo, hi), ()):
                if target[1] < below + n:
                    spans[target] = (first, last, below)
                    break
                below += n


def sizes(df: DataFrame, cols: Sequence[str]) -> Row:
    """Smallest value, largest value and number of values of each column, in one pass."""
    return df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias(c)
                    for c in cols]).first()


def _count_bins(df: DataFrame, spans: Sequence[tuple]) -> dict[tuple, list[tuple]]:
    """Per span ``(column, lo, hi)`` its filled bins in order: (rows, smallest, largest value)."""
    kinds = dict(df.dtypes)
    out: dict[tuple, list[tuple]] = {}
    for kind in sorted({kinds[c] for c, _, _ in spans}):
        own = [s for s in spans if kinds[s[0]] == kind]
        if kind == "double":
            counted = _bins_of_doubles(df, own)
            for r in sorted(counted.collect(), key=lambda r: (r["span"], r["bin"])):  # at most BINS rows per span
                out.setdefault(own[r["span"]], []).append((r["n"], r["first"], r["last"]))
            continue
        marks = []
        for i, (c, lo, hi) in enumerate(own):
            x = F.col(c)
            step = _bin(x, lo, hi)
            marks.append(F.when((x >= F.lit(lo)) & (x <= F.lit(hi)),
                                F.struct(F.lit(i).alias("span"), step.alias("bin"), x.alias("x"))))
        counted = (df.select(F.explode(F.array_compact(F.array(*marks))).alias("m"))
                   .groupBy("m.span", "m.bin")
                   .agg(F.count("*").alias("n"), F.min("m.x").alias("first"), F.max("m.x").alias("last")))
        # at most BINS rows per span
        for r in sorted(counted.collect(), key=lambda r: (r["span"], r["bin"])):
            out.setdefault(own[r["span"]], []).append((r["n"], r["first"], r["last"]))
    return out


def _bins_of_doubles(df: DataFrame, spans: Sequence[tuple]) -> DataFrame:
    """``(span, bin, n, first, last)`` for sorted spans of double columns, those of one column apart from each other.

    A task finds a value's span by binary search and keeps one count per bin, so a row costs a few steps per column, however many spans there are.
    """
    columns = sorted({c for c, _, _ in spans})
    places = {c: [i for i, s in enumerate(spans) if s[0] == c] for c in columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(spans) * BINS, dtype=np.int64)
        first, last = np.full(len(n), np.inf), np.full(len(n), -np.inf)
        for batch in batches:
            for j, c in enumerate(columns):
                own = slice(places[c][0] * BINS, (places[c][-1] + 1) * BINS)
                lo, hi = (np.array([spans[i][k] for i in places[c]]) for k in (1, 2))
                x = batch.column(j).drop_null().to_numpy(zero_copy_only=False)
                at = np.searchsorted(lo, x, side="right") - 1
                inside = (at >= 0) & (x <= hi[at])
                x, at = x[inside], at[inside]
                with np.errstate(all="ignore"):  # spans without a width or an end go by their ends
                    width = hi / 2 - lo / 2      # halves, as hi - lo may be too large
                    share = np.floor((x / 2 - lo[at] / 2) / width[at] * BINS)
                odd = ~np.isfinite(width) | (width == 0)
                share = np.where(odd[at], np.where(x == lo[at], 0, np.where(x == hi[at], 2, 1)), np.minimum(share, BINS - 1))
                cell = at * BINS + share.astype(np.int64)
                n[own] += np.bincount(cell, minlength=len(lo) * BINS)
                np.minimum.at(first[own], cell, x)
                np.maximum.at(last[own], cell, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array((some // BINS).astype(np.int32)), pa.array((some % BINS).astype(np.int32)), pa.array(n[some]),
                                          pa.array(first[some]), pa.array(last[some])], names=["span", "bin", "n", "first", "last"])

    counted = df.select(*columns).mapInArrow(run, "span int, bin int, n long, first double, last double")
    return counted.groupBy("span", "bin").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def _bin(x: Column, lo, hi) -> Column:
    """Bin of a value in [lo, hi]: never falls with x, and never the same for lo and hi."""
    if isinstance(lo, float):
        if math.isinf(lo) or math.isinf(hi):
            return F.when(x == F.lit(lo), 0).when(x == F.lit(hi), 2).otherwise(1)
        if hi / 2 == lo / 2:
            return F.when(x == F.lit(lo), 0).otherwise(1)
        share = (x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)  # halves, as hi - lo may be too large
    elif hi - lo < 1 << 53:
        share = (x - F.lit(lo)).cast("double") / F.lit(float(hi - lo))
    else:
        share = (x.cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo))
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


ACCURACY = 10_000  # of the sketch: it misses a rank by rows / ACCURACY at most


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of numeric columns, exactly; None for an empty column."""
    return quantiles_with(df, cols, probs)[0]


def quantiles_with(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   also: Mapping[str, Column] | None = None) -> tuple[dict[str, list[float | None]], Row]:
    """Exact quantiles and a row of other aggregates (named in ``also``), from two scans of ``df``.

    Columns hold no NaN; nulls are left out. The first scan brackets each quantile by a mergeable sketch. The second counts
    the rows below and above each bracket and its own by value, about 4 / ``ACCURACY`` of the rows for each quantile,
    which are all that is shuffled. They are written, and the ranks are found in them.
    """
    cols, also = list(cols), dict(also or {})
    if not cols:
        return {}, df.agg(*[a.alias(n) for n, a in also.items()] or [F.lit(None)]).first()
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols])  # keeps the order of the values
    wide = [F.lit(min(1.0, max(0.0, p + d))) for p in probs for d in (-2 / ACCURACY, 2 / ACCURACY)]
    first = df.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                   *[F.percentile_approx(c, F.array(*wide), ACCURACY).alias(f"q_{i}") for i, c in enumerate(cols)],
                   *[a.alias(n) for n, a in also.items()]).first()
    wanted, spans = {}, {}  # (column, probability) -> place of its value; its bracket
    for i, c in enumerate(cols):
        if first[f"n_{i}"]:
            for j, p in enumerate(probs):
                wanted[c, j] = (first[f"n_{i}"] - 1) * p
                spans[c, j] = (first[f"q_{i}"][2 * j], first[f"q_{i}"][2 * j + 1])
    values = _within(df, wanted, spans) if wanted else {}
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    for (c, j), at in wanted.items():
        low, high = values[c, j]
        out[c][j] = low if low == high else low + (high - low) * (at - math.floor(at))
    return out, first


def _within(df: DataFrame, wanted: Mapping[tuple, float], spans: Mapping[tuple, tuple]) -> dict[tuple, tuple[float, float]]:
    """Values at the ranks on both sides of each wanted place, by one scan for the rows of the brackets."""
    keys = list(spans)
    marks = []
    for i, key in enumerate(keys):
        x, (lo, hi) = F.col(key[0]), spans[key]
        side = F.when(x < F.lit(lo), -1).when(x > F.lit(hi), 1).otherwise(0)
        marks.append(F.when(x.isNotNull(), F.struct(
            F.lit(i).alias("span"), side.alias("side"), F.when(side == 0, x).alias("value"), x.alias("x"))))
    counted = cut(df.select(F.explode(F.array_compact(F.array(*marks))).alias("m")).groupBy("m.span", "m.side", "m.value")
                  .agg(F.count("*").alias("n"), F.min("m.x").alias("first"), F.max("m.x").alias("last")))
    # three rows a span
    sides = {(r["span"], r["side"]): r for r in counted.groupBy("span", "side").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")).collect()}
    ranks: dict[tuple[int, int], float | tuple] = {}
    for i, key in enumerate(keys):
        below, inside = (sides[i, s]["n"] if (i, s) in sides else 0 for s in (-1, 0))
        for k in {math.floor(wanted[key]), math.ceil(wanted[key])}:
            if below <= k < below + inside:
                ranks[i, k] = (*spans[key], below)
            elif k == below - 1:
                ranks[i, k] = sides[i, -1]["last"]
            elif k == below + inside:
                ranks[i, k] = sides[i, 1]["first"]
            else:  # the sketch keeps its bound, so this is never met; still it would be right
                ranks[i, k] = order_statistics(df, {key[0]: [k]})[key[0], k]
    _narrow(counted.where("side = 0"), ranks)
    return {key: (ranks[i, math.floor(wanted[key])], ranks[i, math.ceil(wanted[key])]) for i, key in enumerate(keys)}


def _narrow(counted: DataFrame, ranks: dict[tuple[int, int], float | tuple]) -> None:
    """Replace the intervals ``(lo, hi, rows below)`` of ranks by their values, from ``(span, value, n)``."""
    while True:
        for target, at in ranks.items():
            if isinstance(at, tuple) and at[0] == at[1]:
                ranks[target] = at[0]
        open_ = sorted({(i, *at[:2]) for (i, _), at in ranks.items() if isinstance(at, tuple)})
        if not open_:
            return
        x = F.col("value")
        marks = [F.when((F.col("span") == i) & x.between(F.lit(lo), F.lit(hi)),
                        F.struct(F.lit(m).alias("mark"), _bin(x, lo, hi).alias("bin"))) for m, (i, lo, hi) in enumerate(open_)]
        bins: dict[int, list] = {}
        # at most BINS rows per interval
        for r in sorted(counted.select(F.explode(F.array_compact(F.array(*marks))).alias("m"), "value", "n")
                        .groupBy("m.mark", "m.bin").agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
                        .collect(), key=lambda r: (r["mark"], r["bin"])):
            bins.setdefault(r["mark"], []).append(r)
        for target, at in ranks.items():
            if isinstance(at, tuple):
                lo, hi, below = at
                for r in bins[open_.index((target[0], lo, hi))]:
                    if target[1] < below + r["n"]:
                        ranks[target] = (r["lo"], r["hi"], below)
                        break
                    below += r["n"]


def _expr(e: Column | str) -> Column:
    return F.col(e) if isinstance(e, str) else e
