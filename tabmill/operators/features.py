"""Feature building. Everything fitted is one small row or one lookup table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabmill.functions import text as words_of
from tabmill.functions.joins import lookup
from tabmill.functions.order import order_statistics, running_totals, sizes
from tabmill.operators.clean import NUMERIC, TEXT, columns_of
from tabmill.session import cut


# -- categories -------------------------------------------------------------------------

def _pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form ``(column, value)`` of some columns, nulls left out."""
    each = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    return (df.select(F.explode(F.array(*each)).alias("p")).select("p.column", "p.value")
            .where("value is not null"))


def label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Codes 0, 1, ... in sorted order of the values: ``(column, value, code)``.

    Works for columns with more values than a task could hold: the distinct values are
    range-partitioned, not gathered.
    """
    distinct = _pairs(df, cols).distinct()
    placed = running_totals(distinct, ["value"], {"_end": F.lit(1)}, within=["column"])
    return placed.select("column", "value", (F.col("_end") - 1).cast("long").alias("code"))


def label_encode(df: DataFrame, cols: Sequence[str], codes: DataFrame | None = None,
                 suffix: str = "_code") -> DataFrame:
    """Add a code column per category; unseen and null values give null."""
    codes = label_codes(df, cols) if codes is None else codes
    for c in cols:
        table = codes.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias(c + suffix))
        df = lookup(df, table, [c])
    return df


def vocabulary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Slots by falling frequency, ``(column, value, slot, size)``: 0 masks, 1 is unseen."""
    counted = _pairs(df, cols).groupBy("column", "value").agg((-F.count("*")).alias("_rank"))
    placed = running_totals(counted, ["_rank", "value"], {"_end": F.lit(1)}, within=["column"])
    sizes = placed.groupBy("column").agg((F.max("_end") + 2).cast("long").alias("size"))
    return (placed.join(F.broadcast(sizes), "column")  # one row per encoded column
            .select("column", "value", (F.col("_end") + 1).cast("long").alias("slot"), "size"))


def vocabulary_encode(df: DataFrame, col: str, vocab: DataFrame, out: str) -> DataFrame:
    """Slot of a value: 0 for null or empty, 1 for a value not in the vocabulary."""
    table = vocab.where(F.col("column") == col).select(
        F.col("value").alias(col), F.col("slot").alias("_slot"))
    masked = F.col(col).isNull() | (F.col(col) == "")
    slot = F.when(masked, F.lit(0)).otherwise(F.coalesce("_slot", F.lit(1))).cast("long")
    return lookup(df, table, [col]).withColumn(out, slot).drop("_slot")


def slot_vector(slot: Column | str, size: int) -> Column:
    """Binary encoding of an array of integer slots: ``size`` entries of 0 and 1, where ``size`` is that of the vocabulary."""
    slot = F.col(slot) if isinstance(slot, str) else slot
    places = F.sequence(F.lit(0), F.lit(size - 1))
    return F.transform(places, lambda i: F.array_contains(slot, i).cast("int"))


def category_values(df: DataFrame, col: str) -> list:
    """Sorted distinct values that will become columns, a column each: for wide columns use ``label_encode``."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, cols: Sequence[str] | None = None,
            values: Mapping[str, Sequence] | None = None, prefix: bool = False) -> DataFrame:
    """A 0/1 column per value, named like the value; the source columns go. No shuffle."""
    cols = columns_of(df, TEXT) if cols is None else list(cols)
    out = []
    for c in cols:
        known = values[c] if values and c in values else category_values(df, c)
        for v in known:
            name = f"{c}_{v}" if prefix else str(v)
            out.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(name))
    return df.select(*[c for c in df.columns if c not in cols], *out)


# -- scaling ----------------------------------------------------------------------------

def scale_stats(df: DataFrame, cols: Sequence[str], deviation: str = "population") -> DataFrame:
    """Mean and deviation of all columns in one pass: one row, one struct."""
    spread = {"population": F.stddev_pop, "sample": F.stddev_samp}[deviation]
    parts = [F.struct(F.avg(c).alias("mean"), spread(c).alias("std")).alias(c) for c in cols]
    return df.agg(F.struct(*parts).alias("stats"))


def standardize(df: DataFrame, cols: Sequence[str], fitted_on: DataFrame | None = None,
                deviation: str = "population", suffix: str = "") -> DataFrame:
    """(x - mean) / deviation with the statistics of ``fitted_on``; no deviation gives 0.

    ``population`` and ``sample`` are the two flavours in use. The fit is one pass for all columns
    and gives two numbers per column, which go into the plan as constants: no join.
    """
    stats = scale_stats(df if fitted_on is None else fitted_on, cols, deviation).first()["stats"]
    return df.withColumns({
        c + suffix: scaled_by(F.col(c), stats[c]["mean"], stats[c]["std"]) for c in cols})


def scaled_by(x: Column, mean: float | None, std: float | None) -> Column:
    if not std or math.isnan(std):
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(float(mean))) / F.lit(float(std))


class _ScalerParams(HasInputCols, HasOutputCols):
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "fitted population deviations",
                 TypeConverters.toListFloat)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the population deviation (the built-in scaler uses the sample one)."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        row = scale_stats(dataset, cols).first()["stats"]
        model = PopulationScalerModel()
        return model._set(inputCols=cols, outputCols=self.getOutputCols(),
                          means=[float(row[c]["mean"] or 0.0) for c in cols],
                          stds=[float(row[c]["std"] or 0.0) for c in cols])


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        mean, std = self.getOrDefault(self.means), self.getOrDefault(self.stds)
        return dataset.withColumns({
            out: scaled_by(F.col(c), m, s)
            for c, out, m, s in zip(self.getInputCols(), self.getOutputCols(), mean, std)})


# -- text -------------------------------------------------------------------------------

TASK_TEXT = 16 << 20  # bytes of text that a task counts: its words and their counts take about 20 times as much


def text_tasks(df: DataFrame, text: str, task_bytes: int = TASK_TEXT) -> int:
    """Tasks to count the words of some texts with: by their bytes, and more of them to keep all cores busy."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(size / task_bytes), min(cores, math.ceil(size / (1 << 20))))


def term_counts(df: DataFrame, key: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, keep..., term, n)`` over whole texts; ``keep`` are columns of the same row.

    The texts are placed by key before they are taken apart: a text is smaller than its words,
    and neither the counting nor a later step per document has to move them again. They are placed
    in as many parts as their bytes need, measured first: merged by their size as moved, which is
    that of packed texts, the parts would grow with the table and their words spill.
    """
    return (df.select(key, *keep, text).repartition(text_tasks(df, text), key)
            .select(key, *keep, F.explode(words_of.words(text)).alias("term"))
            .groupBy(key, *keep, "term").agg(F.count("*").alias("n")))


def inverse_frequency(df: DataFrame, text: str) -> DataFrame:
    """``(term, df, idf)`` with idf = ln((1 + n) / (1 + df)) + 1, one document per row.

    A document gives each of its words once, so counting needs no (document, word) shuffle.
    """
    documents = df.count()
    once = df.select(F.explode(F.array_distinct(words_of.words(text))).alias("term"))
    per_term = once.groupBy("term").agg(F.count("*").alias("df"))
    return per_term.withColumn("idf", F.ln((1 + documents) / (1 + F.col("df"))) + 1)


def tfidf(counts: DataFrame, idf: DataFrame, key: str, written: bool = False) -> DataFrame:
    """L2-normalised tf * idf per document: ``(counts without n, weight)``.

    A term in most documents is a hot join key; ``lookup`` broadcasts the table or salts it.
    """
    raw = lookup(counts, idf.select("term", "idf"), ["term"], how="inner", written=written)
    raw = raw.withColumn("_w", F.col("n") * F.col("idf"))
    # one document is a bounded group: its distinct words
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    rest = [c for c in counts.columns if c != "n"]
    return raw.select(*rest, (F.col("_w") / norm).alias("weight"))


# -- classes ----------------------------------------------------------------------------

def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight = 1 / n of the class."""
    return (df.groupBy(label).agg(F.count("*").alias("n"))
            .withColumn("weight", 1.0 / F.col("n")))


def with_weights(df: DataFrame, label: str, weights: Mapping, out: str = "weight") -> DataFrame:
    """Row weights from given class weights, such as {0: 1.0, 1: 100.0}."""
    chain = None
    for value, weight in weights.items():
        hit = F.col(label) == F.lit(value)
        chain = F.when(hit, float(weight)) if chain is None else chain.when(hit, float(weight))
    return df.withColumn(out, chain)


# -- time -------------------------------------------------------------------------------

def lags(df: DataFrame, entity: str, time: str, cols: Sequence[str], n: int = 14) -> DataFrame:
    """``c_lag1 .. c_lagn`` per entity, all from one sort.

    ``df`` is one row per entity and day, so a group is bounded by the days of the history.
    """
    w = Window.partitionBy(entity).orderBy(time)
    return df.select("*", *[F.lag(c, k).over(w).alias(f"{c}_lag{k}")
                            for c in cols for k in range(1, n + 1)])


def calendar(df: DataFrame, day: str) -> DataFrame:
    """Epoch day, day, day of week (Sunday = 1), day of year, month and quarter."""
    d = F.col(day).cast("date")
    return df.withColumns({
        "date_epoch": F.unix_date(d), "day": F.dayofmonth(d), "day_of_week": F.dayofweek(d),
        "day_of_year": F.dayofyear(d), "month": F.month(d), "quarter": F.quarter(d)})


# -- selection --------------------------------------------------------------------------

def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner bin edges of all features in one pass."""
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(c, probs, 10000).alias(c) for c in features]).first()
    return {c: sorted(set(map(float, row[c] or []))) for c in features}


def exact_edges(df: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner bin edges at exact ranks: the values that ``i / bins`` of a column's values come before, nulls left out."""
    ends = sizes(df, list(features))
    ranks = {c: sorted({ends[c]["n"] * i // bins for i in range(1, bins)}) if ends[c]["n"] else [] for c in features}
    found = order_statistics(df, ranks, ends)
    return {c: sorted({float(found[c, k]) for k in ranks[c]}) for c in features}


def expected_information(a: Column, b: Column, n: Column, width: float = 12.0) -> Column:
    """What a cell of a table with margins ``a`` and ``b`` of ``n`` rows adds to the mutual information if rows are dealt at random.

    The cell's count k is hypergeometric: sum of P(k) k/n ln(n k / (a b)). The probabilities come from their ratios, going up and down
    from the likeliest count, and are divided by their sum; counts ``width`` deviations and 40 off it weigh nothing in a double.
    """
    a, b, n = (x.cast("double") for x in (a, b, n))
    least, most = F.greatest(F.lit(0.0), a + b - n), F.least(a, b)
    mode = F.least(F.greatest(F.floor((a + 1) * (b + 1) / (n + 2)).cast("double"), least), most)
    reach = F.ceil(F.sqrt(a * b / n * (n - a) / n * (n - b) / F.greatest(n - 1, F.lit(1.0))) * width) + 40
    value = lambda k: F.when(k > 0, k / n * F.ln(n * k / (a * b))).otherwise(0.0)
    start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("total"))

    def side(first: Column, last: Column, step: int, ratio) -> Column:
        def add(state: Column, k: Column) -> Column:
            p = state["p"] * ratio(k.cast("double"))
            return F.struct(p.alias("p"), (state["weight"] + p).alias("weight"), (state["total"] + p * value(k.cast("double"))).alias("total"))

        counts = F.when(first <= last if step > 0 else first >= last, F.sequence(first.cast("long"), last.cast("long"), F.lit(step).cast("long")))
        return F.coalesce(F.reduce(counts, start, add), start)

    up = side(mode + 1, F.least(most, mode + reach), 1, lambda k: (a - k + 1) * (b - k + 1) / (k * (n - a - b + k)))
    down = side(mode - 1, F.greatest(least, mode - reach), -1, lambda k: (k + 1) * (n - a - b + k + 1) / ((a - k) * (b - k)))
    return (value(mode) + up["total"] + down["total"]) / (1 + up["weight"] + down["weight"])


def bin_of(col: Column | str, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value; null has its own bin, -1."""
    c = F.col(col) if isinstance(col, str) else col
    count = F.lit(0)
    for e in edges:
        count = count + (c >= F.lit(float(e))).cast("int")
    return F.when(c.isNull(), F.lit(-1)).otherwise(count)


def mutual_information(df: DataFrame, label: str, edges: Mapping[str, Sequence[float]],
                       top: int | None = 10) -> DataFrame:
    """Mutual information of binned features with a label, and its adjusted form.

    One pass: rows are stacked to ``(feature, bin, label)`` and counted, after which the
    frame has at most features x bins x classes rows. The adjustment takes the exact expected
    value under the hypergeometric model (Vinh, Epps, Bailey 2010) and the mean of both entropies.
    """
    each = [F.struct(F.lit(c).alias("feature"), bin_of(c, e).alias("bin")) for c, e in edges.items()]
    cells = (df.select(F.col(label).alias("_y"), F.explode(F.array(*each)).alias("f"))
             .groupBy("f.feature", "f.bin", "_y").agg(F.count("*").alias("n")))
    cells = cut(cells)  # counted once, small from here on
    over = lambda *by: F.sum("n").over(Window.partitionBy("feature", *by))
    sized = cells.select("*", over("bin").alias("nx"), over("_y").alias("ny"), over().alias("total"))
    p = F.col("n") / F.col("total")
    terms = sized.select(
        "feature", "bin", "_y", "total",
        (p * F.ln(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))).alias("mi"),
        # each bin's (class's) entropy term is shared out over its cells
        (-p * F.ln(F.col("nx") / F.col("total"))).alias("hx"),
        (-p * F.ln(F.col("ny") / F.col("total"))).alias("hy"))
    rows = cells.groupBy("feature", "bin").agg(F.sum("n").alias("a"))
    columns = cells.groupBy("feature", "_y").agg(F.sum("n").alias("b"))
    whole = rows.groupBy("feature").agg(F.sum("a").alias("n"))
    margins = rows.join(columns, "feature").join(whole, "feature")  # features x bins x classes rows
    expected = margins.groupBy("feature").agg(F.sum(expected_information(F.col("a"), F.col("b"), F.col("n"))).alias("chance"))
    found = terms.groupBy("feature").agg(
        F.sum("mi").alias("mi"), F.sum("hx").alias("hx"), F.sum("hy").alias("hy")).join(expected, "feature")
    chance = F.col("chance")
    room = (F.col("hx") + F.col("hy")) / 2 - chance
    out = found.select("feature", "mi", F.when(room > 1e-15, (F.col("mi") - chance) / F.when(room > 1e-15, room))
                       .otherwise(F.lit(0.0)).alias("ami"))
    return out if top is None else out.orderBy(F.desc("ami"), "feature").limit(top)


# -- declared columns -------------------------------------------------------------------

def feature_pipeline(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
                     auto: Sequence[str] = (), label: str | None = None,
                     out: str = "features") -> Pipeline:
    """Pipeline from a column spec; ``auto`` columns are sorted by their type.

    The label never becomes a feature.
    """
    numeric, categorical = list(numeric), list(categorical)
    numeric += [c for c in columns_of(df, NUMERIC) if c in auto]
    categorical += [c for c in columns_of(df, TEXT) if c in auto]
    if label in (*numeric, *categorical):
        raise ValueError(f"the label {label} is listed as a feature")
    missing = set(auto) - set(numeric) - set(categorical)
    if missing:
        raise ValueError(f"no transformation for the type of {sorted(missing)}")
    stages, inputs = [], []
    if categorical:
        index = [f"{c}__index" for c in categorical]
        hot = [f"{c}__hot" for c in categorical]
        stages += [StringIndexer(inputCols=categorical, outputCols=index,
                                 stringOrderType="alphabetAsc", handleInvalid="keep"),
                   OneHotEncoder(inputCols=index, outputCols=hot, dropLast=False,
                                 handleInvalid="keep")]
        inputs += hot
    if numeric:
        scaled = [f"{c}__scaled" for c in numeric]
        stages.append(PopulationScaler(inputCols=numeric, outputCols=scaled))
        inputs = scaled + inputs
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    return Pipeline(stages=stages)
