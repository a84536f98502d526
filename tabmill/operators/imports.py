"""Statistics of imports: written once per import, merged with those before, compared with them.

A store is a folder. Each import adds three small tables of its own version, ``bins`` (its own rows), ``state`` (all
rows so far) and ``distances``, and last a row in ``commits``, which makes them count: a version without a commit is
written again by the next import. Rows of an import are read once, those of earlier imports never again. One import
at a time may write to a store.

A bin is ``(feature, kind, bin, n, lo, hi, mean, m2)``: its rows and, for numbers, their smallest and largest value,
mean and sum of squared deviations from it. All of these merge, so a state is as exact as a pass over all rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabmill.operators.features import bin_of
from tabmill.operators.monitor import compare

KEY = ["feature", "kind", "bin"]
BIN = "feature string, kind string, bin string, n long, lo double, hi double, mean double, m2 double"
DISTANCE = "feature string, kind string, distance double"
MISSING = "-1"  # the bin of null numbers


def statistics(df: DataFrame, edges: Mapping[str, Sequence[float]], categories: Sequence[str] = ()) -> DataFrame:
    """Bins of a batch, counted map-side in one pass. NaN counts as null; a null category is the empty text."""
    numbers = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in edges}
    each = [F.struct(F.lit(c).alias("feature"), F.lit("number").alias("kind"),
                     bin_of(numbers[c], e).cast("string").alias("bin"), numbers[c].alias("x")) for c, e in edges.items()]
    each += [F.struct(F.lit(c).alias("feature"), F.lit("category").alias("kind"),
                      F.coalesce(F.col(c).cast("string"), F.lit("")).alias("bin"), F.lit(None).cast("double").alias("x"))
             for c in categories]
    return (df.select(F.explode(F.array(*each)).alias("f")).groupBy("f.feature", "f.kind", "f.bin")
            .agg(F.count("*").alias("n"), F.min("f.x").alias("lo"), F.max("f.x").alias("hi"), F.avg("f.x").alias("mean"),
                 (F.var_pop("f.x") * F.count("f.x")).alias("m2")))


def merged(one: DataFrame, two: DataFrame) -> DataFrame:
    """Bins of the rows of both sides together."""
    a = one.select(*KEY, *[F.col(c).alias(f"{c}_a") for c in ("n", "lo", "hi", "mean", "m2")])
    b = two.select(*KEY, *[F.col(c).alias(f"{c}_b") for c in ("n", "lo", "hi", "mean", "m2")])
    na, nb = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    n, apart = na + nb, F.col("mean_b") - F.col("mean_a")
    either = lambda both, c: F.coalesce(both, F.col(f"{c}_a"), F.col(f"{c}_b"))
    return a.join(b, KEY, "full").select(
        *KEY, n.alias("n"), F.least("lo_a", "lo_b").alias("lo"), F.greatest("hi_a", "hi_b").alias("hi"),
        either(F.col("mean_a") + apart * nb / n, "mean").alias("mean"),
        either(F.col("m2_a") + F.col("m2_b") + apart * apart * na * nb / n, "m2").alias("m2"))


def moments(bins: DataFrame) -> DataFrame:
    """``(feature, n, missing, lo, hi, mean, std)`` of the numbers in bins; the sample deviation, null below two rows."""
    numbers = bins.where("kind = 'number'")
    given = F.when(F.col("bin") != MISSING, F.col("n"))
    whole = numbers.groupBy("feature").agg(
        F.coalesce(F.sum(given), F.lit(0)).alias("n"), F.sum(F.when(F.col("bin") == MISSING, F.col("n")).otherwise(0)).alias("missing"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum(given)).alias("all"))
    # around the mean of all: sums of squares would cancel where the mean is far from zero
    around = numbers.join(F.broadcast(whole.select("feature", "all")), "feature").groupBy("feature").agg(  # a row per feature
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("all")) ** 2).alias("m2"))
    return whole.join(around, "feature").select(
        "feature", "n", "missing", "lo", "hi", F.col("all").alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"))


def _found(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the store, empty if it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, store: str) -> DataFrame:
    """The imports that count: ``(name, version)``."""
    return _found(spark, f"{store}/commits", "name string, version int")


def _version(store: str, table: str, version: int) -> str:
    return f"{store}/{table}/version={version}"


def record(batch: DataFrame, store: str, name: str, edges: Mapping[str, Sequence[float]],
           categories: Sequence[str] = (), against: str = "latest") -> DataFrame:
    """Add an import to the store and return its ``(feature, kind, distance)`` to what was stored before.

    ``against`` is "latest", the import before this one, or "state", all imports before it. The first import has no
    distances. An import of a name that is in the store already adds nothing and gives the distances stored then. An
    empty batch is an import without bins: it is at distance 1 from others, like a feature that is gone.
    """
    if against not in ("latest", "state"):
        raise ValueError(f"unknown baseline {against}")
    spark = batch.sparkSession
    log = commits(spark, store)
    known = log.agg(F.max("version").alias("last"),
                    F.max(F.when(F.col("name") == name, F.col("version"))).alias("same")).first()
    if known.same is not None:
        return spark.read.schema(DISTANCE).parquet(_version(store, "distances", known.same))
    version = 0 if known.last is None else known.last + 1
    path = lambda table, v=version: _version(store, table, v)
    read = lambda table, v: spark.read.schema(BIN).parquet(path(table, v))
    statistics(batch, edges, categories).write.mode("overwrite").parquet(path("bins"))
    own = read("bins", version)
    if known.last is None:
        state, distances = own, spark.createDataFrame([], DISTANCE)
    else:
        state = merged(read("state", known.last), own)
        distances = compare(read("bins" if against == "latest" else "state", known.last), own)
    state.write.mode("overwrite").parquet(path("state"))
    distances.select("feature", "kind", "distance").write.mode("overwrite").parquet(path("distances"))
    spark.createDataFrame([(name,)], "name string").write.mode("overwrite").parquet(path("commits"))
    return spark.read.schema(DISTANCE).parquet(path("distances"))


def state(spark: SparkSession, store: str) -> DataFrame:
    """Bins of all rows imported so far."""
    last = commits(spark, store).agg(F.max("version")).first()[0]
    return spark.createDataFrame([], BIN) if last is None else spark.read.schema(BIN).parquet(_version(store, "state", last))
