"""Streaming forms of the serving-log statistics and of feature ingest.

Time columns are cast to ``timestamp`` (a watermark takes no other type). Rows later than the
watermark are dropped here; the batch forms of the same operators are the truth for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabmill.functions import hashing
from tabmill.operators import feature_store as store, monitor


def event_stream(spark: SparkSession, folder: str, schema: T.StructType, time: str,
                 pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, the time column ready for a watermark."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn(time, F.col(time).cast("timestamp"))


def hourly_counts(events: DataFrame, time: str, event_id: str, keys: Sequence[str] = (),
                  delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts per tumbling window; an event sent twice within the delay counts once."""
    once = events.withWatermark(time, delay).dropDuplicatesWithinWatermark([event_id])
    return monitor.hourly(once, time, keys, width)


def serving_histogram(events: DataFrame, time: str, event_id: str,
                      edges: Mapping[str, Sequence[float]], categories: Sequence[str] = (),
                      rate: float = 0.8, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Feature bins per window over a repeatable sample of the requests."""
    kept = events.where(hashing.in_fraction(rate, event_id)).withWatermark(time, delay)
    counts = monitor.histogram(kept, edges, categories, by=[F.window(time, width)])
    return counts.select(F.col("k0.start").alias("window_start"), "feature", "kind", "bin", "n")


def append_to(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append closed windows to a Parquet folder, stop."""
    query = (df.writeStream.outputMode("append").format("parquet")
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


KEPT_BATCHES = 20  # batches of changes that a reader of the newest values may meet


def ingest_latest(history: DataFrame, path: str, checkpoint: str,
                  features: Sequence[str] | None = None, kept: int = KEPT_BATCHES) -> None:
    """Keep the newest row per entity as history streams in.

    The newest row lives in the state store, spread by entity; a batch writes only the entities
    it changed, to a folder of its own. A repeated batch writes the same folder again.

    Batches come in generations of ``kept``. The first batch of a generation writes the newest rows of all before as its
    base, then says so in ``current``, then writes its changes; until then readers use the generation before, whose
    base and changes are never touched. ``current`` has two slots, written in turn, so one of them is always whole.
    Generations before the one in ``current`` are read no more and may be removed. ``kept`` must stay the same for a folder.
    """
    features = store._features(history, features)

    def newest(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(store.ENTITY)
                .agg(F.max_by(F.struct(store.TIME, store.INGEST, *features),
                              F.struct(store.TIME, store.INGEST)).alias("r"))
                .select(store.ENTITY, "r.*"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, generation = batch.sparkSession, batch_id // kept
        last = _current(spark, path)
        if last < generation:
            newest(_changes(spark, path, last, batch.schema)).write.mode("overwrite").parquet(f"{path}/base/generation={generation}")
            _turn_to(spark, path, generation)
        batch.write.mode("overwrite").parquet(f"{path}/changes/generation={generation}/batch={batch_id}")

    _run(newest(history), write, checkpoint)


def _turn_to(spark: SparkSession, path: str, generation: int) -> None:
    spark.createDataFrame([(generation,)], "generation int").write.mode("overwrite").parquet(
        f"{path}/current/slot={generation % 2}")


def _current(spark: SparkSession, path: str) -> int:
    """The newest generation whose base is whole; 0, which has no base, before any."""
    pointers = _if_there(spark, f"{path}/current", T.StructType.fromDDL("generation int"))
    return 0 if pointers is None else pointers.agg(F.max("generation")).first()[0] or 0


def _changes(spark: SparkSession, path: str, generation: int, schema: T.StructType) -> DataFrame:
    """Base and changes of one generation; older ones are not listed."""
    parts = [_if_there(spark, f"{path}/changes/generation={generation}", schema)]
    if generation:
        parts.append(spark.read.schema(schema).parquet(f"{path}/base/generation={generation}"))
    out = spark.createDataFrame([], schema)
    for part in parts:
        if part is not None:
            out = out.unionByName(part.select(*schema.names))
    return out


def _if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _run(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (df.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Newest row per entity over the changes written so far: one base and the batches after it."""
    generation = _current(spark, path)
    newest = f"{path}/base/generation={generation}" if generation else f"{path}/changes/generation=0"
    schema = T.StructType([f for f in spark.read.parquet(newest).schema.fields if f.name != "batch"])
    return store.latest(_changes(spark, path, generation, schema))
