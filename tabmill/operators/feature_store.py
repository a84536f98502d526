"""Time-stamped feature store: conform, ingest, latest values, point-in-time join, snapshots.

A history is a long table ``(entity_id, feature_time, ingest_id, features...)``. The newest row
wins as a whole: its nulls stay null. Equal times are settled by the highest ingest id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabmill.functions.joins import lookup
from tabmill.session import cut

ENTITY, TIME, INGEST = "entity_id", "feature_time", "ingest_id"
ROWS_PER_SLICE = 2_000_000


def conform(source: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows cast to a declared schema, and the rows that do not fit with the fields at fault.

    A field fits if it casts; a null fits only a nullable field.
    """
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = []
    for f in schema.fields:
        broken = cast[f.name].isNull() & (F.col(f.name).isNotNull() if f.nullable else F.lit(True))
        bad.append(F.when(broken, F.lit(f.name)))
    checked = source.withColumn("faults", F.array_compact(F.array(*bad)))
    fits = checked.where(F.size("faults") == 0).select(
        *[e.alias(n) for n, e in cast.items()])
    return fits, checked.where(F.size("faults") > 0)


def ingest(source: DataFrame, entity: str, features: Mapping[str, tuple[str, str]],
           feature_time: datetime | str, ingest_id: Column | str | None = None) -> DataFrame:
    """History rows from a source: ``features`` maps feature id to (source field, type).

    ``feature_time`` is one constant time for all rows, or the name of a time column. Map-only,
    so it appends at the speed of the scan. ``ingest_id`` breaks ties between equal times.
    """
    when = F.col(feature_time) if isinstance(feature_time, str) else F.lit(feature_time)
    order = F.lit(0) if ingest_id is None else (F.col(ingest_id) if isinstance(ingest_id, str) else ingest_id)
    return source.select(
        F.col(entity).cast("string").alias(ENTITY), when.cast("timestamp").alias(TIME),
        order.cast("long").alias(INGEST),
        *[F.col(field).cast(kind).alias(name) for name, (field, kind) in features.items()])


def last_write(history: DataFrame) -> DataFrame:
    """One row per (entity, time): the last one ingested."""
    rest = [c for c in history.columns if c not in (ENTITY, TIME)]
    return (history.groupBy(ENTITY, TIME)
            .agg(F.max_by(F.struct(*rest), INGEST).alias("r")).select(ENTITY, TIME, "r.*"))


def latest(history: DataFrame, features: Sequence[str] | None = None,
           ids: DataFrame | None = None) -> DataFrame:
    """Newest row per entity, for all entities or the ids given.

    Partial aggregation leaves one row per entity and task, so a hot entity is no burden.
    """
    features = _features(history, features)
    if ids is not None:
        history = history.join(ids.select(F.col(ids.columns[0]).cast("string").alias(ENTITY)),
                               ENTITY, "left_semi")
    return (history.groupBy(ENTITY)
            .agg(F.max_by(F.struct(TIME, *features), F.struct(TIME, INGEST)).alias("r"))
            .select(ENTITY, "r.*"))


def as_of(reads: DataFrame, history: DataFrame, entity: str, at: str,
          features: Sequence[str] | None = None, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """For each read (entity, time) the newest history row at or before that time.

    Both sides go to one shuffle by entity and one sort. Entities with more than
    ``rows_per_slice`` rows are set apart and dealt by (entity, time) into ranges of equal numbers
    of rows, so neither a third of all rows nor a burst within a second is the work of one task.
    What a range inherits from earlier ones is one row per entity, found over summaries of the
    ranges. All reads come back; a null or unknown entity, or a null time, gives nulls.
    """
    features = _features(history, features)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    pack = F.struct(F.col(TIME), *[F.col(f) for f in features])
    past = history.where(F.col(ENTITY).isNotNull() & F.col(TIME).isNotNull()).select(
        F.col(ENTITY).alias("_e"), micros(TIME).alias("_t"),
        F.lit(0).alias("_side"), F.col(INGEST).alias("_o"), pack.alias("_pack"))
    whole = F.struct(*reads.columns)
    known = F.col(entity).isNotNull() & F.col(at).cast("timestamp").isNotNull()
    asked = reads.where(known).select(
        F.col(entity).cast("string").alias("_e"), micros(at).alias("_t"), F.lit(1).alias("_side"),
        F.lit(0).cast("long").alias("_o"), whole.alias("_read"))
    both = past.unionByName(asked, allowMissingColumns=True)
    # counting reads the keys only; there are at most (all rows / rows_per_slice) hot entities
    hot = both.groupBy("_e").agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_slice)
    if hot.isEmpty():
        found = _last_before(both, ["_e"])
    else:
        hot = cut(hot)
        marked = lookup(both, hot, ["_e"], written=True)
        ranges = _equal_ranges(marked.where("_n is not null").drop("_n"), hot, rows_per_slice)
        carried = ranges.unionByName(_inherited(ranges), allowMissingColumns=True)
        cool = _last_before(marked.where("_n is null").drop("_n"), ["_e"])
        found = cool.unionByName(_last_before(carried, ["_range", "_e"]))
    nowhere = reads.where(~known).select(whole.alias("_read"))
    found = found.unionByName(nowhere, allowMissingColumns=True)
    return found.select("_read.*", F.col(f"_found.{TIME}").alias(TIME),
                        *[F.col(f"_found.{f}").alias(f) for f in features])


def _last_before(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``_read, _found`` of each read: the last history row that sorts before it."""
    # nulls sort first: an inherited row leads its range
    order = Window.partitionBy(*by).orderBy(
        F.col("_t").asc_nulls_first(), "_side", "_o").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("_found", F.last("_pack", ignorenulls=True).over(order))
            .where("_side = 1").select("_read", "_found"))


def _equal_ranges(rows: DataFrame, hot: DataFrame, rows_per_slice: int) -> DataFrame:
    """Rows with the number of their range in the order of entity, time and side, written once.

    Rows of one entity and time are told apart by a hash of their values, so they may lie in
    several ranges too.
    """
    count = 1 + 2 * (hot.agg(F.sum("_n")).first()[0] // rows_per_slice)
    tie = F.xxhash64(F.to_json("_pack"), F.to_json("_read"))
    dealt = rows.withColumn("_tie", tie).repartitionByRange(count, "_e", "_t", "_side", "_o", "_tie")
    return cut(dealt.withColumn("_range", F.spark_partition_id()).drop("_tie"))


def _inherited(ranges: DataFrame) -> DataFrame:
    """For each range and entity, the newest history row of the ranges before it."""
    event = F.col("_side") == 0
    summaries = ranges.groupBy("_e", "_range").agg(
        F.max_by(F.when(event, F.col("_pack")), F.when(event, F.struct("_t", "_o"))).alias("_last"))
    # one row per entity and range
    before = (Window.partitionBy("_e").orderBy("_range")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (summaries.withColumn("_pack", F.last("_last", ignorenulls=True).over(before))
            .where("_pack is not null").select("_e", "_range", "_pack", F.lit(-1).alias("_side")))


def write_reads(df: DataFrame, table: str) -> None:
    """Save a point-in-time read; the table must not exist yet."""
    df.write.mode("errorifexists").saveAsTable(table)


def daily_snapshots(history: DataFrame, measures: Mapping[str, Column], group: Sequence[Column] = (),
                    staleness_days: int = 30) -> DataFrame:
    """Per day, sums of measures over the latest row of each entity, if it is fresh enough.

    ``measures`` and ``group`` are expressions over the history's features; measures must be
    exact (whole numbers), as they are added and taken away again. A day's last row of an entity
    counts from its day until the entity's next one or until it is stale. Each row is thus two
    changes, +x and -x, and a day's total is a running sum over days: no row is repeated per day.
    ``entities`` counts the rows behind a total.
    """
    group = list(group)
    day = F.to_date(TIME)
    keep = [c for c in history.columns if c != ENTITY]
    daily = (history.groupBy(ENTITY, day.alias("_day"))
             .agg(F.max_by(F.struct(*keep), F.struct(TIME, INGEST)).alias("r"))
             .select(ENTITY, "_day", "r.*"))
    # one row per entity and day: a group is bounded by the days of the history
    following = F.lead("_day").over(Window.partitionBy(ENTITY).orderBy("_day"))
    stale = F.date_add("_day", staleness_days + 1)
    spans = daily.withColumn("_until", F.least(F.coalesce(following, stale), stale))
    named = {**measures, "entities": F.lit(1)}
    names = [f"g{i}" for i in range(len(group))]
    change = lambda when, sign: F.struct(
        F.col(when).alias("day"), *[(m.cast("long") * sign).alias(n) for n, m in named.items()])
    changes = (spans.select(*[g.alias(n) for n, g in zip(names, group)],
                            F.explode(F.array(change("_day", 1), change("_until", -1))).alias("c"))
               .groupBy(*names, "c.day").agg(*[F.sum(f"c.{n}").alias(n) for n in named]))
    # days (x groups): a summary, whatever the number of entities
    running = (Window.partitionBy(*names).orderBy("day")
               .rowsBetween(Window.unboundedPreceding, 0))
    totals = changes.select(*names, "day", *[F.sum(n).over(running).alias(n) for n in named],
                            F.lead("day").over(Window.partitionBy(*names).orderBy("day")).alias("_next"))
    newest = history.agg(F.max(day)).scalar()
    # days without a change repeat the day before, up to the newest day of the history
    last = F.least(F.coalesce(F.date_sub("_next", 1), newest), newest)
    filled = totals.where(F.col("day") <= newest).select(
        *names, F.explode(F.sequence(F.col("day"), last)).alias("day"), *named)
    return filled.where("entities > 0")


def _features(history: DataFrame, features: Sequence[str] | None) -> list[str]:
    if features is None or list(features) == ["*"]:
        return [c for c in history.columns if c not in (ENTITY, TIME, INGEST)]
    return list(features)
