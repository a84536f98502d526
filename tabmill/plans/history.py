"""Queries: the feature store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F, types as T

from tabmill.operators import feature_store as store
from tabmill.plans.registry import query, sql_cents, table
from tabmill.session import fresh_path


def k_of():
    """The number in an event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


SQL_K = "cast(json_extract_string(props, '$.k') as integer)"


def event_history(spark, sf, kinds=None):
    """Events as feature history per user."""
    events = table(spark, sf, "events").withColumn("k", k_of())
    if kinds:
        events = events.where(F.col("event_type").isin(kinds))
    return store.ingest(events, "user_id", {"value": ("value", "double"), "k": ("k", "int"),
                                            "event_id": ("event_id", "long")}, "ts", "event_id")


@query(f"""
with s as (select event_id, case when {SQL_K} % 10 = 0 then {SQL_K} || 'x' else '' || {SQL_K} end as k from events)
select event_id, try_cast(k as smallint) as k, case when try_cast(k as smallint) is null then 'k' else '' end as faults from s""")
def conform(spark, sf):
    text = F.when(k_of() % 10 == 0, F.concat(k_of().cast("string"), F.lit("x"))).otherwise(k_of().cast("string"))
    source = table(spark, sf, "events").select("event_id", text.alias("k"))
    schema = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("k", T.ShortType())])
    fits, rest = store.conform(source, schema)
    return fits.withColumn("faults", F.lit("")).unionByName(
        rest.select("event_id", F.lit(None).cast("short").alias("k"), F.concat_ws(",", "faults").alias("faults")))


@query(f"""
select cast(c_custkey as varchar) as entity_id, '2023-01-23 09:30:00' as feature_time, c_acctbal as balance,
       c_mktsegment as segment from customer""")
def ingest_constant_time(spark, sf):
    """The source field c_acctbal becomes feature ``balance``, one time for all rows."""
    history = store.ingest(table(spark, sf, "customer"), "c_custkey",
                           {"balance": ("c_acctbal", "double"), "segment": ("c_mktsegment", "string")},
                           datetime(2023, 1, 23, 9, 30))
    return history.select("entity_id", F.date_format("feature_time", "yyyy-MM-dd HH:mm:ss").alias("feature_time"),
                          "balance", "segment")


@query("""
select cast(l_orderkey as varchar) as entity_id, l_quantity as quantity, l_extendedprice as price,
       l_returnflag as flag from lineitem""")
def ingest_lines(spark, sf):
    """A bulk import with one constant time: map-only."""
    history = store.ingest(table(spark, sf, "lineitem"), "l_orderkey", {
        "quantity": ("l_quantity", "double"), "price": ("l_extendedprice", "double"),
        "flag": ("l_returnflag", "string")}, datetime(2021, 1, 1, 9, 30))
    return history.select("entity_id", "quantity", "price", "flag")


@query("""
select cast(user_id as varchar) as entity_id, strftime(date_trunc('day', ts), '%Y-%m-%d') as day,
       arg_max(value, event_id) as value from events group by 1, 2""")
def ingest_row_time(spark, sf):
    """Per-row times cut to the day, so that rows collide: the last one written wins."""
    events = table(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts"))
    history = store.ingest(events, "user_id", {"value": ("value", "double")}, "day", "event_id")
    return store.last_write(history).select(
        "entity_id", F.date_format("feature_time", "yyyy-MM-dd").alias("day"), "value")


@query(f"""
with ids as (select distinct user_id from events where event_type = 'error')
select cast(user_id as varchar) as entity_id, arg_max(value, (ts, event_id)) as value,
       arg_max(event_id, (ts, event_id)) as event_id
from events where user_id in (select user_id from ids) group by user_id""")
def latest_values(spark, sf):
    ids = table(spark, sf, "events").where("event_type = 'error'").select("user_id").distinct()
    return store.latest(event_history(spark, sf), ["value", "event_id"], ids).drop("feature_time")


_asof = f"""
with r as (select event_id as read_id, user_id, ts from events where event_type = 'error'),
h as (select event_id, user_id, ts, value, {SQL_K} as k from events where event_type <> 'error')
select r.read_id, cast(r.user_id as varchar) as user_id, h.event_id, h.value, h.k
from r asof left join h on r.user_id = h.user_id and r.ts >= h.ts"""


def _reads(spark, sf):
    return table(spark, sf, "events").where("event_type = 'error'").select(
        F.col("event_id").alias("read_id"), F.col("user_id").cast("string").alias("user_id"), "ts")


def _other(spark, sf):
    events = table(spark, sf, "events").where("event_type <> 'error'").withColumn("k", k_of())
    return store.ingest(events, "user_id", {"value": ("value", "double"), "k": ("k", "int"),
                                            "event_id": ("event_id", "long")}, "ts", "event_id")


@query(_asof)
def asof_join(spark, sf):
    return store.as_of(_reads(spark, sf), _other(spark, sf), "user_id", "ts").drop("ts", "feature_time")


@query(_asof.replace("h.event_id, h.value, h.k", "h.k"))
def asof_one_feature(spark, sf):
    """A feature subset: the scan of the history reads only what is asked for."""
    return store.as_of(_reads(spark, sf), _other(spark, sf), "user_id", "ts", ["k"]).drop("ts", "feature_time")


@query(f"""
with e as (select *, {sql_cents('value')} as cents, cast(ts as date) as day from events),
d as (select user_id, day, arg_max(cents, (ts, event_id)) as cents from e group by 1, 2),
span as (select unnest(generate_series(min(day), max(day), interval 1 day))::date as day from e),
u as (select distinct user_id from e),
a as (select span.day as on_day, d.day, cents from span cross join u asof join d on u.user_id = d.user_id and span.day >= d.day)
select strftime(on_day, '%Y-%m-%d') as day, count(*) as entities, cast(sum(cents) as bigint) as cents from a
where date_diff('day', day, on_day) <= 3 group by on_day""")
def snapshot_stats(spark, sf):
    """Latest value per user at the end of each day, if not older than three days."""
    cents = F.round(F.col("value") * 100).cast("long")
    out = store.daily_snapshots(event_history(spark, sf), {"cents": cents}, staleness_days=3)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "entities", "cents")


@query(f"""
with e as (select *, {SQL_K} as k, cast(ts as date) as day from events),
d as (select user_id, day, arg_max(k, (ts, event_id)) as k from e group by 1, 2),
span as (select unnest(generate_series(min(day), max(day), interval 1 day))::date as day from e),
u as (select distinct user_id from e),
a as (select span.day as on_day, d.day, k from span cross join u asof join d on u.user_id = d.user_id and span.day >= d.day)
select strftime(on_day, '%Y-%m-%d') as day, cast(floor(k / 25) as integer) as bin, count(*) as entities from a
where date_diff('day', day, on_day) <= 30 group by all""")
def snapshot_bins(spark, sf):
    """Distribution of the latest value per day."""
    out = store.daily_snapshots(event_history(spark, sf), {}, [F.floor(F.col("k") / 25).cast("int")])
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("g0").alias("bin"), "entities")


@query(_asof)
def stored_reads(spark, sf):
    """The point-in-time read saved as a catalog table that must not exist yet."""
    name = "reads_" + fresh_path(spark, "reads").rsplit("-", 1)[1]
    store.write_reads(store.as_of(_reads(spark, sf), _other(spark, sf), "user_id", "ts"), name)
    return spark.read.table(name).drop("ts", "feature_time")


@query(_asof.replace("select r.read_id, cast(r.user_id as varchar) as user_id, h.event_id, h.value, h.k",
                     "select r.read_id, h.value") + " where h.event_id is not null")
def complete_rows(spark, sf):
    """Rows with a null dropped after the point-in-time join."""
    joined = store.as_of(_reads(spark, sf), _other(spark, sf), "user_id", "ts", ["value"])
    return joined.dropna("any").select("read_id", "value")


@query("select event_id, event_type as kind, value as amount from events")
def rename_features(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    return df.withColumnsRenamed({"event_type": "kind", "value": "amount"})
