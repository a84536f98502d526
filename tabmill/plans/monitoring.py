"""Queries: skew, drift, anomalies, the retrain decision, and the streaming forms."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tabmill.operators import feature_store as store, imports, monitor
from tabmill.plans.history import SQL_K, k_of
from tabmill.plans.prepare import _sql_bin
from tabmill.plans.registry import ORACLES, query, sql_in_fraction, table
from tabmill.session import fresh_path
from tabmill.streaming import jobs

PRICE_EDGES = {"o_totalprice": [float(x) for x in range(50_000, 500_000, 50_000)]}
EVENT_EDGES = {"value": [1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0], "k": [20.0, 40.0, 60.0, 80.0]}


def _sql_compare(by: str = "") -> str:
    """From ``sides(by, feature, kind, bin, b, c)`` to distances."""
    keys = f"{by}, " if by else ""
    return f"""
bins as (select {keys}feature, kind, bin, sum(b) as b, sum(c) as c from sides group by all),
sized as (select *, sum(b) over (partition by {keys}feature) as tb, sum(c) over (partition by {keys}feature) as tc from bins),
share as (select {keys}feature, kind, b / tb as p, c / tc as q from sized where tb > 0 and tc > 0),
found as (select {keys}feature, kind, max(abs(p - q)) as diff,
   sum(case when p > 0 then p * ln(2 * p / (p + q)) / 2 else 0 end + case when q > 0 then q * ln(2 * q / (p + q)) / 2 else 0 end) as js
   from share group by all),
distances as (select {keys}feature, kind, case kind when 'number' then js else diff end as distance from found)"""


_order_stack = f"""
select 'o_totalprice' as feature, 'number' as kind, cast({_sql_bin('o_totalprice', PRICE_EDGES['o_totalprice'])} as varchar) as bin, o_orderdate from orders
union all select 'o_orderpriority', 'category', o_orderpriority, o_orderdate from orders
union all select 'o_orderstatus', 'category', o_orderstatus, o_orderdate from orders"""

_SKEW = f"""
with s as ({_order_stack}),
sides as (select feature, kind, bin, cast(o_orderdate < timestamp '1998-07-01' as integer) as b,
                 cast(o_orderdate >= timestamp '1998-07-01' as integer) as c from s), {_sql_compare()}"""


def _order_skew(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    return monitor.skew(orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut),
                        PRICE_EDGES, ["o_orderpriority", "o_orderstatus"])


@query(f"{_SKEW} select feature, kind, round(distance, 9) as distance from distances")
def skew(spark, sf):
    return _order_skew(spark, sf).withColumn("distance", F.round("distance", 9))


@query(f"""
{_SKEW}
select feature, cast(case feature when 'o_orderpriority' then 0.5 else 0.001 end as double) as "limit",
       distance > case feature when 'o_orderpriority' then 0.5 else 0.001 end as anomaly from distances""")
def skew_limits(spark, sf):
    return monitor.with_limits(_order_skew(spark, sf), {"o_orderpriority": 0.5}).select("feature", "limit", "anomaly")


def _sql_drift(stack: str) -> str:
    return f"""
with s as ({stack}), h as (select w, feature, kind, bin, count(*) as n from s group by all),
steps as (select w, lead(w) over (order by w) as nxt from (select distinct w from h)),
sides as (select w, feature, kind, bin, 0 as b, n as c from h
          union all select nxt, feature, kind, bin, n, 0 from h join steps using (w) where nxt is not null), {_sql_compare('w')}"""


_event_stack = f"""
select cast(ts as date) as w, 'value' as feature, 'number' as kind, cast({_sql_bin('value', EVENT_EDGES['value'])} as varchar) as bin from events
union all select cast(ts as date), 'k', 'number', cast({_sql_bin(SQL_K, EVENT_EDGES['k'])} as varchar) from events
union all select cast(ts as date), 'event_type', 'category', event_type from events"""
_DRIFT = _sql_drift(_event_stack)


def _event_drift(spark, sf):
    events = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "value", k_of().alias("k"), "event_type")
    return monitor.drift(events, F.col("day"), EVENT_EDGES, ["event_type"])


@query(f"{_DRIFT} select strftime(w, '%Y-%m-%d') as day, feature, kind, round(distance, 9) as distance from distances")
def drift_daily(spark, sf):
    return _event_drift(spark, sf).select(F.date_format("window", "yyyy-MM-dd").alias("day"), "feature", "kind",
                                          F.round("distance", 9).alias("distance"))


_year_stack = _order_stack.replace("o_orderdate from", "year(o_orderdate) as w from")


@query(f"{_sql_drift(_year_stack)} select cast(w as integer) as year, feature, round(distance, 9) as distance from distances")
def import_stats(spark, sf):
    """Each imported batch (a year of orders) against the statistics of the one before."""
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("batch"), "o_totalprice",
                                               "o_orderpriority", "o_orderstatus")
    out = monitor.drift(orders, F.col("batch"), PRICE_EDGES, ["o_orderpriority", "o_orderstatus"])
    return out.select(F.col("window").alias("year"), "feature", F.round("distance", 9).alias("distance"))


def _imported(spark, sf, against):
    """The years of the orders, imported one after the other; each import reads the rows of its year."""
    folder, parts = fresh_path(spark, "imports"), []
    orders = table(spark, sf, "orders").select("o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    years = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    for year in range(years[0], years[1] + 1):
        first, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
        batch = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < end))
        parts.append(imports.record(batch, folder, str(year), PRICE_EDGES, ["o_orderpriority", "o_orderstatus"], against)
                     .withColumn("year", F.lit(year)))
    return folder, functools.reduce(lambda a, b: a.unionByName(b), parts)


@query(ORACLES["import_stats"])
def import_recorded(spark, sf):
    """As ``import_stats``, from the statistics that each import has stored."""
    return _imported(spark, sf, "latest")[1].select("year", "feature", F.round("distance", 9).alias("distance"))


@query(f"""
with s as ({_year_stack}), years as (select distinct w from s),
sides as (select y.w, s.feature, s.kind, s.bin, cast(s.w < y.w as integer) as b, cast(s.w = y.w as integer) as c
          from s join years y on s.w <= y.w where y.w > (select min(w) from years)), {_sql_compare('w')}
select cast(w as integer) as year, feature, round(distance, 9) as distance from distances""")
def import_against_all(spark, sf):
    """Each year of orders against the merged statistics of all years before it."""
    return _imported(spark, sf, "state")[1].select("year", "feature", F.round("distance", 9).alias("distance"))


@query("""
select 'o_totalprice' as feature, count(o_totalprice) as n, cast(count(*) - count(o_totalprice) as bigint) as missing,
  min(o_totalprice) as lo, max(o_totalprice) as hi, round(avg(o_totalprice), 4) as mean,
  round(stddev_samp(o_totalprice), 4) as std from orders""")
def import_state(spark, sf):
    """Moments of all orders, merged import by import."""
    folder, _ = _imported(spark, sf, "state")
    return imports.moments(imports.state(spark, folder)).withColumns(
        {c: F.round(c, 4) for c in ("mean", "std")})


_LIMITS = {"value": 0.01, "k": 0.008, "event_type": 0.05}
_limit_sql = "case feature " + " ".join(f"when '{f}' then {x}" for f, x in _LIMITS.items()) + " end"


def _anomalies(spark, sf):
    judged = monitor.with_limits(_event_drift(spark, sf), _LIMITS)
    return monitor.anomaly_counts(judged, "PREDICTION_DRIFT")


@query(f"""{_DRIFT} select feature, 'PREDICTION_DRIFT' as objective,
count(*) filter (where distance > {_limit_sql}) as anomaly_count from distances group by feature""")
def anomaly_count(spark, sf):
    return _anomalies(spark, sf)


@query(f"""{_DRIFT}, t as (select count(*) filter (where distance > {_limit_sql}) as n,
  count(*) filter (where feature = 'k' and distance > {_limit_sql}) as nk from distances)
select 'any' as watched, n as anomaly_count, n > 0 as retrain from t
union all select 'k', nk, nk > 0 from t union all select 'off', n, false from t""")
def retrain_decision(spark, sf):
    counts = _anomalies(spark, sf)
    row = lambda name, on, feature: monitor.retrain(counts, on, feature).withColumn("watched", F.lit(name))
    return row("any", True, None).unionByName(row("k", True, "k")).unionByName(row("off", False, None))


@query("""
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as n
from events group by all""")
def hourly_counts(spark, sf):
    out = monitor.hourly(table(spark, sf, "events"), "ts", ["event_type"])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


# -- streaming ----------------------------------------------------------------------------------
# Windows that end after the newest time less the delay are still open and not written.

_closed = "date_trunc('hour', ts) + interval 1 hour <= (select max(ts) - interval 10 minute from events)"


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return jobs.event_stream(spark, sf, schema, "ts", "events.parquet")


@query(f"""
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as n
from events where {_closed} group by all""")
def stream_hourly(spark, sf):
    path = fresh_path(spark, "hourly")
    jobs.append_to(jobs.hourly_counts(_stream(spark, sf), "ts", "event_id", ["event_type"]), path, path + "-progress")
    return spark.read.parquet(path).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(f"""
select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start, feature, bin, count(*) as n from (
  select ts, 'value' as feature, cast({_sql_bin('value', EVENT_EDGES['value'])} as varchar) as bin from events
  where {sql_in_fraction(0.8, 'event_id')}
  union all select ts, 'event_type', event_type from events where {sql_in_fraction(0.8, 'event_id')})
where date_trunc('hour', ts) + interval 1 hour <= (select max(ts) - interval 10 minute from events where {sql_in_fraction(0.8, 'event_id')})
group by all""")
def stream_histogram(spark, sf):
    path = fresh_path(spark, "histogram")
    counts = jobs.serving_histogram(_stream(spark, sf), "ts", "event_id", {"value": EVENT_EDGES["value"]}, ["event_type"])
    jobs.append_to(counts, path, path + "-progress")
    return spark.read.parquet(path).drop("kind").withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("""
select cast(user_id as varchar) as entity_id, arg_max(value, (ts, event_id)) as value,
       arg_max(event_id, (ts, event_id)) as event_id from events group by user_id""")
def stream_latest(spark, sf):
    history = store.ingest(_stream(spark, sf), "user_id", {"value": ("value", "double"), "event_id": ("event_id", "long")},
                           "ts", "event_id")
    path = fresh_path(spark, "latest")
    jobs.ingest_latest(history, path, path + "-progress")
    return jobs.read_latest(spark, path).select("entity_id", "value", "event_id")
