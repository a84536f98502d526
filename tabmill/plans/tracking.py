"""Queries: runs, comparison tables, lineage and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabmill.operators import evaluate, runs
from tabmill.plans.history import SQL_K, k_of
from tabmill.plans.registry import query, table
from tabmill.session import fresh_path

_scored_sql = f"""
s as (select event_type as run, day(ts) as step, {SQL_K} as label, value as prediction,
             cast({SQL_K} >= 50 as integer) as y, cast(value >= 25 as integer) as said from events)"""


def _scored(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("run"), F.dayofmonth("ts").alias("step"), k_of().alias("label"),
        F.col("value").alias("prediction"), (k_of() >= 50).cast("int").alias("y"),
        (F.col("value") >= 25).cast("int").alias("said"))


def metrics():
    return {"accuracy": evaluate.accuracy("y", "said"), "eval_mae": evaluate.mae("label", "prediction")}


def _rounded(log):
    return log.withColumn("value", F.round("value", 6))


def _log_sql(step: str) -> str:
    return f"""
select run, cast({step} as bigint) as step, 'metric' as kind, 'accuracy' as key, round(avg(cast(y = said as integer)), 6) as value from s group by run, {step}
union all select run, cast({step} as bigint), 'metric', 'eval_mae', round(avg(abs(label - prediction)), 6) from s group by run, {step}"""


@query(f"with {_scored_sql} {_log_sql('null').replace(', null', '')}".replace("group by run, null", "group by run"))
def run_metrics(spark, sf):
    return _rounded(runs.run_metrics(_scored(spark, sf), metrics()))


@query(f"with {_scored_sql} {_log_sql('step')}")
def epoch_metrics(spark, sf):
    return _rounded(runs.run_metrics(_scored(spark, sf), metrics(), step="step"))


def _log(spark, sf):
    scored = _scored(spark, sf)
    sizes = scored.groupBy("run").agg(F.count("*").alias("rows"), F.count_distinct("step").alias("epochs"))
    params = runs.run_params(sizes, {"rows": F.col("rows"), "epochs": F.col("epochs")})
    return _rounded(runs.run_metrics(scored, metrics())).unionByName(params)


NAMES = ["metric.accuracy", "metric.eval_mae", "param.epochs", "param.rows"]
_wide_sql = f"""
with {_scored_sql},
t as (select run, round(avg(cast(y = said as integer)), 6) as "metric.accuracy",
      round(avg(abs(label - prediction)), 6) as "metric.eval_mae",
      cast(count(distinct step) as double) as "param.epochs", cast(count(*) as double) as "param.rows" from s group by run)"""


@query(f"{_wide_sql} select * from t")
def run_table(spark, sf):
    return runs.run_table(_log(spark, sf), NAMES)


RUNS = ["click", "error", "purchase", "signup", "view"]


@query(f"{_wide_sql}, l as (unpivot t on columns(* exclude run) into name name value v) select name, "
       + ", ".join(f"""max(v) filter (where run = '{r}') as "{r}" """ for r in RUNS) + " from l group by name")
def run_table_turned(spark, sf):
    return runs.transposed(runs.run_table(_log(spark, sf), NAMES), RUNS)


@query(f"""
with {_scored_sql},
m as (select run, round(avg(cast(y = said as integer)), 6) as accuracy, round(avg(abs(label - prediction)), 6) as eval_mae
      from s where run in ('click', 'view') group by run)
select 'accuracy' as key, a.accuracy as one, b.accuracy as two, round(b.accuracy - a.accuracy, 6) as difference
from m a, m b where a.run = 'click' and b.run = 'view'
union all select 'eval_mae', a.eval_mae, b.eval_mae, round(b.eval_mae - a.eval_mae, 6)
from m a, m b where a.run = 'click' and b.run = 'view'""")
def run_compare(spark, sf):
    return runs.compare_runs(_log(spark, sf), "click", "view").withColumn("difference", F.round("difference", 6))


_edges_sql = """
edges as (
  select distinct 'order-' || l_orderkey as execution, 'input' as direction, 'part-' || l_partkey as artifact from lineitem
  union all select 'order-' || o_orderkey, 'output', 'invoice-' || o_orderkey from orders
  union all select 'bill-' || o_custkey, 'input', 'invoice-' || o_orderkey from orders
  union all select 'bill-' || c_custkey, 'output', 'account-' || c_custkey from customer
  union all select 'report-' || c_nationkey, 'input', 'account-' || c_custkey from customer
  union all select 'report-' || n_nationkey, 'output', 'summary-' || n_nationkey from nation),
links as (select distinct case direction when 'output' then artifact else execution end as node,
                 case direction when 'output' then execution else artifact end as parent from edges)"""


def _edges(spark, sf):
    t = lambda n: table(spark, sf, n)
    name = lambda prefix, c: F.concat(F.lit(prefix + "-"), F.col(c).cast("string"))

    def edge(df, execution, direction, artifact):
        return df.select(execution.alias("execution"), F.lit(direction).alias("direction"), artifact.alias("artifact"))

    parts = [
        edge(table(spark, sf, "lineitem"), name("order", "l_orderkey"), "input", name("part", "l_partkey")),
        edge(t("orders"), name("order", "o_orderkey"), "output", name("invoice", "o_orderkey")),
        edge(t("orders"), name("bill", "o_custkey"), "input", name("invoice", "o_orderkey")),
        edge(t("customer"), name("bill", "c_custkey"), "output", name("account", "c_custkey")),
        edge(t("customer"), name("report", "c_nationkey"), "input", name("account", "c_custkey")),
        edge(t("nation"), name("report", "n_nationkey"), "output", name("summary", "n_nationkey"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""
with recursive {_edges_sql},
up(node, depth) as (
  select 'summary-' || n_nationkey, 0 from nation
  union select parent, depth + 1 from up join links using (node))
select node, cast(min(depth) as integer) as depth from up group by node""")
def lineage_closure(spark, sf):
    """Everything the reports of all nations were made from."""
    targets = table(spark, sf, "nation").select(F.concat(F.lit("summary-"), F.col("n_nationkey").cast("string")).alias("node"))
    return runs.upstream(_edges(spark, sf), targets)


@query("""
select o_orderpriority, count(*) as n from orders where o_orderstatus = 'F' group by o_orderpriority""")
def dataset_snapshot(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("tabmill_orders")
    name = runs.snapshot(spark, """
        select o_orderpriority, count(*) as n from tabmill_orders where o_orderstatus = 'F' group by o_orderpriority
    """, folder=fresh_path(spark, "snapshots"))
    return spark.read.table(name)
