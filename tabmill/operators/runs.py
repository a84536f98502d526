"""Runs, their metrics, comparison tables, lineage and dataset snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabmill.session import cut, fresh_path


def run_metrics(scored: DataFrame, metrics: Mapping[str, Column], run: str = "run",
                step: str | None = None) -> DataFrame:
    """Metrics of all runs from one scored frame: ``(run, step, kind, key, value)``.

    With ``step`` there is a value per run and step (epoch).
    """
    by = [F.col(run).alias("run")]
    by.append(F.col(step).cast("long").alias("step") if step else F.lit(None).cast("long").alias("step"))
    wide = scored.groupBy(*by).agg(*[m.cast("double").alias(n) for n, m in metrics.items()])
    return (wide.unpivot(["run", "step"], list(metrics), "key", "value")
            .select("run", "step", F.lit("metric").alias("kind"), "key", "value"))


def run_params(df: DataFrame, params: Mapping[str, Column], run: str = "run") -> DataFrame:
    """Parameters in the same long form."""
    wide = df.select(F.col(run).alias("run"), *[p.cast("double").alias(n) for n, p in params.items()])
    return (wide.unpivot(["run"], list(params), "key", "value")
            .select("run", F.lit(None).cast("long").alias("step"), F.lit("param").alias("kind"), "key", "value"))


def run_table(log: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per run, a column per name ``param.x`` or ``metric.x``."""
    named = log.where("step is null").withColumn("name", F.concat_ws(".", "kind", "key"))
    return named.groupBy("run").pivot("name", list(names)).agg(F.first("value"))


def transposed(table: DataFrame, runs: Sequence[str]) -> DataFrame:
    """The run table turned: one row per name, one column per run."""
    names = [c for c in table.columns if c != "run"]
    quoted = [f"`{n}`" for n in names]  # the names hold dots
    return (table.unpivot(["run"], quoted, "name", "value")
            .groupBy("name").pivot("run", list(runs)).agg(F.first("value")))


def compare_runs(log: DataFrame, one: str, two: str) -> DataFrame:
    """``(key, one, two, difference)`` for the metrics of two runs."""
    side = lambda r: F.max(F.when(F.col("run") == r, F.col("value")))
    return (log.where((F.col("kind") == "metric") & F.col("step").isNull() & F.col("run").isin(one, two))
            .groupBy("key").agg(side(one).alias("one"), side(two).alias("two"))
            .withColumn("difference", F.col("two") - F.col("one")))


TASK_EDGES = 4_000_000  # of one node, that a task should meet


def upstream(edges: DataFrame, targets: DataFrame, buckets: int | None = None, task_edges: int = TASK_EDGES) -> DataFrame:
    """Everything the targets were made from: ``(node, depth)``, targets at depth 0.

    ``edges`` is ``(execution, direction, artifact)`` with direction "input" or "output";
    ``targets`` is ``(node)``. Breadth first: a round joins the new nodes only, so no pair of
    ancestor and descendant is ever written, and each node is met once. Rounds are written to
    the shared folder; their number is the depth of the lineage.

    Edges are written once, bucketed by node, so a round moves its new nodes to the edges and not the other way. The
    edges of a node with more than ``task_edges`` are dealt to as many buckets as they need, by their parent. There
    are as many ``buckets`` as shuffle partitions, unless told otherwise.
    """
    spark = edges.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = F.col("direction") == "output"
    links = edges.select(
        F.when(made, F.col("artifact")).otherwise(F.col("execution")).alias("node"),
        F.when(made, F.col("execution")).otherwise(F.col("artifact")).alias("parent")).where("node is not null and parent is not null")
    # at most (edges / task_edges) nodes are hot
    hot = cut(links.groupBy("node").count().where(F.col("count") > task_edges)
              .select("node", F.ceil(F.col("count") / task_edges).cast("int").alias("spread")))
    spread = F.coalesce("spread", F.lit(1))
    name = f"tabmill_edges_{uuid.uuid4().hex[:12]}"
    (links.join(F.broadcast(hot), "node", "left")
     .select("node", "parent", F.pmod(F.xxhash64("parent"), spread).cast("int").alias("part"))
     .repartition(buckets, "node", "part").write.bucketBy(buckets, "node", "part").sortBy("node", "part")
     .option("path", fresh_path(spark, "edges")).saveAsTable(name))
    stored = spark.read.table(name)
    try:
        return _ancestors(stored, hot, targets)
    finally:
        spark.sql(f"drop table {name}")


def _reached(stored: DataFrame, hot: DataFrame, nodes: DataFrame) -> DataFrame:
    """Parents of nodes, each once; the stored edges stay in their buckets."""
    dealt = nodes.join(F.broadcast(hot), "node", "left").select(
        "node", F.explode(F.sequence(F.lit(0), F.coalesce("spread", F.lit(1)) - 1)).alias("part"))
    return stored.join(dealt, ["node", "part"]).select(F.col("parent").alias("node")).distinct()


def _ancestors(stored: DataFrame, hot: DataFrame, targets: DataFrame) -> DataFrame:
    seen = cut(targets.select("node").distinct().withColumn("depth", F.lit(0)))
    frontier, depth = seen.select("node"), 0
    while True:  # each node is met once, so the rounds end
        depth += 1
        # no Observation: once a session has made one, Spark's binary logistic models, which hold the session, cannot be sent to tasks
        new = cut(_reached(stored, hot, frontier).join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if new.isEmpty():
            return seen
        seen = seen.unionByName(new)
        if depth % 20 == 0:  # keeps the plan of a deep lineage short
            seen = cut(seen)
        frontier = new.select("node")


def snapshot(spark: SparkSession, sql: str, prefix: str = "snapshot", folder: str | None = None) -> str:
    """Store the result of a SQL text as a table of a new name, and return the name."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    writer = spark.sql(sql).write.mode("errorifexists")
    if folder:
        writer = writer.option("path", f"{folder}/{name}")
    writer.saveAsTable(name)
    return name
