import pytest
from pyspark.sql import functions as F

from tabmill.operators import evaluate, runs


def test_metrics_table_and_comparison(spark):
    scored = spark.createDataFrame([("r0", 1, 1.0, 1.5), ("r0", 2, 2.0, 2.0), ("r1", 1, 1.0, 3.0)],
                                   "run string, step int, label double, prediction double")
    metrics = {"mae": evaluate.mae("label", "prediction")}
    log = runs.run_metrics(scored, metrics).unionByName(runs.run_params(
        scored.groupBy("run").agg(F.count("*").alias("n")), {"rows": F.col("n")}))
    table = runs.run_table(log, ["metric.mae", "param.rows"])
    assert sorted(map(tuple, table.collect())) == [("r0", 0.25, 2.0), ("r1", 2.0, 1.0)]
    turned = runs.transposed(table, ["r0", "r1"])
    assert sorted(map(tuple, turned.collect())) == [("metric.mae", 0.25, 2.0), ("param.rows", 2.0, 1.0)]
    assert runs.compare_runs(log, "r0", "r1").first().difference == 1.75
    epochs = runs.run_metrics(scored, metrics, step="step")
    assert {(r.run, r.step): r.value for r in epochs.collect()} == {("r0", 1): 0.5, ("r0", 2): 0.0, ("r1", 1): 2.0}


@pytest.mark.parametrize("task_edges", [runs.TASK_EDGES, 100])
def test_lineage_with_a_hot_execution_and_a_cycle(spark, task_edges):
    edges = [("prep", "input", f"raw{i}") for i in range(2000)] + [
        ("prep", "output", "clean"), ("train", "input", "clean"), ("train", "output", "model"),
        ("other", "input", "raw1"), ("other", "output", "side"), ("loop", "input", "model"), ("loop", "output", "raw0")]
    df = spark.createDataFrame(edges, "execution string, direction string, artifact string")
    got = {r.node: r.depth for r in runs.upstream(df, spark.createDataFrame([("model",)], "node string"),
                                                      task_edges=task_edges).collect()}
    assert got["train"] == 1 and got["clean"] == 2 and got["prep"] == 3 and got["raw7"] == 4 and got["loop"] == 5
    assert "side" not in got and len(got) == 2000 + 5


def test_snapshots_have_names_of_their_own(spark, tmp_path):
    names = [runs.snapshot(spark, "select 1 as a", folder=str(tmp_path)) for _ in range(2)]
    assert names[0] != names[1] and spark.read.table(names[1]).first().a == 1
    for n in names:
        spark.sql(f"drop table {n}")


def test_lineage_moves_no_edges(spark):
    """A round's plan exchanges its new nodes; the bucketed edges are scanned where they are."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    links = spark.range(5000).select(F.concat(F.lit("n"), F.col("id") % 700).alias("node"),
                                     F.concat(F.lit("p"), F.col("id")).alias("parent"), F.lit(0).alias("part"))
    links.write.bucketBy(8, "node", "part").sortBy("node", "part").saveAsTable("tabmill_test_edges")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        hot = spark.createDataFrame([], "node string, spread int")
        nodes = spark.range(300).select(F.concat(F.lit("n"), "id").alias("node"))
        joined = runs._reached(spark.read.table("tabmill_test_edges"), hot, nodes)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        lines = plan.splitlines()
        edges = next(i for i, line in enumerate(lines) if "tabmill_test_edges" in line)
        join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        one_side = lines[join + 1:edges]  # from the join down to the scan of the edges
        assert not any("Exchange" in line for line in one_side), plan
        assert joined.count() == links.join(nodes, "node").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("drop table if exists tabmill_test_edges")


def test_lineage_of_nothing(spark):
    edges = spark.createDataFrame([], "execution string, direction string, artifact string")
    none = runs.upstream(edges, spark.createDataFrame([], "node string"))
    assert none.count() == 0 and none.columns == ["node", "depth"]
    one = runs.upstream(edges, spark.createDataFrame([("a",), ("a",)], "node string"))
    assert [tuple(r) for r in one.collect()] == [("a", 0)]
