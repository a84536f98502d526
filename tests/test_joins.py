from pyspark.sql import functions as F

from tabmill.functions.joins import lookup


def test_salted_join_equals_broadcast(spark):
    """A key with a third of the rows, keys without a table row, null keys."""
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))).alias("k"))
    table = spark.range(300).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
                                    ).unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))
    for how in ("left", "inner"):
        small = lookup(df, table, ["k"], how)
        large = lookup(df, table, ["k"], how, max_bytes=0, task_rows=100)
        assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
        assert small.columns == large.columns
        assert sorted(map(tuple, small.fillna("", ["k"]).fillna(-9, ["v"]).collect())) == sorted(
            map(tuple, large.fillna("", ["k"]).fillna(-9, ["v"]).collect()))


def test_salt_depends_on_the_row_alone(spark):
    """A third of the rows hold one key: its salts are the same under two row orders."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    table = spark.range(-1, 3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = [sorted(map(tuple, lookup(d, table, ["k"], max_bytes=0, task_rows=100).collect()))
             for d in (df.orderBy("id"), df.orderBy(F.desc("id")).repartition(7))]
    assert found[0] == found[1] and len(found[0]) == 3000
    plan = lookup(df, table, ["k"], max_bytes=0, task_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "rand(" not in plan
