import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabmill.functions import order
from tabmill.functions.hashing import digest


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e9, 1e9), st.integers(-5, 5).map(float)), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    got = order.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0])["x"]
    kept = [v for v in values if v is not None]
    if not kept:
        assert got == [None] * 5
    else:
        assert got == pytest.approx(list(np.quantile(kept, [0.0, 0.25, 0.5, 0.9, 1.0])), rel=1e-12, abs=1e-12)


def test_order_statistics_of_uneven_values(spark):
    """Powers of ten, a value held by a third of the rows, and big longs."""
    floats = [10.0 ** (i % 30) for i in range(300)] + [7.0] * 150
    longs = [2**53 + i for i in range(450)]
    df = spark.createDataFrame(list(zip(floats, longs)), "x double, n long")
    ranks = [0, 1, 149, 150, 224, 299, 449]
    got = order.order_statistics(df, {"x": ranks, "n": ranks})
    assert [got["x", k] for k in ranks] == [sorted(floats)[k] for k in ranks]
    assert [got["n", k] for k in ranks] == [longs[k] for k in ranks]


def test_a_value_is_counted_once_per_column_for_many_ranks(spark):
    """The spans of a column are told apart by a search, not by a condition for each in the plan."""
    df = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(997)) / 7).alias("x"), F.lit(None).cast("double").alias("none"))
    spans = [("x", float(i), i + 0.5) for i in range(100)]
    counted = order._bins_of_doubles(df, spans)
    assert len(counted._jdf.queryExecution().optimizedPlan().toString()) < 3000
    values = [r.x for r in df.collect()]
    got = {i: 0 for i in range(100)}
    for r in counted.collect():
        got[r.span] += r.n
        assert spans[r.span][1] <= r["first"] <= r["last"] <= spans[r.span][2]
    assert got == {i: sum(i <= v <= i + 0.5 for v in values) for i in range(100)}


def test_order_statistics_at_the_ends_of_the_range(spark):
    inf, big = float("inf"), 1.7e308
    values = [-inf, -inf, -big, -1.0, 0.0, 5e-324, 1e-323, 1.0, big, inf, inf, inf]
    longs = [-(2**63), -(2**63) + 1, -5, 0, 0, 1, 2, 2**62, 2**62 + 1, 2**63 - 3, 2**63 - 2, 2**63 - 1]
    df = spark.createDataFrame(list(zip(values, longs)), "x double, n long").repartition(4)
    got = order.order_statistics(df, {"x": range(12), "n": range(12)})
    assert [got["x", k] for k in range(12)] == values
    assert [got["n", k] for k in range(12)] == longs


def test_running_totals(spark):
    rows = [(g, i, (i * 7) % 11) for g in ("a", "b") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, x long").repartition(7)
    got = {(r.g, r.i): r.t for r in order.running_totals(df, ["i"], {"t": "x"}, within=["g"]).collect()}
    for g in ("a", "b"):
        total = 0
        for _, i, x in (r for r in rows if r[0] == g):
            total += x
            assert got[g, i] == total


def test_cutoffs_by_class(spark):
    df = spark.range(3000).withColumn("c", F.when(F.col("id") % 3 == 0, "rare").otherwise("often"))
    cuts = order.hash_cutoffs(df, digest("id"), shares=[0.0, 0.1, 1.0], by=["c"], digits=2).collect()
    found = {(r.c, r.cut): r.cutoff for r in cuts}
    for name, n in (("rare", 1000), ("often", 2000)):
        part = df.where(F.col("c") == name)
        below = [part.where(digest("id") <= found[name, i]).count() for i in range(3)]
        assert below == [0, n // 10, n]


def test_quantiles_of_many_rows_take_two_scans(spark):
    """Uneven values, one of them held by a third of the rows, nulls: read twice, and exact."""
    n = 60_000
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    u = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
    df = spark.range(0, n, 1, 6).select(
        F.exp(u * 20).alias("x"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.floor(u * 50).cast("double")).alias("y"),
        F.when(F.col("id") % 11 > 0, -u).alias("z"))
    probs = [0.0, 0.001, 0.25, 1 / 3, 0.5, 0.9, 0.99999, 1.0]
    got, row = order.quantiles_with(df.mapInArrow(count, df.schema), ["x", "y", "z"], probs, {"rows": F.count("*")})
    assert seen.value == 2 * n and row.rows == n
    whole = df.toPandas()
    for c in "xyz":
        assert got[c] == pytest.approx(list(np.nanquantile(whole[c].astype(float), probs)), rel=1e-12)


def test_quantiles_do_not_rest_on_the_sketch(spark):
    """Brackets that a bad sketch has put anywhere still give the exact values."""
    df = spark.range(500).select(F.col("id").cast("double").alias("x"))
    wanted = {("x", 0): 124.75, ("x", 1): 499.0, ("x", 2): 0.0}
    for spans in ((3.0, 9.0), (499.0, 499.0), (0.0, 0.0)), ((124.0, 124.0), (0.0, 1.0), (400.0, 402.0)), ((125.0, 125.0), (498.0, 498.0), (1.0, 2.0)):
        got = order._within(df, wanted, dict(zip(wanted, spans)))
        assert got == {("x", 0): (124.0, 125.0), ("x", 1): (499.0, 499.0), ("x", 2): (0.0, 0.0)}
