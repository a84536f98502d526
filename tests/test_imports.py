import shutil

import pytest
from pyspark.sql import functions as F

from tabmill.operators import imports, monitor

EDGES = {"x": [10.0, 20.0]}


@pytest.fixture(scope="module")
def rows(spark):
    x = F.when(F.col("id") % 17 == 0, None).otherwise(1e6 + F.pmod(F.xxhash64("id"), F.lit(30)))
    return spark.range(3000).select("id", x.cast("double").alias("x"),
                                    F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("c"))


def parts(rows):
    return [rows.where(f"id % 5 in ({k})") for k in ("0, 1", "2", "3, 4")]


def as_map(df):
    return {(r.feature, r.kind): r.distance for r in df.collect()}


def test_imports_equal_a_comparison_of_their_rows(spark, rows, tmp_path):
    one, two, three = parts(rows)
    for against, before in (("latest", two), ("state", one.unionByName(two))):
        store = str(tmp_path / against)
        assert imports.record(one, store, "a", EDGES, ["c"], against).count() == 0
        imports.record(two, store, "b", EDGES, ["c"], against)
        got = as_map(imports.record(three, store, "c", EDGES, ["c"], against))
        assert got == pytest.approx(as_map(monitor.skew(before, three, EDGES, ["c"])))


def test_merged_moments_are_those_of_all_rows(spark, rows, tmp_path):
    store = str(tmp_path / "s")
    for name, part in zip("abc", parts(rows)):
        imports.record(part, store, name, EDGES, ["c"])
    got = imports.moments(imports.state(spark, store)).first()
    want = rows.agg(F.count("x"), F.count("*") - F.count("x"), F.min("x"), F.max("x"), F.avg("x"), F.stddev_samp("x")).first()
    assert tuple(got)[1:5] == tuple(want)[:4]
    assert tuple(got)[5:] == pytest.approx(tuple(want)[4:], rel=1e-9)
    own = {(r.feature, r.bin): r.n for r in imports.state(spark, store).collect()}
    assert own == {(r.feature, r.bin): r.n for r in imports.statistics(rows, EDGES, ["c"]).collect()}


def test_an_import_counts_once_and_old_rows_are_not_read(spark, rows, tmp_path):
    one, two, _ = parts(rows)
    folder, store = str(tmp_path / "rows"), str(tmp_path / "s")
    one.write.parquet(folder)
    imports.record(spark.read.parquet(folder), store, "a", EDGES, ["c"])
    shutil.rmtree(folder)  # the rows of the first import are gone
    first = as_map(imports.record(two, store, "b", EDGES, ["c"]))
    assert as_map(imports.record(two, store, "b", EDGES, ["c"])) == first
    assert imports.commits(spark, store).count() == 2
    assert imports.state(spark, store).where("feature = 'x'").agg(F.sum("n")).first()[0] == one.count() + two.count()


def test_an_import_that_broke_off_is_written_again(spark, rows, tmp_path):
    one, two, three = parts(rows)
    store = str(tmp_path / "s")
    imports.record(one, store, "a", EDGES)
    imports.statistics(three, EDGES).write.parquet(f"{store}/bins/version=1")  # no commit follows
    assert imports.commits(spark, store).count() == 1
    imports.record(two, store, "b", EDGES)
    assert imports.state(spark, store).agg(F.sum("n")).first()[0] == one.count() + two.count()


def test_empty_imports_and_an_empty_store(spark, rows, tmp_path):
    store = str(tmp_path / "s")
    assert imports.state(spark, store).count() == 0 and imports.moments(imports.state(spark, store)).count() == 0
    imports.record(rows, store, "a", EDGES, ["c"])
    gone = as_map(imports.record(rows.limit(0), store, "b", EDGES, ["c"]))
    assert gone == {("x", "number"): 1.0, ("c", "category"): 1.0}
    assert as_map(imports.record(rows, store, "c", EDGES, ["c"], against="state")) == {("x", "number"): 0.0, ("c", "category"): 0.0}
    with pytest.raises(ValueError):
        imports.record(rows, store, "d", EDGES, against="other")
