import math

import pytest
from pyspark.sql import functions as F

from tabmill.operators import split


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(10_000).withColumn("label", (F.col("id") % 50 == 0).cast("int")).withColumn(
        "day", F.timestamp_seconds(F.col("id") % 977 * 3600))


RULES = {
    "head_tail": lambda df: split.head_tail(df, ["id"]),
    "take_skip": lambda df: split.take_skip(df, ["id"], 9000),
    "holdout": lambda df: split.holdout(df, ["id"]),
    "stratified": lambda df: split.stratified(df, "label", ["id"]),
    "fractions": lambda df: split.fractions(df, ["id"]),
    "fast": lambda df: split.fractions(df, ["id"], fast=True),
    "chronological": lambda df: split.chronological(df, "day"),
    "content": lambda df: split.content_split(df, ["id", "label"]),
}


@pytest.mark.parametrize("rule", sorted(RULES))
def test_same_parts_on_any_partitioning(frame, rule):
    seen = set()
    for n in (1, 8, 200):
        marked = RULES[rule](frame.repartition(n))
        assert marked.count() == 10_000
        seen.add(marked.agg(F.sum(F.xxhash64("id", "split").cast("decimal(38,0)"))).first()[0])
    assert len(seen) == 1


def sizes(df):
    return {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}


def test_exact_sizes(frame):
    assert sizes(split.head_tail(frame, ["id"])) == {"train": 8000, "test": 2000}
    assert sizes(split.take_skip(frame, ["id"], 9000)) == {"train": 5760, "validate": 1440, "test": 2800}
    assert sizes(split.holdout(frame, ["id"], 1000)) == {"validate": 1000, "train": 9000}
    assert sizes(split.holdout(frame, ["id"], 20_000)) == {"validate": 10_000}
    rare = split.stratified(frame, "label", ["id"]).where("label = 1")
    assert sizes(rare) == {"train": 160, "validate": 20, "test": 20}


def test_a_null_class_is_a_class(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") % 2 == 0, "even"))
    assert sizes(split.stratified(df, "c", ["id"]).where("c is null")) == {"train": 400, "validate": 50, "test": 50}


@pytest.mark.parametrize("fast", [False, True])
def test_fraction_within_binomial_bounds(frame, fast):
    n = sizes(split.fractions(frame, ["id"], (0.8, 0.2), ("a", "b"), fast=fast))["a"]
    assert abs(n - 8000) < 5 * math.sqrt(10_000 * 0.8 * 0.2)


@pytest.mark.parametrize("fast", [False, True])
def test_sample_and_complement_are_disjoint_and_whole(frame, fast):
    for whole in (0.0, 1.0):
        assert split.sample(frame, whole, ["id"], fast=fast).count() == whole * 10_000
    a, b = split.sample(frame, 0.3, ["id"], fast=fast), split.complement(frame, 0.3, ["id"], fast=fast)
    assert a.join(b, "id", "left_semi").count() == 0
    assert a.count() + b.count() == 10_000


def test_undersample_keeps_the_minority(frame):
    kept = split.undersample(frame, "label", 1, 0.005, ["id"])
    assert kept.where("label = 1").count() == 200
    assert kept.where("label = 0").count() < 100


def test_chronological_keeps_times_together_and_in_order(frame):
    marked = split.chronological(frame, "day")
    ends = {r["split"]: (r["lo"], r["hi"]) for r in marked.groupBy("split").agg(
        F.min("day").alias("lo"), F.max("day").alias("hi")).collect()}
    assert ends["train"][1] < ends["validate"][0] and ends["validate"][1] < ends["test"][0]


def test_one_time_for_all_rows(spark):
    df = spark.range(100).withColumn("day", F.lit("2024-01-01").cast("timestamp"))
    assert sizes(split.chronological(df, "day")) == {"train": 100}


def test_equal_rows_share_a_part(spark):
    df = spark.range(2000).select((F.col("id") % 40).alias("a"), (F.col("id") % 2 + 0.5).alias("b"))
    per_row = split.content_split(df).groupBy("a", "b").agg(F.count_distinct("split").alias("n"))
    assert per_row.where("n > 1").count() == 0


@pytest.mark.parametrize("fast", [False, True])
def test_folds_cover_every_row_once(frame, fast):
    counts = {r["fold"]: r["count"] for r in split.folds(frame, 3, ["id"], fast=fast).groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 10_000


def test_written_parts(spark, frame, tmp_path):
    path = str(tmp_path / "parts")
    split.write_splits(split.head_tail(frame, ["id"]), path)
    back = spark.read.parquet(path).where("split = 'test'")
    assert back.count() == 2000
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception):
        split.write_splits(frame.withColumn("split", F.lit("x")), path)
