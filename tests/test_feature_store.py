from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from tabmill.operators import feature_store as store

START = datetime(2024, 1, 1)
HISTORY = "entity_id string, feature_time timestamp, ingest_id long, a double, b string"


def at(hours: float) -> datetime:
    return START + timedelta(hours=hours)


def by_hand(reads, history):
    """Newest row at or before the read, whole rows, highest ingest id on a tie."""
    out = {}
    for i, entity, when in reads:
        past = [h for h in history if h[0] == entity and h[1] <= when]
        best = max(past, key=lambda h: (h[1], h[2]), default=None)
        out[i] = (best[3], best[4]) if best else (None, None)
    return out


def answers(df):
    return {r["i"]: (r["a"], r["b"]) for r in df.collect()}


def as_of_by_range(reads, history, entity, when):
    """The same answer by a range join, for small data and distinct reads."""
    features = [c for c in history.columns if c not in ("entity_id", "feature_time", "ingest_id")]
    r, h = reads.alias("r"), history.alias("h")
    hit = (F.col(f"r.{entity}") == F.col("h.entity_id")) & (F.col("h.feature_time") <= F.col(f"r.{when}"))
    packed = F.struct(*[F.col(f"h.{f}").alias(f) for f in ["feature_time", *features]])
    return (r.join(h, hit, "left").groupBy(*[F.col(f"r.{c}") for c in reads.columns])
            .agg(F.max_by(packed, F.struct("h.feature_time", "h.ingest_id")).alias("f"))
            .select(*reads.columns, "f.*"))


@pytest.mark.parametrize("rows_per_slice", [1, 2, 4, 10**6])
def test_as_of_ties_nulls_and_unknown_entities(spark, rows_per_slice):
    history = [("x", at(1), 1, 1.0, "p"), ("x", at(1), 2, None, "q"), ("x", at(50), 3, 3.0, None),
               ("y", at(0), 4, 4.0, "r")]
    reads = [(0, "x", at(0.5)), (1, "x", at(1)), (2, "x", at(49)), (3, "x", at(50)), (4, "x", at(5000)),
             (5, "y", at(0)), (6, "z", at(9)), (7, "x", at(1))]
    r = spark.createDataFrame(reads, "i int, who string, at timestamp")
    h = spark.createDataFrame(history, HISTORY)
    got = answers(store.as_of(r, h, "who", "at", rows_per_slice=rows_per_slice))
    assert got == by_hand(reads, history)
    assert answers(as_of_by_range(r, h, "who", "at")) == got


@pytest.mark.parametrize("rows_per_slice", [30, 400, 10**6])
def test_as_of_with_a_hot_entity(spark, rows_per_slice):
    """One entity holds most rows; long gaps, equal times, reads of all kinds."""
    history, reads = [], []
    for i in range(1200):
        who = "hot" if i % 3 else f"e{i % 7}"
        history.append((who, at((i * 37) % 900 / 2), i, float(i), f"v{i % 5}" if i % 4 else None))
        reads.append((i, who if i % 11 else "nobody", at((i * 53) % 1000 / 2 - 10)))
    r = spark.createDataFrame(reads, "i int, who string, at timestamp").repartition(5)
    h = spark.createDataFrame(history, HISTORY).repartition(3)
    assert answers(store.as_of(r, h, "who", "at", rows_per_slice=rows_per_slice)) == by_hand(reads, history)


def test_as_of_with_a_burst_and_null_keys(spark, monkeypatch):
    """One old row, then thousands of one entity within seconds, many at the same time: ranges stay small."""
    history = [("hot", at(0), 0, 0.0, "old")] + [("hot", at(9000 + (i % 50) / 3600), i, float(i), None) for i in range(1, 6000)]
    reads = [(i, "hot" if i % 5 else None, at(8999.9 + (i % 80) / 3600) if i % 7 else None) for i in range(4000)]
    r = spark.createDataFrame(reads, "i int, who string, at timestamp").repartition(5)
    h = spark.createDataFrame(history, HISTORY).repartition(3)
    largest = []
    whole = store._equal_ranges

    def watched(*args):
        out = whole(*args)
        largest.append(max(row["count"] for row in out.groupBy("_range").count().collect()))
        return out

    monkeypatch.setattr(store, "_equal_ranges", watched)
    got = answers(store.as_of(r, h, "who", "at", rows_per_slice=200))
    last = {}
    for e in sorted(history, key=lambda e: (e[1], e[2])):
        last[e[1]] = (e[3], e[4])
    times = sorted(last)
    for i, who, when in reads:
        past = [t for t in times if when is not None and who and t <= when]
        assert got[i] == (last[past[-1]] if past else (None, None))
    assert largest and largest[0] <= 400


def test_feature_subset_and_star(spark):
    h = spark.createDataFrame([("x", at(1), 1, 1.0, "p")], HISTORY)
    r = spark.createDataFrame([(0, "x", at(2))], "i int, who string, at timestamp")
    assert store.as_of(r, h, "who", "at", ["b"]).columns == ["i", "who", "at", "feature_time", "b"]
    assert store.as_of(r, h, "who", "at", ["*"]).columns == ["i", "who", "at", "feature_time", "a", "b"]


def test_latest_and_last_write(spark):
    rows = [("x", at(1), 1, 1.0, "p"), ("x", at(2), 2, 2.0, "q"), ("x", at(2), 3, None, "r"), ("y", at(0), 4, 4.0, "s")]
    h = spark.createDataFrame(rows, HISTORY)
    got = {r.entity_id: (r.a, r.b) for r in store.latest(h).collect()}
    assert got == {"x": (None, "r"), "y": (4.0, "s")}
    only = store.latest(h, ["b"], spark.createDataFrame([("y",), ("none",)], "id string")).collect()
    assert [(r.entity_id, r.b) for r in only] == [("y", "s")]
    assert store.last_write(h).count() == 3


def test_conform(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("x", T.DoubleType())])
    rows = [("1", "2.5"), ("2", None), ("3", "many"), (None, "1"), ("no", "bad")]
    fits, rest = store.conform(spark.createDataFrame(rows, "id string, x string"), schema)
    assert sorted((r.id, r.x) for r in fits.collect()) == [(1, 2.5), (2, None)]
    assert sorted(tuple(r.faults) for r in rest.collect()) == [("id",), ("id", "x"), ("x",)]


@pytest.mark.parametrize("staleness", [0, 2, 30])
def test_daily_snapshots(spark, staleness):
    rows = [(f"e{i % 9}", at((i * i * 31) % 1500), i, float(i % 13), "t") for i in range(120)]
    h = spark.createDataFrame(rows, HISTORY)
    out = store.daily_snapshots(h, {"total": F.col("a")}, staleness_days=staleness)
    got = {r.day: (r.entities, r.total) for r in out.collect()}
    days = sorted({r[1].date() for r in rows})
    day, want = days[0], {}
    while day <= days[-1]:
        newest = {}
        for r in rows:
            if r[1].date() <= day and (r[0] not in newest or (r[1], r[2]) > newest[r[0]][1:3]):
                newest[r[0]] = r
        fresh = [r for r in newest.values() if (day - r[1].date()).days <= staleness]
        if fresh:
            want[day] = (len(fresh), int(sum(r[3] for r in fresh)))
        day += timedelta(days=1)
    assert got == want


def test_reads_go_to_a_new_table_only(spark):
    h = spark.createDataFrame([("x", at(1), 1, 1.0, "p")], HISTORY)
    spark.sql("drop table if exists reads_once")
    store.write_reads(h, "reads_once")
    with pytest.raises(Exception):
        store.write_reads(h, "reads_once")
    spark.sql("drop table reads_once")


def test_ingest_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("nameOrig,amount,oldbalanceOrg\nC1,9.5,100\nC2,0.5,7\n")
    source = spark.read.schema("nameOrig string, amount string, oldbalanceOrg string").option("header", True).csv(
        str(tmp_path / "a.csv"))
    h = store.ingest(source, "nameOrig", {"amount": ("amount", "double"), "oldbalance_orig": ("oldbalanceOrg", "double")}, START)
    assert sorted(map(tuple, h.collect())) == [("C1", START, 0, 9.5, 100.0), ("C2", START, 0, 0.5, 7.0)]


def test_ingest_of_a_million_rows(spark):
    source = spark.range(1_000_000).select("id", F.col("id").cast("string").alias("old"), F.lit(2).alias("Dest"))
    h = store.ingest(source, "id", {"old_balance": ("old", "double"), "dest": ("Dest", "double")}, START)
    assert h.agg(F.sum("old_balance")).first()[0] == 999_999 * 500_000
    assert "Exchange" not in h._jdf.queryExecution().executedPlan().toString()
