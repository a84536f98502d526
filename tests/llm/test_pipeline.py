"""The pipeline and the registered queries at the smallest size."""

import corpus_pipeline
from tabmill.llm import setjoin
from tabmill.llm.queries import ORACLES, QUERIES
from tabmill.plans.check import oracle, rows

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


def test_oracles_agree(spark):
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SF)
        result = oracle(SF).execute(sql)
        columns = [d[0] for d in result.description]
        assert rows(df.columns, map(tuple, df.collect())) == rows(columns, result.fetchall())


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        kept = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count() > 0


def test_components_are_compared_a_share_of_the_keys_at_a_time(spark, monkeypatch):
    rows = []
    for family in range(3):
        base = [f"w{family}x{i}" for i in range(120)]
        for copy in range(6):  # neighbours are alike, the ends of a family are not
            rows.append((family * 10 + copy, " ".join([f"new{family}y{i}" for i in range(copy * 5)] + base[copy * 5:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    given, compare = [], setjoin.apart_pairs

    def watched(members, own, limit):
        given.append({r["key"] for r in members.select("key").distinct().collect()})
        return compare(members, own, limit)

    monkeypatch.setattr(setjoin, "apart_pairs", watched)
    found = {r["doc_id"]: r["root"] for r in setjoin.rooted(docs, 5, (4, 5)).collect()}
    assert len(given) == setjoin.SHARES and sum(map(len, given)) == len(set().union(*given))
    monkeypatch.setattr(setjoin, "SHARES", 1)
    assert found == {r["doc_id"]: r["root"] for r in setjoin.rooted(docs, 5, (4, 5)).collect()}
    assert len(set(found.values())) == 3
