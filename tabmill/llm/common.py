"""What the text operators share: reading, words, Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = r"[^\x20\x09-\x0D]+"  # what lies between ASCII white space; bytes.split() cuts the same way
TEXTS = 512  # rows with texts that are Python objects at a time
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z only


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; from here on the session's Python workers find this package too."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, ``text`` and named columns only, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *[F.col(c) for c in extra])


def quoted(name: str) -> str:
    """A column's name as it is meant, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def text_key() -> Column:
    """64-bit hash of a row's text: names the text where ids are null or stand for several texts."""
    return F.xxhash64(F.col("text").cast("string"))


def per_text(docs: DataFrame, fn: Callable, schema: str, *extra: str) -> DataFrame:
    """Rows of ``fn(doc_id, text, *extra)``, a tuple in the order of ``schema``, for each document."""
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [arrow_type(part.split()[1]) for part in schema.split(", ")]
    out = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                rows = [fn(*row) for row in zip(*[c.to_pylist() for c in some.columns])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], schema=out)

    return texts(docs, *extra).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = TEXTS) -> Iterator[pa.RecordBatch]:
    """A batch in smaller ones, so that only some texts are Python objects at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def batched(docs: DataFrame) -> DataFrame:
    """The same documents; from here on the session's Python workers get ``TEXTS`` rows at a time, as both sides hold a batch whole."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXTS:
        conf.set(name, str(TEXTS))
    return docs


def arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[name]
