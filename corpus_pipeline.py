"""A training corpus from raw documents: languages, near duplicates, benchmark leaks, source weights, token files.

Each stage is a function of (spark, docs, sf_dir); what it returns is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabmill.llm import langid, leaks, mixing, setjoin, tokenfile
from tabmill.llm.common import batched, table
from tabmill.llm.queries import tokenizer_spec
from tabmill.session import cut


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one learned language makes up half or more."""
    return langid.accepted(batched(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return setjoin.one_of_each(batched(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return leaks.without_leaks(batched(docs), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in a compressed file, and what reading it back gives for each document."""
    return tokenfile.encoded_documents(batched(docs), tokenizer_spec())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("tokens", tokens)]

ORACLE_SQL = None  # learned languages and drawn blocks are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
