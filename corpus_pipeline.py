"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from vocatio.llm import decontamination, language_id, near_duplicates, packing, secret_scan
from vocatio.llm.queries import tokenizer_path
from vocatio.llm.tables import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or like no language go.

    All rows are scored once; the least score comes from all that have a label.
    """
    net = language_id.fit(docs)
    rows = stored(language_id.scored(docs, net), "language-scores")
    return language_id.keep_scored(rows, language_id.least_score(net, rows.filter("lang IS NOT NULL")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and one row of each repeated document.

    Rows with a null doc_id stay, as no group can be named by them.
    """
    found = near_duplicates.near_duplicates(docs, percent=80).filter("doc_id IS NOT NULL")
    of_id = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    of_id = stored(of_id.filter("NOT kept OR n > 1"), "decisions")
    left = docs.join(of_id.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    repeated = of_id.filter("kept")
    if not repeated.take(1):
        return left
    again = docs.join(repeated.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    first = F.row_number().over(W.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
    again = again.withColumn("x_first", first).filter("x_first = 1").select(*docs.columns)
    return left.unionByName(again)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences whose lengths are powers of two."""
    return packing.pack(docs, tokenizer_path(), 1024, with_ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", one_of_each_group),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # a trained network and a tokenizer are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
