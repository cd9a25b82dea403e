"""Token counts by source, language and tokenizer version, maintained by deltas.

A batch holds signed changes: an insert adds a document's counts, a delete takes
them back, a revision takes back the counts of the old version and adds those of
the new one. Each batch is reduced to one additive row per group and written to
the folder of its batch id, replacing what an earlier attempt left there. Totals
are the sum over all batches, so committing a batch twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

GROUP = ["source", "lang", "tokenizer"]
ADDED = ["docs", "tokens", "chars"]

# Tokenizer versions: words between blanks, and words with marks as tokens of their own.
VERSIONS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"[^\x20\x09-\x0D.,;:!?]+|[.,;:!?]",
}


def counted(text: Column, version: str) -> Column:
    """Tokens of a text under a version; none for a null or empty text."""
    text = F.coalesce(text, F.lit(""))
    return F.size(F.regexp_extract_all(text, F.lit(VERSIONS[version]), F.lit(0))).cast("long")


def changes(docs: DataFrame, version: str, sign: int) -> DataFrame:
    """Signed counts of each row of ``docs`` under a tokenizer version.

    Null source or lang is a group of its own; a null text counts as one document
    without tokens. Each repeated row counts. Other columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", F.col("source"), F.col("lang"), F.lit(version).alias("tokenizer"),
        F.lit(sign).cast("long").alias("docs"),
        (sign * counted(text, version)).alias("tokens"),
        (sign * F.char_length(text).cast("long")).alias("chars"),
    )


def inserted(docs: DataFrame, version: str) -> DataFrame:
    return changes(docs, version, 1)


def deleted(docs: DataFrame, version: str) -> DataFrame:
    return changes(docs, version, -1)


def revised(docs: DataFrame, old: str, new: str) -> DataFrame:
    """One row per document and version: the old counts taken back, the new ones added."""
    both = F.explode(F.array(F.lit(-1), F.lit(1))).alias("sign")
    text = F.coalesce(F.col("text"), F.lit(""))
    sign = F.col("sign").cast("long")
    tokens = F.when(F.col("sign") < 0, counted(F.col("text"), old)).otherwise(counted(F.col("text"), new))
    return docs.select("doc_id", "source", "lang", text.alias("text"), both).select(
        "doc_id", "source", "lang",
        F.when(F.col("sign") < 0, F.lit(old)).otherwise(F.lit(new)).alias("tokenizer"),
        sign.alias("docs"), (sign * tokens).alias("tokens"),
        (sign * F.char_length("text").cast("long")).alias("chars"),
    )


def _summed(frame: DataFrame) -> DataFrame:
    return frame.groupBy(*GROUP).agg(*(F.sum(name).alias(name) for name in ADDED))


def commit(delta: DataFrame, store: str, batch_id: int) -> None:
    """Write the batch's sums; the same batch id replaces its earlier commit.

    Spark's committer publishes the files of a finished job only, so a lost
    executor repeats tasks without counting anything twice.
    """
    _summed(delta).coalesce(1).write.mode("overwrite").parquet(f"{store}/batch={int(batch_id)}")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Current totals; groups without a document left are gone."""
    return _summed(spark.read.parquet(store).drop("batch")).filter("docs <> 0 OR tokens <> 0 OR chars <> 0")


def fold(spark: SparkSession, store: str, into: str) -> None:
    """All batches of a store as batch 0 of another one, to keep the number of folders small."""
    commit(spark.read.parquet(store).drop("batch"), into, 0)
