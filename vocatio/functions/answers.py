"""Model answers kept by content.

A text is asked once, whatever run, year or posting it comes from. Answers lie in a table per
model, by the hash of what was asked. Texts without an answer are found by an anti-join and
asked in batches; every batch is committed with its answers, so a run that dies repeats one
batch at most, and the next run asks only what is left.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, functions as F

from vocatio.sources.datasets import read_if_present
from vocatio.sources.folders import fresh_folder

BATCH_TEXTS = 200_000
PARTS = 256  # in which missing texts are stored; a batch takes consecutive ones
PARTS_OF_TASK = 8  # so many small files a task writes


def answered(
    df: DataFrame,
    given: Column,
    output: str,
    ask: Callable[[Column], Column],
    store: str,
    model: str,
    batch_texts: int = BATCH_TEXTS,
) -> DataFrame:
    """Add ``output``, the model's answer to ``given``; null is not asked and gives null.

    ``ask`` is the model's column expression. ``model`` names model and version: another name has
    answers of its own. One run at a time writes the answers of a model.
    """
    spark = df.sparkSession
    path = f"{store.rstrip('/')}/{quote(model, safe='')}"
    text = given if dict(df.select(given.alias("x")).dtypes)["x"] == "string" else F.to_json(given)
    keyed = df.withColumn("__given", given).withColumn("__key", F.sha2(text, 256))
    wanted = keyed.where(F.col("__given").isNotNull()).select("__key", "__given").distinct()
    known = read_if_present(spark, path)
    if known is not None:
        wanted = wanted.join(known.select("__key"), "__key", "left_anti")
    _ask(wanted, ask, path, batch_texts)
    known = read_if_present(spark, path)
    if known is None:  # nothing was ever asked
        answer = ask(F.col("__given"))
        return keyed.withColumn(output, answer).drop("__given", "__key")
    # Rows that were not asked have no key: a number of their own spreads them over the tasks.
    own = F.coalesce("__key", F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string")))
    asked = F.when(F.col("__given").isNotNull(), F.col("__key"))
    keyed = keyed.withColumn("__key", asked).withColumn("__key", own)
    found = known.select("__key", F.col("answer").alias(output))
    return keyed.join(found, "__key", "left").drop("__given", "__key")


def _ask(wanted: DataFrame, ask: Callable[[Column], Column], path: str, batch_texts: int) -> None:
    spark = wanted.sparkSession
    waiting = fresh_folder(spark, "asked")
    # Texts stay in the tasks that made them distinct; each writes a few parts of its own.
    of_task = F.pmod(F.spark_partition_id(), F.lit(PARTS // PARTS_OF_TASK)) * PARTS_OF_TASK
    part = (of_task + F.pmod(F.xxhash64("__key"), F.lit(PARTS_OF_TASK))).cast("int")
    wanted.withColumn("part", part).write.partitionBy("part").parquet(waiting)
    missing = read_if_present(spark, waiting)
    if missing is None:
        return
    counts = {int(row["part"]): row["n"] for row in missing.groupBy("part").agg(F.count("*").alias("n")).collect()}
    batches, size = [[]], 0
    for number in sorted(counts):
        if size and size + counts[number] > batch_texts:
            batches.append([])
            size = 0
        batches[-1].append(str(number))
        size += counts[number]
    run = uuid.uuid4().hex
    for number, parts in enumerate(batches):
        # The files of a batch are its tasks; nothing is shuffled to ask.
        texts = missing.where(F.col("part").isin(parts)).select("__key", "__given")
        texts.select("__key", ask(F.col("__given")).alias("answer")).write.parquet(f"{path}/run={run}/batch={number}")
