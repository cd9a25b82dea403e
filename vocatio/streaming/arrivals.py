"""Incremental arrival of postings files.

Structured Streaming remembers which files were consumed and commits each
micro-batch exactly once, so an interrupted run resumes where it stopped.
Streams run with ``availableNow``: they take what has arrived, then end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vocatio import fixed_values as fixed
from vocatio.functions import text as rules
from vocatio.operators.clean import ORDER_COLUMNS, clean_postings, first_per_id
from vocatio.sources import manifests
from vocatio.sources.datasets import read_dataset, read_if_present, write_dataset
from vocatio.sources.postings import (
    CSV_OPTIONS,
    OVERFLOW,
    check_row_lengths,
    position_columns,
    text_schema,
)


# Spark's settings of state stores: keyed files, of which only changes are written per batch.
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGE_LOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def _position_in_task(column: Column) -> Column:
    """Running row number within the task that reads a file.

    Streams do not offer ``monotonically_increasing_id``. One file is read by
    one task and in order, so this number orders the rows of a file. Only
    ``column`` is sent to Python, for its length.
    """

    @F.arrow_udf("bigint")
    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        start = 0
        for batch in batches:
            yield pa.array(range(start, start + len(batch)), pa.int64())
            start += len(batch)

    return number.asNondeterministic()(column)


def stream_postings(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    max_files_per_trigger: int = 8,
    year_from: str = "file",
    bad_rows: str = "fail",
) -> DataFrame:
    """Postings files as they arrive, with year and order columns."""
    rows = (
        spark.readStream.options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .schema(text_schema([*columns, OVERFLOW]))
        .option("recursiveFileLookup", "true")
        .csv(folder)
        .select("*", *position_columns(year_from))
    )
    checked = check_row_lengths(rows, bad_rows)
    return checked.withColumn("ord_pos", _position_in_task(F.col("ord_file")))


def start_append(
    stream: DataFrame, output: str, checkpoint: str, max_records_per_file: int = 0
) -> StreamingQuery:
    """Append a stream to a dataset partitioned by year, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("year")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records_per_file)
        .trigger(availableNow=True)
        .start(output)
    )


def run_resumable(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    stage: Callable[[DataFrame], DataFrame],
    max_files_per_trigger: int = 64,
) -> None:
    """Run a row-wise stage over a stored dataset so that it can be resumed.

    Meant for the model stages, ``standardize`` and ``match``, whose answers
    are too dear to lose. Every micro-batch of files is committed with its
    answers; a run that died continues with the first uncommitted files, and
    files added to ``source`` later are taken by the next run. ``source`` must
    only ever gain files.
    """
    schema = read_dataset(spark, source).schema
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source)
    )
    start_append(stage(stream), target, checkpoint).awaitTermination()


def start_clean(
    stream: DataFrame,
    output: str,
    checkpoint: str,
    min_effective_len: int = fixed.MIN_EFFECTIVE_LEN,
    order_by: tuple[str, ...] = ORDER_COLUMNS,
    id_column: str = fixed.ID_COLUMN,
    text_column: str = fixed.TEXT_COLUMN,
) -> StreamingQuery:
    """Clean a stream as it arrives, into folders by micro-batch and year.

    The first posting per (year, id) is kept: one of an earlier micro-batch
    before a later one, and by ``order_by`` within a micro-batch. A short first
    posting hides its later copies; null and blank ids are one group per year.
    Files that arrive in order give the rows of ``clean_postings``.

    Each micro-batch is reduced to its first postings, stored below
    ``<output>_firsts``. A second stream takes them, one micro-batch at a time,
    past a state store of the ids met so far, so that a batch looks up its own
    ids only, however many came before. A micro-batch that is repeated after a
    failure finds its first postings stored and its ids met: its rows are
    written once. The number of state partitions is that of shuffle partitions
    at the first start.
    """
    firsts, taken = f"{output.rstrip('/')}_firsts", f"{output.rstrip('/')}_taken"

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        first = first_per_id(batch, order_by, id_column).withColumn("__id", F.coalesce(F.col(id_column), F.lit("")))
        if read_if_present(session, f"{taken}/batch={number}") is None:
            first.write.mode("overwrite").parquet(f"{firsts}/batch={number}")
            session.range(1).write.mode("overwrite").parquet(f"{taken}/batch={number}")
        schema = T.StructType([*first.schema.fields, T.StructField("batch", T.IntegerType())])
        session.conf.set(STATE_PROVIDER, ROCKS_DB)
        session.conf.set(CHANGE_LOG, "true")
        known = session.readStream.schema(schema).parquet(firsts).dropDuplicates(["year", "__id"])
        long_enough = rules.has_effective_length(F.col(text_column), min_effective_len)
        kept = known.where(long_enough).drop("__id")
        (
            kept.writeStream.format("parquet").outputMode("append").partitionBy("batch", "year")
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/ids").trigger(availableNow=True)
            .start(output).awaitTermination()
        )

    return (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_years(
    spark: SparkSession, ingested: str, cleaned: str, redo: bool = False, **options
) -> list[str]:
    """Clean the years that are new or have changed, in exact file order.

    A year is cleaned as a whole and replaces its own partition only. The manifest of its ingested
    files is stored beside the result, below ``<cleaned>_ingested``: a year with the same files,
    which the result holds, is finished; one with a file more, or another in place of one, is not.
    With ``redo`` finished years are cleaned again. A run lost before the manifest is stored
    repeats its years. Returns the years treated.
    """
    stored = f"{cleaned.rstrip('/')}_ingested"
    now = manifests.of_dataset(spark, ingested)
    rows = [row["year"] for row in now.select("year").collect()]
    done = set() if redo else manifests.finished(spark, now, stored, cleaned)
    years = sorted(set(rows) - done)
    if years:
        wanted = read_dataset(spark, ingested, years)
        write_dataset(clean_postings(wanted, **options), cleaned)
        manifests.store(now, years, stored)
    return years
