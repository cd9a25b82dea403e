"""Reading and writing the stored stages."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vocatio import fixed_values as fixed

_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
SMALL_BYTES_PER_CORE = 128 * 1024 * 1024
_NO_DATA = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_dataset(spark: SparkSession, root: str, years: list[str] | None = None) -> DataFrame:
    """A partitioned dataset; partition values stay text (``00`` is not 0)."""
    before = spark.conf.get(_INFERENCE)
    spark.conf.set(_INFERENCE, "false")
    try:
        df = spark.read.parquet(root)
    finally:
        spark.conf.set(_INFERENCE, before)
    if years is not None:
        df = df.where(F.col("year").isin([str(year) for year in years]))
    return df


def size_on_disk(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the files below paths, from their listing only."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.agg(F.sum("length")).first()[0] or 0


def read_spread(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A Parquet table whose rows use all cores even if its files do not.

    A small table often comes as one row group, which is one task. Below
    128 MB per core it is repartitioned by ``key``, which moves little data
    and pays off before expensive work per row. Larger tables have enough
    splits of their own and are not shuffled.
    """
    cores = spark.sparkContext.defaultParallelism
    table = spark.read.parquet(path)
    if size_on_disk(spark, path) > cores * SMALL_BYTES_PER_CORE:
        return table
    return table.repartition(cores, key)


def read_if_present(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return read_dataset(spark, root)
    except AnalysisException as error:
        if error.getCondition() not in _NO_DATA:
            raise
        return None


def write_dataset(
    df: DataFrame,
    root: str,
    partition_by: tuple[str, ...] = ("year",),
    rebalance: bool = True,
    max_records_per_file: int = 0,
) -> None:
    """Write Parquet partitions, replacing only the partitions present in ``df``.

    Rows are first brought together by partition value, so that a value does
    not get one small file per task. The rebalance is adaptive: a value that
    holds a large share of the rows is split over many tasks and files.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(root)
    )


def write_final(df: DataFrame, root: str, **options) -> None:
    """The final layout: one directory per year and top-level class code."""
    write_dataset(df, root, ("year", "level1_code"), **options)


def write_counts(counts: DataFrame, root: str) -> None:
    """Counts per year; a repeated run replaces its years instead of appending."""
    write_dataset(counts, root)


def write_csv(df: DataFrame, folder: str) -> None:
    """CSV export, one folder per year and one header per file.

    Quotes are doubled as on input and blanks at the ends of a cell are kept.
    """
    (
        df.write.mode("overwrite")
        .options(
            header="true",
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
        .partitionBy("year")
        .csv(folder)
    )


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and cast to its types."""
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union all, with the first frame's schema."""
    for other in others:
        first = first.unionByName(align_to_schema(other, first.schema))
    return first


def years_in(df: DataFrame) -> list[str]:
    """The distinct years: a handful of values, whatever the number of rows."""
    return sorted(row["year"] for row in df.select("year").distinct().collect())


def skip_finished_years(df: DataFrame, output_root: str) -> DataFrame:
    """Rows of the years that ``output_root`` does not hold yet.

    The finished years become a literal filter, so a partitioned input does
    not read them at all.
    """
    done = read_if_present(df.sparkSession, output_root)
    if done is None:
        return df
    return df.where(~F.col("year").isin(years_in(done)))


def compact_year(
    spark: SparkSession,
    root: str,
    year: str | int,
    output_folder: str,
    target_file_bytes: int = 512 * 1024 * 1024,
    template: str = fixed.FINAL_FILE_TEMPLATE,
) -> int | None:
    """Rewrite one year as a few large files; its row count, or None if absent.

    The number of files follows from the size on disk, so a large year is
    written by many tasks instead of passing through one. Nothing is shuffled.
    """
    stored = read_if_present(spark, root)
    if stored is None:
        return None
    rows_of_year = stored.where(F.col("year") == str(year))
    if rows_of_year.isEmpty():
        return None
    target = f"{output_folder.rstrip('/')}/{template.format(year=year)}"
    stored_bytes = size_on_disk(spark, f"{root.rstrip('/')}/year={year}")
    (
        rows_of_year.coalesce(max(1, math.ceil(stored_bytes / target_file_bytes)))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(target)
    )
    return spark.read.parquet(target).count()
