"""Row counts and their reconciliation between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


def reconcile(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Rows per year of two stages side by side.

    A year that one side does not have yet is ignored, as there is nothing to
    compare. The last stage may fan out; that shows as ``differs`` as well.
    """
    both = (
        row_counts(previous)
        .withColumnRenamed("rows", "prev_rows")
        .join(row_counts(current).withColumnRenamed("rows", "curr_rows"), "year")
    )
    gap = F.col("curr_rows") - F.col("prev_rows")
    return both.select(
        "year",
        "prev_rows",
        "curr_rows",
        F.abs(gap).alias("difference"),
        F.when(gap == 0, F.lit("equal")).otherwise(F.lit("differs")).alias("status"),
    )
