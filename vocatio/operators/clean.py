"""Cleaning: keep the first posting per id and year, drop short texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import text as rules

ORDER_COLUMNS = ("ord_file", "ord_block", "ord_pos")


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def first_per_id(
    postings: DataFrame,
    order_by: tuple[str, ...] = ORDER_COLUMNS,
    id_column: str = fixed.ID_COLUMN,
) -> DataFrame:
    """The first posting per (year, id). Null and blank ids are one group.

    The filter on the row number makes Spark keep one row per group inside
    each map task, before the shuffle. An id that holds a third of all rows
    reaches its reducer as one row per map task.
    """
    require_columns(postings, ["year", id_column, *order_by])
    key = F.coalesce(F.col(id_column), F.lit(""))
    window = Window.partitionBy("year", key).orderBy(*order_by)
    return (
        postings.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")
    )


def clean_postings(
    postings: DataFrame,
    min_effective_len: int = fixed.MIN_EFFECTIVE_LEN,
    order_by: tuple[str, ...] = ORDER_COLUMNS,
    id_column: str = fixed.ID_COLUMN,
    text_column: str = fixed.TEXT_COLUMN,
) -> DataFrame:
    """Deduplicate, then filter: a short first posting hides its later copies."""
    require_columns(postings, [text_column])
    long_enough = rules.has_effective_length(F.col(text_column), min_effective_len)
    return first_per_id(postings, order_by, id_column).where(long_enough)


def clean_counts(
    postings: DataFrame,
    min_effective_len: int = fixed.MIN_EFFECTIVE_LEN,
    order_by: tuple[str, ...] = ORDER_COLUMNS,
    id_column: str = fixed.ID_COLUMN,
    text_column: str = fixed.TEXT_COLUMN,
) -> DataFrame:
    """Per year: total, kept, and why the others were dropped.

    The text is judged where it is read, so only (year, id, order, flag) is
    shuffled, pre-aggregated per id on the map side.
    """
    require_columns(postings, ["year", id_column, text_column, *order_by])
    judged = postings.select(
        "year",
        F.coalesce(F.col(id_column), F.lit("")).alias("id"),
        (F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)).alias("ord"),
        rules.has_effective_length(F.col(text_column), min_effective_len).alias("ok"),
    )
    per_id = judged.groupBy("year", "id").agg(
        F.count(F.lit(1)).alias("copies"), F.min_by("ok", "ord").alias("ok")
    )
    counts = per_id.groupBy("year").agg(
        F.sum("copies").alias("total"),
        F.count_if("ok").alias("kept"),
        F.count_if(~F.col("ok")).alias("dropped_short"),
        F.sum(F.col("copies") - 1).alias("dropped_dup"),
    )
    return counts.select(
        "year",
        (F.col("dropped_dup") + F.col("dropped_short")).alias("dropped_total"),
        "kept",
        "dropped_dup",
        "dropped_short",
        "total",
    )
