"""Reports over the final dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vocatio.functions.vectors import SCORE_DIGITS


def of_year(final: DataFrame, year: str) -> DataFrame:
    """Rows of one year; a partition filter on the stored dataset."""
    return final.where(F.col("year") == str(year))


def count_by_level1(final: DataFrame) -> DataFrame:
    """Postings per year and top-level class, largest class first."""
    counted = final.groupBy("year", "level1").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.orderBy("year", F.col("cnt").desc(), "level1")


def occupation_trend(final: DataFrame, code_prefix: str) -> DataFrame:
    """Postings per year and international title, for one code family."""
    family = final.where(F.startswith(F.col("onet_code"), F.lit(code_prefix)))
    counted = family.groupBy("year", "onet_title").agg(F.count(F.lit(1)).alias("cnt"))
    return counted.orderBy("year", F.col("cnt").desc(), "onet_title")


def match_quality(final: DataFrame) -> DataFrame:
    """Rows and mean similarity per year and match outcome.

    Scores have six decimals and are summed as such, so the mean does not
    depend on the order in which partial sums meet.
    """
    exact_sum = F.sum(F.col("embed_score").cast(f"decimal(18,{SCORE_DIGITS})"))
    return (
        final.groupBy("year", "is_match")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            (exact_sum.cast("double") / F.count("embed_score")).alias("avg_score"),
        )
        .orderBy("year", "is_match")
    )


def spot_check(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """A few rows to look at; which ones is left to Spark."""
    return df.select(*columns).limit(n)


def review_sample(df: DataFrame, key: str, n: int = 20, seed: str = "") -> DataFrame:
    """n rows drawn by a hash of their key: random, yet the same on every run."""
    drawn = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.orderBy(drawn, key).limit(n)


def first_rows(df: DataFrame, order_by: tuple[str, ...], n: int) -> DataFrame:
    """The first n rows in an explicit order, for smoke runs."""
    return df.orderBy(*order_by).limit(n)
