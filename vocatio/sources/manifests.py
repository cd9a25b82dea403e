"""What the files of a year were when they were treated: the basis of "finished".

A manifest has one row per year with the number and bytes of its files and a mark of their
names, sizes and times, taken from their listing. It is stored beside a result; a year is
finished as long as its files have the mark that was stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vocatio.functions import text as rules
from vocatio.sources.datasets import read_if_present, write_counts, years_in


def _manifest(listed: DataFrame) -> DataFrame:
    """Rows (year, path, length, modificationTime) by year; the mark does not depend on their order.

    The result is what was listed now: one row per year, held by the driver.
    """
    content = F.xxhash64("path", "length", "modificationTime")
    mark = F.concat_ws(
        "-", F.count(F.lit(1)), F.bit_xor(content), F.sum(F.shiftright(content, 20).cast("decimal(38,0)"))
    )
    rows = listed.groupBy("year").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), mark.alias("mark")
    )
    return listed.sparkSession.createDataFrame(rows.collect(), rows.schema)


def _listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select("path", "length", "modificationTime")


def of_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The manifest of files whose names tell their year."""
    name = F.element_at(F.split("path", "/"), -1)
    return _manifest(_listed(spark, paths).withColumn("year", rules.year_from_name(name)))


def of_dataset(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of a dataset in folders by year."""
    year = F.regexp_extract("path", "/year=([^/]+)/", 1)
    return _manifest(_listed(spark, root).withColumn("year", year).where("year <> ''"))


def finished(spark: SparkSession, now: DataFrame, stored: str, result: str) -> set[str]:
    """The years that the result holds and whose files are those of the stored manifest."""
    before, done = read_if_present(spark, stored), read_if_present(spark, result)
    if before is None or done is None:
        return set()
    marks = {row["year"]: row["mark"] for row in before.select("year", "mark").collect()}
    same = {row["year"] for row in now.collect() if marks.get(row["year"]) == row["mark"]}
    return same & set(years_in(done))


def store(now: DataFrame, years: list[str], path: str) -> None:
    """Keep the manifest of treated years; call it last, so that a lost run repeats them."""
    write_counts(now.where(F.col("year").isin(years)), path)
