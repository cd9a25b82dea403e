# -*- coding: utf-8 -*-
"""Inputs of the registered queries, derived by Spark from the given tables.

Every view reads its tables whole. Postings are all documents and all
conversation turns; the dictionary is a set of group means over all vectors,
so its size is fixed while the work to build it grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vocatio.sources.datasets import read_spread

VECTOR_SIZE = 64
BUCKETS = 16

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
TASK_WORDS = ["the of and in", "der die und zu", "de la que los", "le des et dans"]

RULES = {
    "occ 3": ["Haanth", "tionth"],
    "occ 20": ["zz"],
    "occ 41": ["ation"],
    "occ 77": ["der", "la"],
    "occ 130": ["qx"],
    "occ 150": ["the"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, spread over the cores for work that is heavy per text."""
    return read_spread(spark, f"{sf_dir}/documents.parquet", "doc_id")


def year_of(number: Column) -> Column:
    return (F.lit(2015) + number % 10).cast("string")


def document_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.md5("text").alias("rec_id"),
        F.col("text").alias("position_responsibilities"),
        year_of(F.col("n_chars")).alias("year"),
        F.col("lang").alias("origin"),
    )


def turn_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("turn").alias("ord"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("rec_id"),
        F.col("text").alias("position_responsibilities"),
        year_of(F.col("conv_id")).alias("year"),
        F.col("role").alias("origin"),
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a document share its id; the turns of a conversation do too."""
    return document_postings(spark, sf_dir).unionByName(turn_postings(spark, sf_dir))


def headed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with section headers around their whole text, one form per language."""
    text, source = F.col("text"), F.col("source")
    headed = (
        F.when(
            F.col("lang") == "en",
            F.concat(
                F.lit("公司介绍："), source, F.lit("岗位职责："), text, F.lit("\n任职要求："), source
            ),
        )
        .when(F.col("lang") == "fr", F.concat(text, F.lit("主要工作内容: "), text))
        .when(F.col("lang") == "de", F.concat(F.lit("工作职责\n任职要求: "), text))
        .otherwise(F.concat(text, F.lit("\r\n福利待遇\t"), text))
    )
    return documents(spark, sf_dir).select("doc_id", headed.alias("raw"))


def numbered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents between item numbers of several styles."""
    text, source = F.col("text"), F.col("source")
    numbered = (
        F.when(F.col("lang") == "es", F.concat(F.lit("10. "), text))
        .when(F.col("lang") == "fr", F.concat(F.lit("1、"), text, F.lit("。2）"), source))
        .otherwise(F.concat(F.lit("1) "), text, F.lit(" 12.  "), source, F.lit("!")))
    )
    return documents(spark, sf_dir).select("doc_id", numbered.alias("raw"))


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level codes in several states of tidiness, one per part."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey") % 100
    brand = F.regexp_extract("p_brand", "[0-9]+", 0)
    code = (
        F.when(F.col("p_type") == "ECONOMY", F.concat_ws("-", size, brand, key))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit(" "), size, F.lit("\t")))
        .when(F.col("p_type") == "MEDIUM", F.concat_ws("-", size, brand, key, brand))
        .when(F.col("p_type") == "PROMO", F.concat_ws("-", size, brand, key, brand, size))
        .when(F.col("p_type") == "SMALL", F.concat_ws("-", F.lit("x"), size))
        .otherwise(F.concat_ws("-", F.col("p_partkey").cast("string"), brand))
    )
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("raw"))


def names_and_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    name = F.when(kind == "SMALL", "").otherwise(F.concat(F.lit("  "), "p_name", F.lit("\n")))
    task = F.when(kind.isin("LARGE", "SMALL"), F.lit(None).cast("string")).otherwise(
        F.concat("p_brand", F.lit(" \t "), kind)
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", name.alias("name"), task.alias("task")
    )


def level_codes(label: Column, bucket: Column) -> dict[str, Column]:
    """Untidy four-level codes of a dictionary entry."""
    parts = [label % 8 + 1, bucket % 4 + 1, label + 1, bucket + 1]
    return {
        f"Level{n}_Code": F.concat_ws("-", *[p.cast("string") for p in parts[:n]])
        for n in range(1, 5)
    }


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per (label, bucket): the mean vector of its group."""
    key = ["label", "bucket"]
    means = (
        table(spark, sf_dir, "embeddings")
        .select(
            "label",
            (F.col("vec_id") % BUCKETS).cast("int").alias("bucket"),
            F.posexplode("embedding").alias("dim", "x"),
        )
        .groupBy(*key, "dim")
        .agg(F.round(F.avg(F.col("x").cast("double")), 6).cast("float").alias("mean"))
    )
    groups = means.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("dim", "mean")))["mean"].alias("embedding")
    )
    label, bucket = F.col("label"), F.col("bucket")
    words = F.element_at(F.array(*[F.lit(w) for w in TASK_WORDS]), label % 4 + 1)
    index = label * BUCKETS + bucket
    codes = level_codes(label, bucket)
    return groups.select(
        index.alias("occ_idx"),
        F.concat(F.lit("occ "), index.cast("string")).alias("Level4_Name"),
        F.concat(words, F.lit(" "), index.cast("string")).alias("main_task"),
        *[codes[f"Level{n}_Code"].alias(f"Level{n}_Code") for n in range(1, 5)],
        F.concat(F.lit("class "), codes["Level1_Code"]).alias("Level1_Name"),
        F.concat(F.lit("group "), codes["Level2_Code"]).alias("Level2_Name"),
        F.concat(F.lit("family "), codes["Level3_Code"]).alias("Level3_Name"),
        "embedding",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as standardized postings, each with a vector."""
    vectors = table(spark, sf_dir, "embeddings")
    count = vectors.agg(F.count(F.lit(1))).scalar()
    return (
        table(spark, sf_dir, "documents")
        .select(
            "doc_id",
            year_of(F.col("n_chars")).alias("year"),
            F.col("text").alias("standardized_job_description"),
            (F.col("doc_id") % count).alias("vec_id"),
        )
        .join(vectors.select("vec_id", "embedding"), "vec_id", "left")
        .drop("vec_id")
    )


def _brand_and_type() -> tuple[Column, Column]:
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    kind = F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type")) - 1
    return brand, kind.cast("int")


def onet_code(number: Column, family: Column) -> Column:
    return F.concat(
        (F.lit(11) + family * 2).cast("string"),
        F.lit("-"),
        F.lpad((number * 37).cast("string"), 4, "0"),
        F.lit(".00"),
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (brand, type) of all parts; some codes have two partners.

    There are 25 brands of 6 types, so the table is marked for broadcast unmeasured.
    """
    brand, kind = _brand_and_type()
    grouped = (
        table(spark, sf_dir, "part")
        .groupBy(brand.alias("n"), kind.alias("t"))
        .agg(F.max("p_retailprice").alias("price"), F.min("p_name").alias("name"))
    )
    n, t = F.col("n"), F.col("t")
    entry = (n * 6 + t) % 144
    label, bucket = F.floor(entry / BUCKETS).cast("int"), entry % BUCKETS
    padded = [label % 8 + 1] + [
        F.lpad(p.cast("string"), 2, "0") for p in (bucket % 4 + 1, label + 1, bucket + 1)
    ]
    found = grouped.select(
        F.concat_ws("-", *[p.cast("string") for p in padded]).alias("dadian_code"),
        onet_code(n, t).alias("onet_code"),
        F.concat(F.col("name"), F.lit(" "), n.cast("string")).alias("onet_title"),
        F.round(F.col("price") / 2000, 6).alias("similarity_score"),
        F.when(F.col("price") > 1000, "high").otherwise("low").alias("confidence"),
    )
    return F.broadcast(found)


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions per nation that has suppliers, 25 rows at most; most codes have none."""
    suppliers = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    nations = table(spark, sf_dir, "nation")
    found = nations.join(suppliers, nations.n_nationkey == suppliers.s_nationkey).select(
        onet_code(F.col("n_nationkey") + 1, F.col("n_regionkey")).alias("O*NET-SOC Code"),
        F.col("n_name").alias("Description"),
        F.concat(F.lit("tasks "), F.col("suppliers").cast("string")).alias("All_Tasks"),
    )
    return F.broadcast(found)


def part_occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary with real texts: one entry per (type, name) of all parts."""
    _, kind = _brand_and_type()
    grouped = (
        table(spark, sf_dir, "part")
        .groupBy("p_type", "p_name", kind.alias("t"))
        .agg(F.min("p_partkey").alias("first_key"), F.max("p_brand").alias("brand"))
    )
    code = F.concat_ws(
        "-", (F.col("t") + 1).cast("string"), (F.col("first_key") % 90 + 1).cast("string")
    )
    return grouped.select(
        F.col("first_key").cast("int").alias("occ_idx"),
        F.col("p_name").alias("Level4_Name"),
        F.concat("p_type", F.lit(" "), "brand").alias("main_task"),
        (F.col("t") + 1).cast("string").alias("Level1_Code"),
        F.col("p_type").alias("Level1_Name"),
        code.alias("Level2_Code"),
        F.concat(F.lit("group "), code).alias("Level2_Name"),
        code.alias("Level3_Code"),
        F.concat(F.lit("family "), code).alias("Level3_Name"),
        F.concat_ws(
            "-",
            (F.col("t") % 6 + 1).cast("string"),
            (F.col("first_key") % 4 + 1).cast("string"),
            (F.col("t") + 1).cast("string"),
            (F.col("first_key") % 16 + 1).cast("string"),
        ).alias("Level4_Code"),
    )
