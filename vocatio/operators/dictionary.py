"""The occupation dictionary: codes, texts, vectors and their cache."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import models, text as rules


def prepare_dictionary(
    raw: DataFrame,
    name_column: str = fixed.OCCUPATION_NAME_COLUMN,
    task_column: str = fixed.OCCUPATION_TASK_COLUMN,
) -> DataFrame:
    """Normalize the level codes and add ``occupation_text``."""
    codes = {
        name: rules.normalize_level_code(F.col(name))
        for name in fixed.LEVEL_CODE_COLUMNS
        if name in raw.columns
    }
    return raw.withColumns(codes).withColumn(
        "occupation_text", rules.occupation_text(F.col(name_column), F.col(task_column))
    )


def with_keywords(
    dictionary: DataFrame,
    occupations: dict[str, list[str]] = fixed.SUSPICIOUS_OCCUPATIONS,
    name_column: str = fixed.OCCUPATION_NAME_COLUMN,
) -> DataFrame:
    """Attach the keyword list of every occupation that has a rule.

    The rules are a parameter of a few entries, so they become one literal map
    of the plan; occupations without a rule get null.
    """
    rules_map = F.from_json(F.lit(json.dumps(occupations)), "map<string,array<string>>")
    return dictionary.withColumn("rule_keywords", F.try_element_at(rules_map, F.col(name_column)))


def fingerprint(dictionary: DataFrame, model_name: str) -> str:
    """Identifies model, row count and content, whatever the row order."""
    content = F.xxhash64("occ_idx", "occupation_text")
    found = dictionary.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(content), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.shiftright(content, 20).cast("decimal(38,0)")), F.lit(0)).alias("s"),
    ).select(F.sha2(F.concat_ws("|", F.lit(model_name), "n", "x", "s"), 256).alias("key"))
    return found.first()["key"]


def embedded_dictionary(
    dictionary: DataFrame, factory: Callable[[], models.Embed]
) -> DataFrame:
    return dictionary.withColumn(
        "embedding", models.embedded(F.col("occupation_text"), factory)
    )


def cached_dictionary(
    dictionary: DataFrame,
    factory: Callable[[], models.Embed],
    cache_path: str,
    model_name: str,
) -> DataFrame:
    """Dictionary with vectors, computed once per model and embedded text.

    Only index and vector are stored, in a Parquet table named by the
    fingerprint; all other columns come from the given dictionary, so corrected
    codes are seen at once. A table exists only after its write was committed,
    so a lost job leaves nothing to trust.
    """
    spark = dictionary.sparkSession
    path = f"{cache_path.rstrip('/')}/{fingerprint(dictionary, model_name)}"
    try:
        vectors = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        made = embedded_dictionary(dictionary, factory).select("occ_idx", "embedding")
        made.write.mode("overwrite").parquet(path)
        vectors = spark.read.parquet(path)
    return dictionary.join(vectors, "occ_idx").select(*dictionary.columns, "embedding")
