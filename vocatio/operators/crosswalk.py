"""Crosswalk from the matched occupation code to an international code set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vocatio import fixed_values as fixed
from vocatio.operators.sizing import is_marked, left_join

CODE_COLUMN = "match_Level4_Code"


def best_mapping(mapping: DataFrame) -> DataFrame:
    """One partner per code: the most similar, then the smallest code."""
    window = Window.partitionBy("dadian_code").orderBy(
        F.col("similarity_score").desc_nulls_last(), "onet_code"
    )
    return mapping.withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")


def _or_default(column: str, default: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


def add_crosswalk(
    matched: DataFrame,
    mapping: DataFrame,
    detail: DataFrame | None = None,
    code_column: str = CODE_COLUMN,
    best_only: bool = False,
    unmatched_label: str = fixed.UNMATCHED_LABEL,
    no_code: str = fixed.NO_LEVEL1_CODE,
) -> DataFrame:
    """Left-join the crosswalk, and its details when they are given.

    A code with several partners gives several rows unless ``best_only``.
    Postings without a partner stay, with null ``onet_*`` columns. Both
    right sides are joined to each other first: they are dimensions, so the
    postings take part in a single join.
    """
    partners = best_mapping(mapping) if best_only else mapping
    added = {
        "onet_code": "onet_code",
        "onet_title": "onet_title",
        "onet_similarity_score": "similarity_score",
        "onet_confidence": "confidence",
    }
    if detail is not None:
        described = detail.select(
            F.col("`O*NET-SOC Code`").alias("__soc"),
            F.col("Description").alias("onet_description"),
            F.col("All_Tasks").alias("onet_tasks"),
        )
        small = is_marked(mapping) and is_marked(detail)
        partners = left_join(partners, described, ("onet_code", "__soc"))
        added |= {"onet_description": "onet_description", "onet_tasks": "onet_tasks"}
    lookup = partners.select(
        F.col("dadian_code").alias("__dadian_code"),
        *[F.col(source).alias(target) for target, source in added.items()],
    )
    if detail is not None and small:
        lookup = F.broadcast(lookup)  # a join does not keep the marks of its sides
    labelled = matched.withColumns(
        {
            "level1": _or_default("match_Level1_Name", unmatched_label),
            "level1_code": _or_default("match_Level1_Code", no_code),
        }
    )
    return left_join(labelled, lookup, (code_column, "__dadian_code")).drop("__dadian_code")


def join_report(
    matched: DataFrame,
    mapping: DataFrame,
    code_column: str = CODE_COLUMN,
    alarm_above: float = fixed.JOIN_FAILURE_ALARM,
    unmatched_label: str = fixed.UNMATCHED_LABEL,
) -> DataFrame:
    """How many postings have a code that the crosswalk does not know.

    The postings are counted per code before anything is joined, so the join
    sees one row per distinct code. The rate is over all rows. No rows, no
    report.
    """
    per_code = matched.groupBy(F.col(code_column).alias("code")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = mapping.select(F.col("dadian_code").alias("code")).distinct()
    keyed = F.col("code").isNotNull() & ~F.col("code").isin("", unmatched_label)
    flagged = per_code.join(known.withColumn("known", F.lit(True)), "code", "left")
    failed = F.when(keyed & F.col("known").isNull(), F.col("rows")).otherwise(F.lit(0))
    totals = flagged.agg(
        F.sum("rows").alias("total"), F.sum(failed).alias("failed")
    ).where("total > 0")
    rate = F.col("failed") / F.col("total")
    return totals.select(
        "total",
        "failed",
        rate.alias("failure_rate"),
        (rate > alarm_above).alias("alarm"),
    )
