"""Standardization: duties out of a posting, rewritten by a model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import models, text as rules
from vocatio.functions.answers import answered
from vocatio.operators.clean import require_columns


def standardize(
    postings: DataFrame,
    factory: Callable[[], models.Generate],
    prefix: str,
    suffix: str = "",
    text_column: str = fixed.TEXT_COLUMN,
    output_column: str = fixed.STANDARDIZED_COLUMN,
    max_chars: int = fixed.MAX_INPUT_CHARS,
    answers: tuple[str, str, int] | None = None,
) -> DataFrame:
    """Send every non-blank posting to the model and format its answer.

    Blank postings are not sent; they get '' and ``standardize_ok`` = false. With ``answers``, a
    folder, the model's name and the prompts per commit, answers are kept there and each prompt is
    asked once.
    """
    require_columns(postings, [text_column])
    raw = rules.text_or_empty(F.col(text_column))
    sent = F.when(rules.strip(raw) != "", rules.prompt(raw, prefix, suffix, max_chars=max_chars))
    if answers is None:
        return _with_output(postings, rules.format_numbered(models.generated(sent, factory)), output_column)
    asked = answered(postings, sent, "__answer", lambda prompt: models.generated(prompt, factory), *answers)
    return _with_output(asked, rules.format_numbered(F.col("__answer")), output_column).drop("__answer")


def rule_based_duties(text: Column, max_items: int = 5) -> Column:
    """Stand-in for the model: the first duties of a posting as a numbered list."""
    numbering = rf"^{rules.WS}*{rules.DIGIT}+{fixed.NUMBER_DELIMITERS}"

    def listed(duties: Column) -> Column:
        items = F.filter(
            F.transform(
                F.split(duties, r"[\n；;。]"),
                lambda piece: rules.strip(F.regexp_replace(piece, numbering, "")),
            ),
            lambda piece: piece != "",
        )
        numbered = F.transform(
            F.slice(items, 1, max_items),
            lambda item, i: F.concat((i + 1).cast("string"), F.lit(". "), item),
        )
        return F.array_join(numbered, "\n")

    return rules.bind(
        rules.bind(rules.duty_text(text), listed),
        lambda found: F.when(found == "", F.lit(fixed.UNRECOGNIZED)).otherwise(found),
    )


def standardize_by_rule(
    postings: DataFrame,
    text_column: str = fixed.TEXT_COLUMN,
    output_column: str = fixed.STANDARDIZED_COLUMN,
    max_items: int = 5,
) -> DataFrame:
    """``standardize`` with the rule-based stand-in; no Python involved."""
    require_columns(postings, [text_column])
    raw = rules.text_or_empty(F.col(text_column))
    answer = F.when(rules.strip(raw) != "", rule_based_duties(raw, max_items))
    return _with_output(postings, rules.format_numbered(answer), output_column)


def _with_output(postings: DataFrame, formatted: Column, output_column: str) -> DataFrame:
    return postings.withColumn(output_column, formatted).withColumn(
        "standardize_ok", rules.is_standardized(F.col(output_column))
    )


def standardize_counts(standardized: DataFrame) -> DataFrame:
    """Per year: processed, success, failed."""
    return standardized.groupBy("year").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if("standardize_ok").alias("success"),
        F.count_if(~F.col("standardize_ok")).alias("failed"),
    )
