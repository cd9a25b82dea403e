"""End-to-end classification: clean, standardize, match, crosswalk."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import models, text as rules
from vocatio.functions.answers import BATCH_TEXTS
from vocatio.operators.clean import ORDER_COLUMNS, clean_postings
from vocatio.operators.crosswalk import CODE_COLUMN, add_crosswalk
from vocatio.operators.match import MatchSettings, match
from vocatio.operators.standardize import standardize, standardize_by_rule
from vocatio.sources.datasets import read_if_present, write_dataset, write_final, years_in

STAGES = ("clean", "standardize", "match", "crosswalk")


@dataclass(frozen=True)
class Job:
    """What a run needs; models are factories, dimensions are DataFrames.

    ``model_names`` tell models and versions apart in the stored answers, of which
    ``answer_batch`` are committed at a time.
    """

    dictionary: DataFrame | None = None
    mapping: DataFrame | None = None
    detail: DataFrame | None = None
    generate: Callable[[], models.Generate] | None = None
    embed: Callable[[], models.Embed] | None = None
    rerank: Callable[[], models.Rerank] | None = None
    model_names: tuple[str, str, str] = ("generate", "embed", "rerank")
    answer_batch: int = BATCH_TEXTS
    prompt_prefix: str = field(default_factory=lambda: "\n".join(rules.prompt_texts()))
    prompt_suffix: str = ""
    settings: MatchSettings = MatchSettings()
    min_effective_len: int = fixed.MIN_EFFECTIVE_LEN
    order_by: tuple[str, ...] = ORDER_COLUMNS
    code_column: str = CODE_COLUMN
    best_only: bool = False


def _clean(df: DataFrame, job: Job, answers: str | None) -> DataFrame:
    return clean_postings(df, job.min_effective_len, job.order_by)


def _standardize(df: DataFrame, job: Job, answers: str | None) -> DataFrame:
    output = job.settings.text_column
    if job.generate is None:
        return standardize_by_rule(df, output_column=output)
    return standardize(
        df, job.generate, job.prompt_prefix, job.prompt_suffix, output_column=output,
        answers=answers and (answers, job.model_names[0], job.answer_batch),
    )


def _match(df: DataFrame, job: Job, answers: str | None) -> DataFrame:
    return match(df, job.dictionary, job.settings, job.embed, job.rerank, answers, job.model_names[1:], job.answer_batch)


def _crosswalk(df: DataFrame, job: Job, answers: str | None) -> DataFrame:
    return add_crosswalk(
        df,
        job.mapping,
        job.detail,
        job.code_column,
        job.best_only,
        job.settings.unmatched_label,
    )


_RUN = {"clean": _clean, "standardize": _standardize, "match": _match, "crosswalk": _crosswalk}


def chosen_stages(start_from: str = "clean", only: str | None = None) -> tuple[str, ...]:
    for name in (start_from, only):
        if name is not None and name not in STAGES:
            raise ValueError(f"unknown stage {name!r}; stages are {STAGES}")
    return (only,) if only else STAGES[STAGES.index(start_from) :]


def classify(
    postings: DataFrame,
    job: Job,
    start_from: str = "clean",
    only: str | None = None,
    store: str | None = None,
    years: list[str] | None = None,
) -> DataFrame:
    """Run the stages, all years in one job.

    ``postings`` is the input of the first chosen stage. With ``store`` each
    stage is written below that folder and the next one reads it back. Model
    answers are kept by content in ``store/answers``, committed batch by batch:
    equal texts are asked once, and a run that died is resumed by calling it
    again, which asks what has no answer yet. ``years`` are the years of the input; give them where they are known,
    or they are looked up. Without ``store`` the stages form one lazy plan.
    """
    spark = postings.sparkSession
    if store is not None and years is None:
        years = years_in(postings)
    df = postings
    for stage in chosen_stages(start_from, only):
        df = _RUN[stage](df, job, store and f"{store.rstrip('/')}/answers")
        if store is not None:
            path = f"{store.rstrip('/')}/{stage}"
            if stage == "crosswalk":
                write_final(df, path)
            else:
                # Models work row by row on rows that are stored by year: no shuffle behind them.
                write_dataset(df, path, rebalance=stage == "clean")
            # A stage without rows leaves no files to read back.
            stored = read_if_present(spark, path)
            df = df.limit(0) if stored is None else stored.where(F.col("year").isin(years))
    return df
