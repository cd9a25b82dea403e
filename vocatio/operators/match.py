"""Matching of postings to the occupation dictionary.

The whole decision is column arithmetic over one array of candidates. Only
the vector search, the embedding and the optional reranking run in Python, and
none of them shuffles or multiplies the postings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from vocatio import fixed_values as fixed
from vocatio.functions import blocks, models, text as rules, vectors
from vocatio.functions.answers import BATCH_TEXTS, answered
from vocatio.operators.dictionary import fingerprint, with_keywords
from vocatio.operators.sizing import left_join
from vocatio.sources.folders import fresh_folder


@dataclass(frozen=True)
class MatchSettings:
    top_k: int = fixed.TOP_K
    min_embed_score: float = fixed.MIN_EMBED_SCORE
    rerank_score_threshold: float = fixed.RERANK_SCORE_THRESHOLD
    rerank_min_embed_score: float = fixed.RERANK_MIN_EMBED_SCORE
    rule_bypass_score: float = fixed.RULE_BYPASS_SCORE
    text_column: str = fixed.STANDARDIZED_COLUMN
    name_column: str = fixed.OCCUPATION_NAME_COLUMN
    task_column: str = fixed.OCCUPATION_TASK_COLUMN
    unmatched_label: str = fixed.UNMATCHED_LABEL
    is_match_yes: str = fixed.IS_MATCH_YES
    is_match_no: str = fixed.IS_MATCH_NO
    suspicious_occupations: dict[str, list[str]] = field(
        default_factory=lambda: dict(fixed.SUSPICIOUS_OCCUPATIONS)
    )


def posting_text(df: DataFrame, settings: MatchSettings) -> Column:
    """The text to match; a frame without the column counts as blank."""
    if settings.text_column not in df.columns:
        return F.lit("")
    return rules.text_or_empty(F.col(settings.text_column))


def embed_postings(
    df: DataFrame,
    factory: Callable[[], models.Embed],
    settings: MatchSettings = MatchSettings(),
    answers: tuple[str, str, int] | None = None,
) -> DataFrame:
    """Add ``embedding``; invalid texts never reach the model.

    With ``answers``, a folder, the model's name and the texts per commit, vectors are kept there by text.
    """
    text = posting_text(df, settings)
    valid_text = F.when(~rules.is_invalid_input(text), text)
    if answers is not None:
        return answered(df, valid_text, "embedding", lambda asked: models.embedded(asked, factory), *answers)
    return df.withColumn("embedding", models.embedded(valid_text, factory))


def add_candidates(
    df: DataFrame,
    dictionary: DataFrame,
    settings: MatchSettings = MatchSettings(),
    max_block_bytes: int = vectors.MAX_BLOCK_BYTES,
) -> DataFrame:
    """Add ``candidates``, the top-k dictionary entries of each valid posting.

    A dictionary of one block is broadcast and the postings stay where they are. A larger one is
    searched by blocks; the postings are then stored once, as rows need a number that stays.
    """
    text = posting_text(df, settings)
    vector = F.when(~rules.is_invalid_input(text), F.col("embedding"))
    try:
        return df.withColumn("candidates", vectors.cosine_topk(vector, dictionary, settings.top_k, max_block_bytes))
    except vectors.TooLarge:
        held = blocks.build_blocks(dictionary, max_block_bytes)
    path = fresh_folder(df.sparkSession, "numbered")
    df.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    numbered = df.sparkSession.read.parquet(path)
    asked = numbered.select(F.col("__row").alias("row"), vector.alias("vector"))
    found = blocks.search_blocks(asked, held, settings.top_k, max_block_bytes)
    return numbered.join(found.withColumnRenamed("row", "__row"), "__row", "left").select(*df.columns, "candidates")


def candidate_rows(candidates: DataFrame, *keep: str) -> DataFrame:
    """One row per candidate, with its 1-based rank."""
    return candidates.select(*keep, F.posexplode("candidates").alias("pos", "c")).select(
        *keep,
        (F.col("pos") + 1).alias("rank"),
        F.col("c.occ_idx").alias("occ_idx"),
        F.col("c.score").alias("score"),
    )


def add_rerank_scores(
    df: DataFrame,
    dictionary: DataFrame,
    factory: Callable[[], models.Rerank],
    settings: MatchSettings = MatchSettings(),
    answers: tuple[str, str, int] | None = None,
) -> DataFrame:
    """Add ``rerank_scores`` where the best candidate is good enough to pay for it.

    With ``answers``, a folder, the model's name and the texts per commit, scores are kept there by
    text and candidates.
    """
    gate = max(settings.min_embed_score, settings.rerank_min_embed_score)
    eligible = F.try_element_at("candidates", F.lit(1))["score"] >= gate
    indices = F.when(eligible, F.transform("candidates", lambda c: c["occ_idx"]))
    text = posting_text(df, settings)
    if answers is not None:
        store, name, batch = answers
        given = F.when(eligible, F.struct(text.alias("text"), indices.alias("indices")))
        return answered(
            df, given, "rerank_scores",
            lambda pair: models.reranked(pair["text"], pair["indices"], dictionary, factory),
            store, f"{name} {fingerprint(dictionary, name)}", batch,
        )
    scores = models.reranked(text, indices, dictionary, factory)
    return df.withColumn("rerank_scores", scores)


def decide(
    df: DataFrame, dictionary: DataFrame, settings: MatchSettings = MatchSettings()
) -> DataFrame:
    """Turn candidates (and rerank scores, if present) into the match columns.

    Every posting gives exactly one row. ``embedding``, ``candidates`` and
    ``rerank_scores`` are consumed.
    """
    text = posting_text(df, settings)
    scores = F.col("rerank_scores") if "rerank_scores" in df.columns else F.lit(None)
    scores = scores.cast("array<double>")
    ranked = df.withColumns(
        {
            "__best": F.coalesce(F.try_element_at("candidates", F.lit(1))["score"], F.lit(0.0)),
            "__top_rerank": F.array_max(scores),
            "__rank": F.coalesce(
                F.array_position(scores, F.array_max(scores)).cast("int"), F.lit(1)
            ),
        }
    ).withColumn("__chosen", F.try_element_at("candidates", F.col("__rank")))
    ranked = ranked.withColumn("__chosen_idx", F.col("__chosen.occ_idx"))

    attributes = {
        "match_occupation": settings.name_column,
        "match_main_task": settings.task_column,
        **{f"match_{name}": name for name in fixed.MATCH_LEVEL_COLUMNS},
    }
    lookup = with_keywords(
        dictionary, settings.suspicious_occupations, settings.name_column
    ).select(
        F.col("occ_idx").cast("int").alias("__occ_idx"),
        F.col("rule_keywords").alias("__keywords"),
        *[
            (F.col(source) if source in dictionary.columns else F.lit("")).alias(f"__{target}")
            for target, source in attributes.items()
        ],
    )
    found = left_join(ranked, lookup, ("__chosen_idx", "__occ_idx"))

    valid = ~rules.is_invalid_input(text)
    near = valid & (F.col("__best") >= settings.min_embed_score)
    was_reranked = F.col("__top_rerank").isNotNull()
    accepted = ~was_reranked | (F.col("__top_rerank") >= settings.rerank_score_threshold)
    plausible = (
        F.col("__keywords").isNull()
        | (F.col("__chosen.score") >= settings.rule_bypass_score)
        | rules.contains_any(text, F.col("__keywords"))
    )
    matched = near & accepted & plausible & F.col("__occ_idx").isNotNull()

    labels = {"match_occupation", "match_main_task"}
    decided = found.withColumn("__matched", matched).withColumns(
        {
            target: F.when(F.col("__matched"), F.col(f"__{target}")).otherwise(
                F.lit(settings.unmatched_label if target in labels else "")
            )
            for target in attributes
        }
        | {
            "embed_score": F.when(~valid, F.lit(0.0))
            .when(near & accepted, F.col("__chosen.score"))
            .otherwise(F.col("__best")),
            "rerank_score": F.when(near & was_reranked, F.col("__top_rerank")).otherwise(0.0),
            "match_rank": F.when(F.col("__matched"), F.col("__rank")).otherwise(1),
            "is_match": F.when(F.col("__matched"), F.lit(settings.is_match_yes)).otherwise(
                F.lit(settings.is_match_no)
            ),
        }
    )
    spent = [name for name in decided.columns if name.startswith("__")]
    return decided.drop(*spent, "embedding", "candidates", "rerank_scores")


def match(
    df: DataFrame,
    dictionary: DataFrame,
    settings: MatchSettings = MatchSettings(),
    embed: Callable[[], models.Embed] | None = None,
    rerank: Callable[[], models.Rerank] | None = None,
    answers: str | None = None,
    names: tuple[str, str] = ("embed", "rerank"),
    answer_batch: int = BATCH_TEXTS,
) -> DataFrame:
    """Postings with the 14 match columns appended.

    Without ``embed`` the postings bring their own ``embedding`` column;
    without ``rerank`` the best candidate is taken as it is. In the folder
    ``answers`` the models' answers are kept under their ``names``.
    """
    if embed is not None:
        df = embed_postings(df, embed, settings, answers and (answers, names[0], answer_batch))
    searched = add_candidates(df, dictionary, settings)
    if rerank is not None:
        searched = add_rerank_scores(searched, dictionary, rerank, settings, answers and (answers, names[1], answer_batch))
    return decide(searched, dictionary, settings)


def match_counts(matched: DataFrame, is_match_yes: str = fixed.IS_MATCH_YES) -> DataFrame:
    """Per year: rows, matched, unmatched."""
    return matched.groupBy("year").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_match") == is_match_yes).alias("matched"),
        F.count_if(F.col("is_match") != is_match_yes).alias("unmatched"),
    )
