"""Adapters that run a model over Arrow batches.

A model is a parameter. The caller passes a *factory*: it is called once per
Python worker and stage, and returns a function over one batch; later tasks of
the worker find the model (``spark.python.worker.reuse``). Rows that must not reach
the model are passed as null: a Python UDF inside ``when`` would still be
evaluated for every row, a null input is skipped by the adapter itself.
"""

from __future__ import annotations

import math
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vocatio.functions.vectors import (
    MAX_BLOCK_BYTES,
    bounded_blocks,
    list_column,
    unit_rows,
)

Generate = Callable[[list[str]], Sequence[str]]
Embed = Callable[[list[str]], np.ndarray]
Rerank = Callable[[list[tuple[str, str]]], Sequence[float]]

PAIRS_PER_CALL = 256
PROMPTS_PER_CALL = 512  # held as Python strings at a time, however large the Arrow batch
MODELS_KEPT = 2  # per kind and worker: a dictionary and postings may be embedded in turn


_HELD = "vocatio_held_models"


def _held(kind: str, key: str, factory: Callable[[], Callable]) -> Callable:
    """The model that this worker built for ``key``; the two last ones of a kind are kept.

    This package travels to workers by value, so a global of it would be new in
    every task. A module of the worker's own outlives them.
    """
    models = sys.modules.setdefault(_HELD, types.ModuleType(_HELD)).__dict__.setdefault(kind, {})
    if key not in models:
        while len(models) >= MODELS_KEPT:
            models.pop(next(iter(models)))
        models[key] = factory()
    return models[key]


def generated(prompt: Column, factory: Callable[[], Generate]) -> Column:
    """Generated text per prompt; null prompts are not sent and give null."""

    key = uuid.uuid4().hex

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generate = _held("generate", key, factory)
        for batch in batches:
            for start in range(0, len(batch), PROMPTS_PER_CALL):
                prompts = batch.slice(start, PROMPTS_PER_CALL)
                asked = prompts.drop_null().to_pylist()
                found = list(generate(asked))
                if len(found) != len(asked):
                    raise ValueError(f"the model gave {len(found)} answers to {len(asked)} prompts")
                answers = iter(found)
                yield pa.array(
                    [next(answers) if valid else None for valid in prompts.is_valid().to_pylist()],
                    pa.string(),
                )

    return run(prompt)


def embedded(text: Column, factory: Callable[[], Embed]) -> Column:
    """L2-normalized vector per text; null texts are not sent and give null."""

    key = uuid.uuid4().hex

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = _held("embed", key, factory)
        for texts in batches:
            present = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
            vectors = np.empty((0, 0))
            if len(present):
                vectors = unit_rows(np.asarray(embed(texts.drop_null().to_pylist()), np.float64))
            values = pa.array(vectors.astype(np.float32).ravel())
            yield list_column(len(texts), present, np.full(len(present), vectors.shape[1]), values)

    return run(text)


def _rerank_block(texts_by_index, key: str, factory: Callable[[], Rerank], pairs_per_call: int):
    """An Arrow UDF that scores the candidates found in one block of texts."""

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        rerank = _held("rerank", key, factory)
        offered = texts_by_index.value
        for queries, candidates, running in batches:
            asked = np.flatnonzero(candidates.is_valid().to_numpy(zero_copy_only=False))
            lists = candidates.drop_null()
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            scores = running.drop_null().flatten().to_numpy(zero_copy_only=False).copy()
            # Every text once, however many candidates it has.
            texts, owners = queries.to_pylist(), np.repeat(asked, lengths).tolist()
            wanted = lists.flatten().to_pylist()
            here = [i for i, index in enumerate(wanted) if index in offered]
            for start in range(0, len(here), pairs_per_call):
                part = here[start : start + pairs_per_call]
                scores[part] = rerank([(texts[owners[i]], offered[wanted[i]]) for i in part])
            yield list_column(len(queries), asked, lengths, pa.array(scores))

    return run


def reranked(
    text: Column,
    candidates: Column,
    dictionary: DataFrame,
    factory: Callable[[], Rerank],
    pairs_per_call: int = PAIRS_PER_CALL,
    max_block_bytes: int = MAX_BLOCK_BYTES,
) -> Column:
    """One score per candidate of a posting, as an array in candidate order.

    ``candidates`` holds dictionary indices; ``dictionary`` has ``occ_idx`` and
    ``occupation_text`` and is broadcast in blocks of checked size. The pairs
    are formed inside the task that holds the posting, so nothing is exploded
    or shuffled. Null candidates give null and cost nothing; a candidate that
    is not in the dictionary scores 0.
    """
    context = dictionary.sparkSession.sparkContext
    texts = dictionary.select(F.col("occ_idx").cast("int"), "occupation_text")
    scores, key = F.transform(candidates, lambda _: F.lit(0.0)), uuid.uuid4().hex
    for table in bounded_blocks(texts, max_block_bytes):
        block = dict(zip(table["occ_idx"].to_pylist(), table["occupation_text"].to_pylist()))
        run = _rerank_block(context.broadcast(block), key, factory, pairs_per_call)
        scores = run(text, candidates, scores)
    return scores


# --- deterministic stand-ins, for tests and dry runs without a model ----------


def letter_profile() -> Embed:
    """Stand-in embedding: how often each of a-z occurs, in any case."""

    def embed(texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), 26))
        for row, text in enumerate(texts):
            codes = np.frombuffer(text.encode("utf-8"), np.uint8)
            folded = np.bincount(codes, minlength=256)
            counts[row] = folded[97:123] + folded[65:91]
        return counts

    return embed


def word_overlap() -> Rerank:
    """Stand-in reranker: Jaccard overlap of blank-separated words."""

    def rerank(pairs: list[tuple[str, str]]) -> list[float]:
        scores = []
        for query, candidate in pairs:
            left, right = set(query.split(" ")), set(candidate.split(" "))
            overlap = len(left & right) / len(left | right)
            scores.append(math.floor(overlap * 1e6 + 0.5) / 1e6)
        return scores

    return rerank
