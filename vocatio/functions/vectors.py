"""Dense vectors: normalization, dot products and exact top-k search.

Scores are computed in double precision and rounded to ``SCORE_DIGITS``;
equal scores are ordered by the smaller dictionary index, so that a result
does not depend on batch sizes or on the summation order of a maths library.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vocatio.operators.sizing import measure

SCORE_DIGITS = 6
CANDIDATE_TYPE = "array<struct<occ_idx:int,score:double>>"

# One broadcast block of a dictionary: 64 MB is about 8,000 vectors of 1,024
# doubles, several times the size of a national occupation classification.
MAX_BLOCK_BYTES = 64 * 1024 * 1024

# Rows scored by one matrix product; bounds the score block held by a task.
SCORE_ROWS = 4096


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left.cast("array<double>"), right.cast("array<double>"), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm == 0.0, wide).otherwise(F.transform(wide, lambda x: x / norm))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0.0, 1.0, norms)


def list_matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the non-null lists and their values as one matrix."""
    present = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    values = lists.drop_null().flatten().to_numpy(zero_copy_only=False)
    if not len(present):
        return present, np.empty((0, 0))
    return present, values.astype(np.float64, copy=False).reshape(len(present), -1)


def list_column(rows: int, present: np.ndarray, lengths: np.ndarray, values: pa.Array) -> pa.Array:
    """Rebuild a list column of ``rows`` entries from its non-null lists."""
    sizes = np.zeros(rows, dtype=np.int64)
    sizes[present] = lengths
    mask = np.ones(rows, dtype=bool)
    mask[present] = False
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(mask))


def _best(indices: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best per row, by descending score and ascending index."""
    if scores.shape[1] > k:
        # Everything that ties with the k-th score must take part in the order.
        kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        width = int((scores >= kth).sum(axis=1).max())
        keep = np.argpartition(-scores, min(width, scores.shape[1]) - 1, axis=1)[:, :width]
        indices = np.take_along_axis(indices, keep, axis=1)
        scores = np.take_along_axis(scores, keep, axis=1)
    order = np.lexsort((indices, -scores), axis=1)[:, :k]
    return np.take_along_axis(indices, order, axis=1), np.take_along_axis(scores, order, axis=1)


def _search(held, k: int):
    """An Arrow UDF that finds the best entries of a broadcast dictionary."""

    def search(vectors: pa.Array) -> pa.Array:
        keys, matrix = held.value
        present, queries = list_matrix(vectors)
        indices, scores = [np.empty(0)], [np.empty(0)]
        width = min(k, len(keys))
        for start in range(0, len(present), SCORE_ROWS):
            rows = unit_rows(queries[start : start + SCORE_ROWS])
            found = np.round(rows @ matrix.T, SCORE_DIGITS)
            best_idx, best_score = _best(np.broadcast_to(keys, found.shape), found, k)
            indices.append(best_idx.ravel())
            scores.append(best_score.ravel())
        values = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(indices).astype(np.int32)),
                pa.array(np.concatenate(scores).astype(np.float64)),
            ],
            names=["occ_idx", "score"],
        )
        return list_column(len(vectors), present, np.full(len(present), width), values)

    @F.arrow_udf(CANDIDATE_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield search(vectors)

    return run


class TooLarge(ValueError):
    """A dictionary that is more than one block."""


def bounded_blocks(dictionary: DataFrame, max_block_bytes: int) -> Iterator[pa.Table]:
    """Bring a dictionary to the driver in blocks of bounded size, one at a time.

    A dictionary within the bound, which is the normal case, is one block read
    by one job. A larger one is cut at quantiles of ``occ_idx``.
    """
    rows, total_bytes = measure(dictionary)
    if not rows:
        return
    blocks = -(-total_bytes // max_block_bytes)
    shares = [i / blocks for i in range(1, blocks)]
    cuts = [None, None]
    if shares:
        quantiles = F.percentile_approx("occ_idx", shares, 100 * blocks)
        cuts[1:1] = sorted(set(dictionary.agg(quantiles).first()[0]))
    for above, upto in zip(cuts, cuts[1:]):
        part = dictionary
        if above is not None:
            part = part.where(F.col("occ_idx") > above)
        if upto is not None:
            part = part.where(F.col("occ_idx") <= upto)
        table = part.orderBy("occ_idx").toArrow()
        if table.num_rows:
            yield table


def cosine_topk(
    vector: Column,
    dictionary: DataFrame,
    k: int,
    max_block_bytes: int = MAX_BLOCK_BYTES,
) -> Column:
    """The k nearest dictionary entries of a vector, as sorted (occ_idx, score).

    ``dictionary`` has ``occ_idx`` and ``embedding``; give a stored or cached one, as it is
    measured first. It is broadcast, never joined, so the postings are neither shuffled nor
    multiplied. One beyond ``max_block_bytes`` raises ``TooLarge``; ``blocks.search_blocks`` is
    for those. Null vectors give null; fewer than k entries give all.
    """
    entries = dictionary.select(
        F.col("occ_idx").cast("int"), F.col("embedding").cast("array<double>")
    ).where(F.col("embedding").isNotNull())
    rows, total_bytes = measure(entries)
    if total_bytes > max_block_bytes:
        raise TooLarge(f"the dictionary has {total_bytes} bytes, a block {max_block_bytes}")
    if not rows:
        return F.when(vector.isNotNull(), F.array().cast(CANDIDATE_TYPE))
    table = entries.orderBy("occ_idx").toArrow()
    held = table["occ_idx"].to_numpy(), unit_rows(list_matrix(table["embedding"].combine_chunks())[1])
    return _search(dictionary.sparkSession.sparkContext.broadcast(held), k)(vector)
