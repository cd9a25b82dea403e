"""Exact top-k search over a dictionary that no task holds whole.

Entries are grouped by their nearest pivot, a few entries drawn by hash, and cut into blocks of
bounded size; a task holds one block. A vector first meets the blocks of its nearest pivot. Its
k-th best score there bounds what it still needs: on the sphere, an entry within angle r of its
pivot is at least (angle to the pivot - r) away from the vector, so most groups cannot hold a
better entry and are skipped. The others are met in a second round. Vectors travel to blocks, as
many copies of a block as it takes to keep the vectors of a task within the same size. The best
are kept by a window of k rows per vector, which Spark applies before it shuffles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vocatio.functions.vectors import MAX_BLOCK_BYTES, SCORE_DIGITS, _best, list_matrix, unit_rows
from vocatio.operators.sizing import measure
from vocatio.sources.folders import fresh_folder

_SCORE_ROWS = 4096


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = fresh_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _rows_of(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors that travel as bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


@dataclass(frozen=True)
class Blocks:
    """pivot, part, keys, matrix: a row per block; ``pivots`` with the least cosine and parts of each group."""

    rows: DataFrame
    pivots: np.ndarray
    least: np.ndarray
    parts: np.ndarray


def build_blocks(dictionary: DataFrame, max_block_bytes: int = MAX_BLOCK_BYTES) -> Blocks | None:
    """Blocks of a dictionary with ``occ_idx`` and ``embedding``; None without vectors.

    There are about as many pivots as blocks; only they come to the driver.
    """
    spark = dictionary.sparkSession
    vectors = dictionary.select(
        F.col("occ_idx").cast("int").alias("occ_idx"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("embedding").isNotNull())
    rows, total_bytes = measure(vectors)
    if not rows:
        return None
    wanted = -(-total_bytes // max_block_bytes)
    drawn = vectors.orderBy(F.xxhash64("occ_idx"), "occ_idx").limit(int(wanted)).toArrow()
    pivots = unit_rows(list_matrix(drawn["embedding"].combine_chunks())[1])
    shared = spark.sparkContext.broadcast(pivots)

    def grouped(batches):
        for batch in batches:
            matrix = unit_rows(list_matrix(batch.column("embedding"))[1])
            cosines = matrix @ shared.value.T
            nearest = cosines.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("occ_idx"), pa.array(nearest.astype(np.int32)), pa.array(cosines.max(axis=1)),
                 pa.array([row.tobytes() for row in matrix], pa.binary())],
                names=["occ_idx", "pivot", "cosine", "vector"],
            )

    entries = _stored(
        vectors.mapInArrow(grouped, "occ_idx int, pivot int, cosine double, vector binary"), "dictionary-groups"
    )
    least, parts = np.ones(len(pivots)), np.zeros(len(pivots), np.int64)
    for row in entries.groupBy("pivot").agg(F.min("cosine").alias("least"), F.count("*").alias("n")).collect():
        least[row["pivot"]] = row["least"]
        parts[row["pivot"]] = max(1, math.ceil(row["n"] * (8 * pivots.shape[1] + 16) / max_block_bytes))
    of_pivot = spark.createDataFrame([(p, int(n)) for p, n in enumerate(parts)], "pivot int, parts long")
    part = F.pmod(F.xxhash64("occ_idx"), F.greatest("parts", F.lit(1))).cast("int").alias("part")

    def packed(block: pa.Table) -> pa.Table:
        block = block.sort_by("occ_idx")
        return pa.table(
            {"pivot": block["pivot"].slice(0, 1), "part": block["part"].slice(0, 1),
             "keys": pa.array([block["occ_idx"].to_pylist()], pa.list_(pa.int32())),
             "matrix": pa.array([b"".join(block["vector"].to_pylist())], pa.binary())}
        )

    blocks = (
        entries.join(F.broadcast(of_pivot), "pivot").select("pivot", part, "occ_idx", "vector")
        .groupBy("pivot", "part").applyInArrow(packed, "pivot int, part int, keys array<int>, matrix binary")
    )
    return Blocks(_stored(blocks, "dictionary-blocks"), pivots, least, parts)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _sent(blocks: Blocks, first: bool):
    """The blocks that a vector must meet: those of its nearest pivot, or all others that may hold better ones."""
    spark_context = blocks.rows.sparkSession.sparkContext
    shared = spark_context.broadcast((blocks.pivots, _angles(blocks.least), blocks.parts))

    def send(batches):
        pivots, radius, parts = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _SCORE_ROWS):
                part = batch.slice(start, _SCORE_ROWS)
                vectors = _rows_of(part.column("vector"), pivots.shape[1])
                cosines = vectors @ pivots.T
                cosines[:, parts == 0] = -2.0
                nearest = cosines.argmax(axis=1)
                if first:
                    chosen = np.zeros(cosines.shape, bool)
                    chosen[np.arange(len(nearest)), nearest] = True
                else:
                    most = np.cos(np.maximum(0.0, _angles(cosines) - radius[None, :]))
                    needed = part.column("bound").to_numpy(zero_copy_only=False)
                    chosen = (most >= needed[:, None] - 2 * 10.0**-SCORE_DIGITS) & (parts > 0)[None, :]
                    chosen[np.arange(len(nearest)), nearest] = False
                row, pivot = np.nonzero(chosen)
                times = parts[pivot]
                row, pivot, total = np.repeat(row, times), np.repeat(pivot, times), int(times.sum())
                number = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pivot.astype(np.int32)), pa.array(number.astype(np.int32)),
                     part.column("row").take(pa.array(row)), part.column("vector").take(pa.array(row))],
                    names=["pivot", "part", "row", "vector"],
                )

    return send


def _scored(k: int, size: int):
    def score(vectors: pa.Table, block: pa.Table) -> pa.Table:
        schema = pa.schema([("row", pa.int64()), ("occ_idx", pa.int32()), ("score", pa.float64())])
        if not vectors.num_rows or not block.num_rows:
            return schema.empty_table()
        keys = np.array(block["keys"][0].as_py(), np.int64)
        matrix = np.frombuffer(block["matrix"][0].as_py(), np.float64).reshape(-1, size)
        found = []
        for start in range(0, vectors.num_rows, _SCORE_ROWS):
            part = vectors.slice(start, _SCORE_ROWS)
            scores = np.round(_rows_of(part["vector"].combine_chunks(), size) @ matrix.T, SCORE_DIGITS)
            indices, best = _best(np.broadcast_to(keys, scores.shape), scores, k)
            rows = np.repeat(part["row"].to_numpy(), best.shape[1])
            found.append(pa.table([pa.array(rows), pa.array(indices.ravel().astype(np.int32)), pa.array(best.ravel())], schema=schema))
        return pa.concat_tables(found)

    return score


def _met(sent: DataFrame, blocks: Blocks, k: int, rows_per_task: int) -> DataFrame:
    """row, occ_idx, score: the k best entries of each block that a vector meets."""
    sent = _stored(sent, "sent-vectors")
    counts = sent.groupBy("pivot", "part").agg(F.count("*").alias("n"))  # a row per block
    copies = F.ceil(F.col("n") / rows_per_task).cast("int").alias("copies")
    # Broadcast by word, as its estimate is that of the vectors: joined by a shuffle, each block's vectors would be one task's.
    counts = F.broadcast(counts.select("pivot", "part", copies))
    place = ["pivot", "part", "copy"]
    held = (
        blocks.rows.join(counts, ["pivot", "part"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    )
    spread = sent.join(counts, ["pivot", "part"]).withColumn("copy", F.pmod(F.xxhash64("row"), "copies").cast("int"))
    return (
        spread.select(*place, "row", "vector").groupBy(*place).cogroup(held.groupBy(*place))
        .applyInArrow(_scored(k, blocks.pivots.shape[1]), "row long, occ_idx int, score double")
    )


def _best_rows(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "occ_idx")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_blocks(vectors: DataFrame, blocks: Blocks, k: int, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """row, candidates: the k nearest entries of each (row, vector), as ``cosine_topk`` gives them."""
    size = blocks.pivots.shape[1]

    def as_units(batches):
        for batch in batches:
            units = unit_rows(list_matrix(batch.column("vector"))[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([u.tobytes() for u in units], pa.binary())], names=["row", "vector"]
            )

    given = vectors.where(F.col("vector").isNotNull()).select("row", F.col("vector").cast("array<double>").alias("vector"))
    units = _stored(given.mapInArrow(as_units, "row long, vector binary"), "vectors")
    rows_per_task = max(1, max_block_bytes // (8 * size))
    columns = "pivot int, part int, row long, vector binary"
    near = _stored(_best_rows(_met(units.mapInArrow(_sent(blocks, True), columns), blocks, k, rows_per_task), k), "near")
    bound = near.groupBy("row").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("bound")
    )
    open_rows = units.join(bound, "row").select("row", "vector", "bound")
    far = _met(open_rows.mapInArrow(_sent(blocks, False), columns), blocks, k, rows_per_task)
    best = _best_rows(near.drop("rank").unionByName(far), k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "occ_idx", "score")))
    candidates = F.transform(ordered, lambda c: F.struct(c["occ_idx"].alias("occ_idx"), c["score"].alias("score")))
    return best.groupBy("row").agg(candidates.alias("candidates"))
