"""Small helpers shared by the operators: tables, scratch tables, worker caches."""

from __future__ import annotations

import ctypes
import gc
import sys
import time

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vocatio.sources.folders import fresh_folder

IDLE_SECONDS = 30  # after which a worker forgets what it built for another stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the cluster's shared folder: its lineage ends there."""
    path = fresh_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bucketed(frame: DataFrame, purpose: str, column: str) -> tuple[DataFrame, str]:
    """The frame as a table in the shared folder, in buckets by a column: joins on it leave the table in place.

    Buckets need a name in the session's catalog, which is returned to be dropped after use.
    """
    spark = frame.sparkSession
    path = fresh_folder(spark, purpose)
    name = "scratch_" + "".join(c if c.isalnum() else "_" for c in path.rstrip("/").rsplit("/", 1)[-1])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame.write.bucketBy(buckets, column).option("path", path).saveAsTable(name)
    return spark.table(name), name


def _without_idle(key=None) -> dict:
    """What this worker holds, after what no task has asked for lately is let go."""
    cache = sys.modules["pyspark"].__dict__.setdefault("_vocatio_llm", {})
    now = time.monotonic()
    for other in [k for k, (_, used) in cache.items() if k != key and now - used > IDLE_SECONDS]:
        del cache[other]
    return cache


def once_per_worker(key, build):
    """What ``build`` makes, made once in this Python worker.

    Functions travel to the workers by value, so a cache among their globals
    would be new for every task; this one hangs on an installed module. What no
    task has asked for lately is let go, as workers outlive their stage.
    """
    cache, now = _without_idle(key), time.monotonic()
    held = cache[key][0] if key in cache else build()
    cache[key] = (held, now)
    return held


def _give_back() -> None:
    """Hand the memory that this worker has freed, and what lies idle there, back to the system."""
    _without_idle()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(function):
    """A function over Arrow batches after which the worker keeps no freed memory: it outlives its stage."""

    def run(batches):
        yield from function(batches)
        _give_back()

    return run


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def texts_by_size(texts: list[bytes], most: int):
    """Index ranges of consecutive texts of at most ``most`` bytes together (one text at least)."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)
