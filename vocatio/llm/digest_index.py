"""Exact dedup over an index of live digests in cuckoo filters.

Digests of normalised texts are dealt to shards. A shard's filter holds a 16-bit mark of
every live digest in one of two buckets of four; it can take a digest in and out again. A
batch of documents sends its digests, not its texts, through the filters: a digest that
misses is new, and its text is equal to no other. One that hits (met before, in the same
batch or by chance) is verified: its texts are grouped by content, together with the live
content of earlier batches, which lies in files by shard. When a filter overflows, it is
built again with twice the buckets from the stored digests of its shard.

All state is in a shared folder. Each batch writes a folder of its own and is published by
one row in the table of commits, written last; what a lost driver left behind is never read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vocatio.llm.words import column_bytes, mix

SHARDS = 64  # per index; a task holds the digests of one shard, 8 bytes each
SLOTS = 4  # marks per bucket
KICKS = 200  # marks moved before a filter counts as full
MOST_BROADCAST = 1_000_000  # digests that hit, 8 bytes each; with more of them texts are shuffled first
HOT_SHARE = 1000  # a group with a thousandth of all rows is hot: at most so many groups are


class CuckooFilter:
    """Marks of 64-bit digests in buckets of four; each mark lies in one of its two buckets."""

    def __init__(self, buckets: int, marks: list[int] | None = None):
        self.buckets = buckets  # a power of two
        self.marks = marks or [0] * (buckets * SLOTS)

    @classmethod
    def of(cls, digests: np.ndarray, least: int = 16) -> CuckooFilter:
        """A filter of these digests, as large as they need."""
        buckets = least
        while buckets * SLOTS * 0.9 < len(digests):
            buckets *= 2
        while True:
            found = cls(buckets)
            if all(found.insert(*place) for place in found.places(digests)):
                return found
            buckets *= 2

    def places(self, digests: np.ndarray) -> list[tuple[int, int]]:
        """Mark and first bucket of each digest."""
        digests = digests.view(np.uint64)
        marks = np.maximum((digests >> np.uint64(48)).astype(np.int64), 1)
        first = (mix(digests) & np.uint64(self.buckets - 1)).astype(np.int64)
        return list(zip(marks.tolist(), first.tolist()))

    def other(self, mark: int, bucket: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 >> 7 & (self.buckets - 1))

    def _slot(self, mark: int, bucket: int) -> int:
        try:
            return self.marks.index(mark, bucket * SLOTS, bucket * SLOTS + SLOTS)
        except ValueError:
            return -1

    def contains(self, mark: int, bucket: int) -> bool:
        return self._slot(mark, bucket) >= 0 or self._slot(mark, self.other(mark, bucket)) >= 0

    def insert(self, mark: int, bucket: int) -> bool:
        """False when the filter is full; it must then be built anew, as a moved mark has no place."""
        for place in (bucket, self.other(mark, bucket)):
            if (free := self._slot(0, place)) >= 0:
                self.marks[free] = mark
                return True
        bucket = self.other(mark, bucket)
        for kick in range(KICKS):
            at = bucket * SLOTS + kick % SLOTS
            mark, self.marks[at] = self.marks[at], mark
            bucket = self.other(mark, bucket)
            if (free := self._slot(0, bucket)) >= 0:
                self.marks[free] = mark
                return True
        return False

    def delete(self, mark: int, bucket: int) -> bool:
        """Takes one mark out; only digests that are live may be deleted."""
        for place in (bucket, self.other(mark, bucket)):
            if (at := self._slot(mark, place)) >= 0:
                self.marks[at] = 0
                return True
        return False

    def as_bytes(self) -> bytes:
        return np.array(self.marks, "<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        marks = np.frombuffer(data, "<u2").tolist()
        return cls(len(marks) // SLOTS, marks)


# --- tasks over shards ---------------------------------------------------------------

_STATE = "shard int, digest long, marks binary"


def first_bytes(text: bytes, sha: bytes) -> int:
    """The digest of a normalised text: the first eight bytes of its SHA-256."""
    return int.from_bytes(sha[:8], "little", signed=True)


def _normalised(digest: Callable[[bytes, bytes], int], with_text: bool):
    def rows(batches):
        for batch in batches:
            texts = [text.lower() for text in column_bytes(batch.column("text"))]  # of bytes: A-Z only
            hashes = [hashlib.sha256(text) for text in texts]
            found = [pa.array([digest(t, h.digest()) for t, h in zip(texts, hashes)], pa.int64()),
                     pa.array([h.hexdigest() for h in hashes], pa.string())]
            if with_text:
                yield pa.RecordBatch.from_arrays(
                    [*found, pa.array(texts, pa.binary()).cast(pa.string())], names=["digest", "sha", "text"]
                )
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], names=["doc_id", "digest", "sha"])

    return rows


def _combined(batches):
    """Each digest twice at most per batch of rows, so that a hot one is few events and a repeated one still hits."""
    for batch in batches:
        digests, n = np.unique(batch.column("digest").to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(digests, np.minimum(n, 2)))], names=["digest"])


def _rows(shard: int, digests: list[int], marks: bytes | None) -> pa.Table:
    """Digests that hit, then the new filter."""
    n = len(digests)
    return pa.table(
        {"shard": pa.array([shard] * (n + 1), pa.int32()), "digest": pa.array([*digests, None], pa.int64()),
         "marks": pa.array([None] * n + [marks], pa.binary())}
    )


def _through_filter(events: pa.Table, state: pa.Table) -> pa.Table:
    """Runs a shard's events through its filter. ``state`` holds its stored digests and its filter.

    Arriving digests that miss are inserted; leaving ones are deleted.
    """
    shard = (events if events.num_rows else state).column("shard")[0].as_py()
    stored = state.column("digest").drop_null().to_numpy().view(np.uint64)
    held = state.column("marks").drop_null()
    index = CuckooFilter.from_bytes(held[0].as_py()) if len(held) else CuckooFilter.of(stored)
    kinds = events.column("event").to_pylist()
    digests = events.column("digest").to_numpy().view(np.uint64)
    order = np.argsort(digests, kind="stable")  # a retried task sees its events in the same order
    hits: list[int] = []
    fresh: list[int] = []
    places = index.places(digests)
    for at in order.tolist():
        mark, bucket = places[at]
        if kinds[at] == "leave":
            index.delete(mark, bucket)
            continue
        if index.contains(mark, bucket):
            hits.append(int(digests[at]))
            continue
        fresh.append(int(digests[at]))
        if not index.insert(mark, bucket):
            keys = np.concatenate([stored, np.array(fresh, np.uint64)])
            index = CuckooFilter.of(np.unique(keys), 2 * index.buckets)
            places = index.places(digests)
    # A new digest that only met a foreign mark is live now as well.
    chance = np.setdiff1d(np.array(hits, np.uint64), np.concatenate([stored, np.array(fresh, np.uint64)]))
    for place in index.places(chance):
        if not index.insert(*place):
            keys = np.concatenate([stored, np.array(fresh, np.uint64), chance])
            index = CuckooFilter.of(np.unique(keys), 2 * index.buckets)
            break
    return _rows(shard, np.unique(np.array(hits, np.uint64)).view(np.int64).tolist(), index.as_bytes())


# --- the index ----------------------------------------------------------------------


class DigestIndex:
    """The live documents of a folder, grouped by equal content.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. A
    group's largest doc_id stays. Rows with a null doc_id are in their text's group but never the
    one that stays; a group of only such rows keeps none. Rows that share doc_id and text count
    each and stay together; a doc_id with several texts is in several groups. Other columns are
    left out; empty batches and an empty index are fine.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int = SHARDS, digest=first_bytes):
        self.spark, self.folder, self.shards, self.digest = spark, folder.rstrip("/"), shards, digest
        self.commits: list[tuple[int, str, str]] = []  # batch, folder, kind

    @classmethod
    def open(cls, spark: SparkSession, folder: str, **settings) -> DigestIndex:
        """The index as its committed batches (one at least) left it; one writer at a time may go on."""
        index = cls(spark, folder, **settings)
        rows = spark.read.parquet(f"{index.folder}/commits/*").orderBy("batch").collect()
        index.commits = [(r["batch"], r["folder"], r["kind"]) for r in rows]
        return index

    # Tables of all committed batches.

    def _table(self, name: str, kind: str, schema: str) -> DataFrame:
        paths = [f"{folder}/{name}" for _, folder, of in self.commits if of == kind]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _written(self, frame: DataFrame, path: str, schema: str | None = None) -> DataFrame:
        frame.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema or frame.schema).parquet(path)

    def _contents(self) -> DataFrame:
        """Texts that are or were live, by shard: those taken out since are left out."""
        texts = self._table("contents", "insert", "shard int, digest long, sha string, home int, text string")
        if not any(kind == "delete" for _, _, kind in self.commits):
            return texts
        return texts.join(self._table("emptied", "delete", "digest long, sha string, home int"), ["digest", "sha", "home"], "left_anti")

    def _state(self) -> DataFrame:
        """Stored digests and the latest filter of every shard."""
        digests = self._contents().select("shard", "digest", F.lit(None).cast("binary").alias("marks"))
        if not self.commits:
            return digests
        latest = self.spark.read.schema(_STATE).parquet(f"{self.commits[-1][1]}/filters").filter("marks IS NOT NULL")
        return digests.unionByName(latest)

    def _filtered(self, events: DataFrame, path: str) -> DataFrame:
        """Sends events through the filters; stores the new filters and returns the digests that hit."""
        found = (
            events.groupBy("shard").cogroup(self._state().groupBy("shard"))
            .applyInArrow(_through_filter, _STATE)
        )
        return self._written(found, f"{path}/filters").filter("digest IS NOT NULL").select("digest")

    def _commit(self, batch: int, path: str, kind: str) -> None:
        row = self.spark.createDataFrame([(batch, path, kind)], "batch int, folder string, kind string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/{batch}")
        self.commits.append((batch, path, kind))

    def _attempt(self) -> tuple[int, str]:
        batch = 1 + max((b for b, _, _ in self.commits), default=0)
        return batch, f"{self.folder}/batch-{batch}-{uuid.uuid4().hex}"

    def _shard(self) -> Column:
        return F.pmod(F.col("digest"), F.lit(self.shards)).cast("int")

    def _keyed(self, docs: DataFrame, with_text: bool) -> DataFrame:
        """doc_id, digest, sha of each row, or digest, sha and normalised text."""
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        schema = "digest long, sha string, text string" if with_text else "doc_id long, digest long, sha string"
        return docs.mapInArrow(_normalised(self.digest, with_text), schema)

    # Changes.

    def insert(self, docs: DataFrame) -> None:
        """Takes a batch of documents in."""
        batch, path = self._attempt()
        members = self._written(self._keyed(docs, False).withColumn("batch", F.lit(batch)), f"{path}/members")
        events = members.select("digest").mapInArrow(_combined, "digest long")
        events = events.select(self._shard().alias("shard"), "digest", F.lit("arrive").alias("event"))
        hits = self._filtered(events, path)
        # Content of the digests that hit: once per task before it travels. All others travel once, to their shard.
        rows = self._keyed(docs, True)
        if hits.count() <= MOST_BROADCAST:
            hits = F.broadcast(hits)
            met = rows.join(hits, "digest", "left_semi").distinct()
            others = rows.join(hits, "digest", "left_anti")
        else:
            texts = rows.distinct()
            met, others = texts.join(hits, "digest", "left_semi"), texts.join(hits, "digest", "left_anti")
        live = self._contents().join(hits, "digest", "left_semi").select("digest", "sha", "home", F.col("text").alias("before"))
        checked = F.when(F.col("home").isNull(), F.lit(batch)).when(
            F.col("text") == F.col("before"), F.col("home")
        ).otherwise(F.raise_error(F.lit("two texts share a SHA-256")))
        verified = met.join(live, ["digest", "sha"], "left").select("digest", "sha", checked.alias("home"), "text")
        verified = self._written(verified, f"{path}/verified")
        self._written(verified.select("digest", "sha", "home"), f"{path}/assigned")
        new = verified.filter(F.col("home") == batch).select("digest", "sha", "home", "text")
        new = new.unionByName(others.select("digest", "sha", F.lit(batch).alias("home"), "text"))
        new = new.select(self._shard().alias("shard"), "digest", "sha", "home", "text")
        self._written(new.repartition(self.shards, "shard"), f"{path}/contents")
        self._commit(batch, path, "insert")

    def delete(self, ids: DataFrame) -> None:
        """Takes all live rows with these doc_ids out; a digest goes with its last row."""
        batch, path = self._attempt()
        ids = ids.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
        live = self.members().withColumn("gone", F.lit(False))
        gone = live.join(ids, "doc_id", "left_semi")
        gone = self._written(gone.select("doc_id", "digest", "sha", "home", "batch"), f"{path}/removed")
        left = live.select("digest", "sha", "home").groupBy("digest", "sha", "home").agg(F.count("*").alias("n"))
        out = gone.groupBy("digest", "sha", "home").agg(F.count("*").alias("n_gone"))
        emptied = left.join(out, ["digest", "sha", "home"]).filter("n = n_gone").select("digest", "sha", "home")
        emptied = self._written(emptied, f"{path}/emptied")
        # A digest stays while another content with it is live.
        others = self._contents().join(emptied, ["digest", "sha", "home"], "left_anti").select("digest")
        leaving = emptied.select("digest").distinct().join(others, "digest", "left_anti")
        self._filtered(leaving.select(self._shard().alias("shard"), "digest", F.lit("leave").alias("event")), path)
        self._commit(batch, path, "delete")

    # Results.

    def members(self) -> DataFrame:
        """doc_id, digest, sha, batch, home, met: the live rows; ``home`` and ``sha`` name the content.

        ``met`` tells whether the digest hit when the row came in.
        """
        rows = self._table("members", "insert", "doc_id long, digest long, sha string, batch int")
        assigned = [
            self.spark.read.schema("digest long, sha string, home int").parquet(f"{folder}/assigned").withColumn("batch", F.lit(batch))
            for batch, folder, kind in self.commits
            if kind == "insert"
        ]
        if not assigned:
            return rows.withColumn("home", F.col("batch")).withColumn("met", F.lit(False))
        homes = assigned[0]
        for more in assigned[1:]:
            homes = homes.unionByName(more)
        rows = rows.join(homes, ["digest", "sha", "batch"], "left")
        rows = rows.withColumn("met", F.col("home").isNotNull()).withColumn("home", F.coalesce("home", "batch"))
        if any(kind == "delete" for _, _, kind in self.commits):
            removed = self._table("removed", "delete", "doc_id long, digest long, sha string, home int, batch int")
            rows = rows.join(removed, ["doc_id", "digest", "sha", "batch"], "left_anti")
        return rows.select("doc_id", "digest", "sha", "batch", "home", "met")

    def groups(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256: a row per live row.

        Hot groups, of which there are HOT_SHARE at most, are broadcast; the others join by content.
        """
        rows = self._written(self.members(), f"{self.folder}/results-{uuid.uuid4().hex}")
        content = ["sha", "home"]
        stats = self._written(
            rows.groupBy(*content).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.max("met").alias("met")),
            f"{self.folder}/results-{uuid.uuid4().hex}",
        )
        # A content whose digest never hit is its only row.
        alone = "NOT met AND group_size = 1"
        stats = stats.filter(f"NOT ({alone})")
        least = max(2, -(-rows.count() // HOT_SHARE))
        hot = F.broadcast(stats.filter(F.col("group_size") >= least).drop("met"))
        near = rows.join(hot, content, "left")
        done = near.filter("group_size IS NOT NULL")
        rest = near.filter("group_size IS NULL").drop("keep_id", "group_size")
        rest = rest.join(stats.filter(F.col("group_size") < least).drop("met"), content, "left")
        rest = rest.withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
        found = done.unionByName(rest).withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
        kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False))
        return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, folder: str, batches: int = 2) -> DataFrame:
    """The groups of a table that comes in by ``batches`` parts, dealt by doc_id, into an empty index."""
    index = DigestIndex(docs.sparkSession, folder)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for k in range(batches):
        index.insert(docs.filter(part == k))
    return index.groups()
