"""MinHash near-duplicates with tensored banding.

Two small collections of sketches are computed per set, each sketch of a few
minimum hashes. Every pair of a sketch of the first and one of the second is a
table key, so SKETCHES squared tables need only 2 SKETCHES sketches. Sets that
share a key are candidates; a link needs the exact similarity of the full sets.

Candidates are not all pairs of a key. A key's smallest members are compared with
the others first; links merge components, and only members of components that are
still apart go on, against eight leaders of each key. A group of linked copies costs a few
comparisons per copy.

Members of keys that are still apart then, texts that share much but too little for a link,
are not compared by key any more, which would make all pairs of them. Each is filed under
its rarest shingles: sets of n and m shingles can only be similar if they share one of the
first n - a + 1 of n and of the first m - a + 1 of m in any common order, a being the
shingles that a link of these sizes needs to share. Sizes go by bands, so that a file holds
sets of two bands only, and the places of the shared shingle in both sets bound what else
they can share. That is exact, and texts whose own shingles make them unlike meet nobody.
Leaders of growing number compare what still meets, until every file is one component or
all its members have led.

A pair goes on to its full sets when their sizes allow the similarity and their coarse
signatures, one bit of the least hash in each of 128 bins, differ by no more than four
deviations beyond what the threshold makes likely.

A second signature proves most other pairs apart without their sets: the parity of the
shingles that fall in each of 256 bins. Bins of unequal parity are at most as many as the
shingles that only one of the sets has, so a pair with more of them than the similarity
allows is no link, and leaving it out loses none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from vocatio.llm.components import star_components
from vocatio.llm.tables import bucketed, lean, stored
from vocatio.llm.words import column_bytes, document_words, mix

SHINGLE_WORDS = 5
SKETCHES = 7  # per collection: 49 tables
HASHES = 2  # minimum hashes per sketch
LEADERS = 8  # growth of the leaders per key from round to round
BITS = 128  # of a coarse signature that candidates are compared by first
PARITIES = 256  # bits of the signature that bounds what two sets do not share
SIGNATURE = (BITS + PARITIES) // 64
BY_KEY = 8  # leaders per table key, after which members are filed under their rarest shingles
SLOTS = 1 << 20  # counters of shingles, by which rare ones come first
BAND = 1.05  # between the sizes of a band
MOST_BROADCAST = 4_000_000  # document numbers, 32 MB; with more of them, texts are shuffled to theirs

_ODD = np.random.default_rng(20240229).integers(0, 1 << 63, (64, 2), dtype=np.uint64) | np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingle hashes of a word sequence."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, SHINGLE_WORDS)
    found = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        found += words[k : n - width + 1 + k] * _ODD[k, 0]
    return np.unique(mix(found + np.uint64(width)))


def _sketch(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            part = batch.slice(first, 1000)
            sets = [shingles(w) for w in document_words(column_bytes(part.column("text")))]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            full = np.flatnonzero(sizes)
            keys: list = [None] * len(sets)
            sketches = np.zeros((len(sets), 2 * SKETCHES + SIGNATURE), np.uint64)
            if len(full):
                values = np.concatenate([sets[i] for i in full])
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                for k in range(2 * SKETCHES):
                    sketch = np.zeros(len(full), np.uint64)
                    for j in range(HASHES):
                        by = _ODD[k * HASHES + j]
                        least = np.minimum.reduceat((values ^ by[1]) * by[0], starts)
                        sketch = mix(sketch * np.uint64(31) + least + np.uint64(k + 1))
                    sketches[full, k] = sketch
                # Sets are sorted, so the least hash of a bin (by its first 7 bits) comes first.
                bins = (values >> np.uint64(57)).astype(np.int64)
                lead = np.append(True, bins[1:] != bins[:-1])
                lead[starts] = True
                bits = np.zeros((len(full), BITS), np.uint8)
                of_set = np.repeat(np.arange(len(full)), sizes[full])
                bits[of_set[lead], bins[lead]] = (values[lead] & np.uint64(1)).astype(np.uint8)
                places = of_set * PARITIES + ((values >> np.uint64(1)) % np.uint64(PARITIES)).astype(np.int64)
                odd = (np.bincount(places, minlength=len(full) * PARITIES) & 1).astype(np.uint8)
                bits = np.concatenate([bits, odd.reshape(len(full), PARITIES)], axis=1)
                sketches[full, 2 * SKETCHES :] = np.packbits(bits, axis=1).view(np.uint64)
                one = np.add.reduceat(mix(values), starts)
                two = np.add.reduceat(mix(values ^ _ODD[63, 1]), starts)
                for at, a, b in zip(full, one, two):
                    keys[at] = a.tobytes() + b.tobytes()
            flat = pa.array(sketches.view(np.int64).ravel())
            bounds = pa.array(np.arange(0, len(flat) + 1, sketches.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(bounds, flat)],
                names=["doc_id", "n_shingles", "set_key", "sketches"],
            )


def _sets(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            part = batch.slice(first, 1000)
            sets = [shingles(w).tobytes() for w in document_words(column_bytes(part.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"]
            )


def _similar(percent: int):
    """Keeps the pairs whose sets reach the similarity."""

    def keep(batches):
        for batch in batches:
            lefts, rights = batch.column("left_set"), batch.column("right_set")
            passed = []
            for left, right in zip(lefts, rights):
                a = np.frombuffer(left.as_buffer(), np.uint64)
                b = np.frombuffer(right.as_buffer(), np.uint64)
                shared = 0
                if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                    if len(a) > len(b):
                        a, b = b, a
                    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                    shared = int(np.count_nonzero(b[at] == a))
                passed.append(100 * shared >= percent * (len(a) + len(b) - shared))
            kept = batch.filter(pa.array(passed, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], names=["u", "v"])

    return keep


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that are links.

    The sets lie in buckets by node and stay there; only those of pairs travel. A node of many
    pairs meets its partners in as many parts as there are shuffle partitions.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)))
    left = pairs.select("u", "part").distinct().join(
        sets.select(F.col("node").alias("u"), F.col("shingles").alias("left_set")), "u"
    )
    right = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("right_set")), "v")
    return right.join(left, ["u", "part"]).select("u", "v", "left_set", "right_set").mapInArrow(
        lean(_similar(percent)), "u long, v long"
    )


def _band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * BAND)))
    return np.array(starts)


def _counted(batches):
    """How many shingles fall in each counter."""
    for batch in batches:
        values = np.frombuffer(b"".join(column_bytes(batch.column("shingles"))), np.uint64)
        slots, n = np.unique(values % np.uint64(SLOTS), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(n)], names=["slot", "n"])


def rarest_first(values: np.ndarray, counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set's shingles in the order that all sets share, and their counters."""
    counts = counters[(values % np.uint64(SLOTS)).astype(np.int64)]
    order = np.lexsort((values, counts))
    return values[order], counts[order]


def files_of(values: np.ndarray, counters: np.ndarray, percent: int, starts: np.ndarray):
    """The files of a set, the place of their shingle in it, and the set's side in them.

    Shingles counted once meet nobody. In a file of two bands, sets of the lower one (side 1) meet
    those of the upper one (side 2) only; a file of a single band has side 0.
    """
    n = len(values)
    values, counts = rarest_first(values, counters)
    band = int(np.searchsorted(starts, n, "right")) - 1
    least, most = -(-percent * n // 100), 100 * n // percent
    keys, places, sides = [], [], []
    other = int(np.searchsorted(starts, least, "right")) - 1
    while starts[other] <= most:
        shared = -(-percent * (n + max(least, int(starts[other]))) // (100 + percent))
        place = np.flatnonzero(counts[: n - shared + 1] > 1)
        pair = np.uint64(min(band, other) << 20 | max(band, other))
        keys.append(mix(values[place] ^ mix(pair * _ODD[62, 0])))
        places.append(place)
        sides.append(np.full(len(place), 0 if other == band else 1 if band < other else 2))
        other += 1
    return np.concatenate(keys), np.concatenate(places), np.concatenate(sides)


def _filed(counters, percent: int):
    starts = _band_starts()

    def files(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 100):
                part = batch.slice(first, 100)
                found = [
                    files_of(np.frombuffer(s, np.uint64), counters.value, percent, starts)
                    for s in column_bytes(part.column("shingles"))
                ]
                keys, places, sides = (np.concatenate(column) for column in zip(*found))
                nodes = np.repeat(part.column("node").to_numpy(), [len(own[0]) for own in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(nodes), pa.array(places), pa.array(sides.astype(np.int32))],
                    names=["key", "node", "place", "side"],
                )

    return files


def _by_rarest(sets: DataFrame, percent: int) -> DataFrame:
    """key, node, place, side: the files of the given sets (node, shingles) in which some may meet."""
    sums = sets.select("shingles").mapInArrow(lean(_counted), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # SLOTS rows at most
    counters = np.zeros(SLOTS, np.uint32)
    counters[found.column("slot").to_numpy()] = np.minimum(found.column("n").to_numpy(), (1 << 32) - 1)
    counters = sets.sparkSession.sparkContext.broadcast(counters)
    filed = stored(sets.mapInArrow(lean(_filed(counters, percent)), "key long, node long, place long, side int"), "filed")
    crowded = filed.groupBy("key").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"), F.min("side").alias("from"), F.max("side").alias("to")
    ).filter("lo < hi AND (to = 0 OR from < to)")
    return filed.join(crowded.select("key"), "key")


def _apart(live: DataFrame, led: int) -> DataFrame:
    """Keys with several components and members that neither led nor were compared with all."""
    of_key = live.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")
    )
    return of_key.filter(f"lo < hi AND n > {led + 1}")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of ``docs``.

    Documents are linked when the intersection of their sets of distinct five-word shingles is at
    least ``percent`` hundredths of the union; with fewer words the whole sequence is the only
    shingle. The component is named by its smallest doc_id, which is kept. Without words or text
    (null too) a set is empty and linked with nothing. Rows that share a doc_id are one document;
    rows with a null doc_id are linked with nothing, have no component and are not kept. Other
    columns are left out; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(
        docs.mapInArrow(lean(_sketch), "doc_id long, n_shingles long, set_key binary, sketches array<long>"), "sketches"
    )
    # Equal sets are one node, named by the smallest document.
    classes = stored(
        rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_key").agg(
            F.min("doc_id").alias("node"), F.first("sketches").alias("sketches"), F.first("n_shingles").alias("n")
        ),
        "classes",
    )
    tables = F.array(
        *(
            F.xxhash64(F.lit(i * SKETCHES + j), F.col("sketches")[i], F.col("sketches")[SKETCHES + j])
            for i in range(SKETCHES)
            for j in range(SKETCHES)
        )
    )
    keyed = classes.select("node", F.explode(tables).alias("key"))
    crowded = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    members = stored(keyed.join(crowded.select("key"), "key"), "members")
    signature = [F.col("sketches")[2 * SKETCHES + k].alias(f"s{k}") for k in range(SIGNATURE)]
    nodes = stored(
        classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", *signature), "nodes"
    )
    wanted = nodes.select("node").distinct()
    if nodes.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)  # texts that no candidate needs do not travel
    # Dealt out by bucket, so that a task writes one bucket's file.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.withColumnRenamed("doc_id", "node").join(wanted, "node", "left_semi")
    texts = texts.repartition(parts, "node").distinct()
    sets, sets_name = bucketed(texts.mapInArrow(lean(_sets), "node long, shingles binary"), "sets", "node")

    differ = (1 - percent / 100) / 2
    most = math.ceil(BITS * differ + 4 * math.sqrt(BITS * differ * (1 - differ)))
    unequal = [f"bit_count(s{k} ^ l{k})" for k in range(SIGNATURE)]
    near = (
        f"100 * least(n, leader_n) >= {percent} * greatest(n, leader_n) "
        f"AND {' + '.join(unequal[: BITS // 64])} <= {most} "
        f"AND {100 + percent} * ({' + '.join(unequal[BITS // 64 :])}) <= {100 - percent} * (n + leader_n) "
        f"AND {100 + percent} * least(n - place, leader_n - leader_place) >= {percent} * (n + leader_n) "
        "AND (side = 0 OR side <> leader_side)"
    )
    labels = nodes.select("node", F.col("node").alias("component"))
    links = None
    led, leading, by_key = 0, 1, True
    live = members.withColumn("place", F.lit(0).cast("long")).withColumn("side", F.lit(0)).join(nodes.withColumn("component", F.col("node")), "node")
    while True:
        live = stored(live, "live")  # key, node, place, side, n, signature, component: of keys that are not done
        rank = F.row_number().over(W.partitionBy("key").orderBy("node"))
        leaders = (
            live.withColumn("rank", rank).filter(f"rank <= {leading}").filter(f"rank > {led}").select(
                "key", F.col("node").alias("leader"), F.col("component").alias("leads"),
                F.col("n").alias("leader_n"), F.col("place").alias("leader_place"), F.col("side").alias("leader_side"),
                *(F.col(f"s{k}").alias(f"l{k}") for k in range(SIGNATURE)),
            )
        )
        pairs = (
            live.join(leaders, "key").filter("component <> leads").filter(near)
            .select(F.least("leader", "node").alias("u"), F.greatest("leader", "node").alias("v")).distinct()
        )
        found = stored(_verified(stored(pairs, "pairs"), sets, percent), "found")
        if found.take(1):
            links = found if links is None else links.unionByName(found)
            parts = stored(star_components(links), "components")
            links = parts.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
            labels = stored(
                nodes.select("node").join(parts, "node", "left")
                .withColumn("component", F.coalesce("component", "node")),
                "labels",
            )
            live = live.drop("component").join(labels, "node")
        led, leading = leading, leading * LEADERS
        apart = stored(_apart(live, led).select("key"), "apart")
        if not apart.take(1):
            break
        if by_key and led >= BY_KEY:
            by_key, led, leading = False, 0, 1
            unlike = stored(live.join(apart, "key").select("node").distinct(), "unlike")
            files = stored(_by_rarest(sets.join(unlike, "node", "left_semi"), percent), "files")
            live = stored(files.join(nodes, "node").join(labels, "node"), "live")
            apart = stored(_apart(live, led).select("key"), "apart")
            if not apart.take(1):
                break
        live = live.join(apart, "key")
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {sets_name}")  # its name only

    found = classes.select("set_key", "node").join(labels.select("node", "component"), "node", "left")
    found = found.groupBy("set_key").agg(F.min(F.coalesce("component", "node")).alias("component"))
    named = rows.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.when(
        F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")
    ).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
