"""Benchmark decontamination with SimHash windows, in column expressions only.

A window of a document has as many words as a benchmark item. A window that shares
no five-word shingle with any item is similar to none, so windows are laid where a
shared shingle aligns one with an item. Every window and item gets a fingerprint of
126 bits from its weighted shingles. Fingerprints are cut into 9 blocks of 14 bits;
items are filed under every block value within 3 bits of theirs, so any window
within 35 bits of an item agrees with it in some block (36 differing bits would be
needed to change 4 in each). With few shingles the distance of fingerprints says
little, so items of few are candidates wherever a window holds one of their heaviest
shingles, without which it cannot be similar enough. Candidates are verified by the
exact weighted similarity of their shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from vocatio.llm.tables import stored

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Arrays are opened by the outer forms of explode: for the inner ones the optimizer adds a
# filter on the size of the array and computes the whole array again for it.
PART_WORDS = 100_000  # a longer item is compared in parts of this size
LANES = 21  # a 63-bit hash is summed as 21 columns of three 21-bit lanes
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 9, 14, 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
MOST_WEIGHT = 8
FEW_SHINGLES = 32  # items of at most as many, in effect, are not left to fingerprints
BROADCAST_SHINGLES = 2_000_000  # beyond it the benchmark's shingles are joined by shuffle


def _words(frame: DataFrame) -> DataFrame:
    """Replaces ``text`` by ``words``: lower-cased (A-Z) runs of other than space and x09 to x0D."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return frame.withColumn("words", F.expr(f"split({lowered}, r'[\\x20\\x09-\\x0D]+')")).drop("text").withColumn(
        "words", F.expr("filter(words, w -> w <> '')")
    )


def _shingled(frame: DataFrame) -> DataFrame:
    """Replaces ``words`` by ``n_words`` and the array ``shingles`` of hashes in text order."""
    five = ", ".join(f"words[i + {k}]" for k in range(SHINGLE_WORDS))
    hashes = (
        f"CASE WHEN size(words) >= {SHINGLE_WORDS} THEN transform(sequence(0, size(words) - {SHINGLE_WORDS}), i -> xxhash64({five})) "
        "WHEN size(words) = 0 THEN CAST(array() AS array<bigint>) ELSE array(xxhash64(size(words), array_join(words, ' '))) END"
    )
    return frame.withColumn("shingles", F.expr(hashes)).withColumn("n_words", F.size("words")).drop("words")


def _fingerprints(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, total, f0, f1 from rows (keys, h, w): weighted majority per bit of two hashes."""
    lane = (1 << 42) | (1 << 21) | 1
    sums = [
        F.sum(F.expr(f"w * (shiftrightunsigned(h{k}, {j}) & {lane}L)")).alias(f"s{k}_{j}")
        for k in (0, 1)
        for j in range(LANES)
    ]
    rows = weighted.withColumn("h0", F.expr(f"h & {(1 << 63) - 1}L")).withColumn(
        "h1", F.expr(f"xxhash64(h, 1) & {(1 << 63) - 1}L")
    )
    held = [F.array(*(F.col(f"s{k}_{j}") for j in range(LANES))).alias(f"lanes{k}") for k in (0, 1)]
    summed = rows.groupBy(*keys).agg(F.sum("w").alias("total"), *sums).select(*keys, "total", *held)
    mask = (1 << LANES) - 1
    bit = (
        "shiftleft(CAST(2 * (shiftright(lanes{k}[j], {low}) & {mask}L) > total AS bigint), {low} + j)"
    )
    bits = [
        F.expr(
            f"aggregate(sequence(0, {LANES - 1}), 0L, (a, j) -> a | "
            + " | ".join(bit.format(k=k, low=low, mask=mask) for low in (0, LANES, 2 * LANES))
            + ")"
        ).alias(f"f{k}")
        for k in (0, 1)
    ]
    return summed.select(*keys, "total", *bits)


def _blocks() -> str:
    """The 9 blocks of the 126 bits as an array of (number, value)."""
    value = []
    for b in range(BLOCKS):
        low, parts = b * BLOCK_BITS, []
        for k in (0, 1):
            first, last = max(low, 63 * k), min(low + BLOCK_BITS, 63 * (k + 1))
            if first < last:
                mask = (1 << (last - first)) - 1
                parts.append(f"shiftleft(shiftrightunsigned(f{k}, {first - 63 * k}) & {mask}L, {first - low})")
        value.append(f"named_struct('block', {b}, 'value', {' | '.join(parts)})")
    return f"array({', '.join(value)})"


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_key, item_id, part, n_words, shingles of each text of the benchmark; those without words are left out.

    ``item_key`` tells texts apart that share an item_id or have none. The last part of a long item
    also takes the rest of fewer words than a shingle. Repeated rows are one item.
    """
    texts = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    words = _words(texts.withColumn("item_key", F.xxhash64("item_id", "text")))
    last = f"(size(words) - {SHINGLE_WORDS}) DIV {PART_WORDS}"
    length = f"{PART_WORDS} + IF(p = {last}, {SHINGLE_WORDS - 1}, 0)"
    cut = (
        f"transform(sequence(0, CAST({last} AS int)), "
        f"p -> named_struct('part', p, 'words', slice(words, p * {PART_WORDS} + 1, {length})))"
    )
    parts = words.filter("size(words) > 0").select("item_key", "item_id", F.explode_outer(F.expr(cut)).alias("p"))
    return _shingled(parts.select("item_key", "item_id", "p.part", "p.words"))


def _heaviest(item_shingles: DataFrame, similarity: float) -> DataFrame:
    """item_key, part, h: the heaviest shingles of each item of few, one of which any similar window holds.

    A window without them lacks more than 1 - similarity of the item's weight. Shingles that outweigh
    the others make fewer in effect: the square of the sum of weights over the sum of their squares.
    """
    of_item = W.partitionBy("item_key", "part")
    weight = F.expr("item_tf * w")
    earlier = of_item.orderBy(F.desc("x_weight"), "h").rowsBetween(W.unboundedPreceding, -1)
    ranked = item_shingles.withColumn("x_weight", weight).select(
        "item_key", "part", "h", F.sum("x_weight").over(of_item).alias("x_total"),
        F.sum(F.expr("x_weight * x_weight")).over(of_item).alias("x_squares"),
        F.coalesce(F.sum("x_weight").over(earlier), F.lit(0)).alias("x_before"),
    )
    few = F.expr(f"CAST(x_total AS double) * x_total <= {FEW_SHINGLES} * x_squares")
    return ranked.filter(few & (F.col("x_before") <= (1 - similarity) * F.col("x_total") + 1e-6)).select("item_key", "part", "h")


def _short_items(docs: DataFrame, items: DataFrame, spread) -> DataFrame | None:
    """Where longer documents hold an item of fewer words than a shingle, word by word; None without such items."""
    short = items.filter(f"n_words < {SHINGLE_WORDS}")
    sizes = sorted(row["n_words"] for row in short.select("n_words").distinct().collect())
    if not sizes:
        return None
    sequences = ", ".join(
        f"IF(size(words) > {n}, transform(sequence(0, size(words) - {n}), "
        f"i -> named_struct('at', i, 'h', xxhash64({n}, array_join(slice(words, i + 1, {n}), ' ')))), array())"
        for n in sizes
    )
    places = _words(docs).select("key", "doc_id", F.explode_outer(F.expr(f"concat({sequences})")).alias("s"))
    asked = short.select("item_key", "part", F.col("n_words").alias("item_words"), F.col("shingles")[0].alias("h"))
    hits = places.select("key", "doc_id", "s.at", "s.h").join(spread(asked), "h")
    first = hits.groupBy("key", "doc_id", "item_key", "part").agg(
        F.min("at").alias("start_word"), F.first("item_words").alias("n_words")
    )
    return first.select(
        "key", "doc_id", "item_key", "part", "start_word", "n_words", F.lit(1.0).alias("similarity"), F.lit(0).alias("hamming")
    )


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, part, start_word, n_words, similarity, hamming: the best window of each pair.

    Shingles are of five words; a text with fewer words has its whole sequence as its only shingle,
    and an item with fewer words is found wherever a document holds that sequence.
    Shingles weigh 1 to 8, more the fewer items hold them. A document shorter than an item is one
    window. Similarity is the weighted sum of the common shingles over that of all, repetitions
    counted; ties go to the earliest window. A shingle that no item holds weighs as much as one that
    a single item holds. Texts that share an item_id, or have none, are items of their own, each
    with its rows. Null and empty texts match nothing; repeated rows and rows that share doc_id and
    text give their pairs once; pairs of rows with a null doc_id carry it. Other columns are left
    out. An empty table on either side gives no rows.
    """
    return _contaminations(docs, benchmark, similarity).drop("key")


def _contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    """``contaminations`` with the key of each document's id and text."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    items = stored(items_of(benchmark), "items")
    held = items.select("item_key", "part", "n_words", F.posexplode_outer("shingles").alias("at", "h"))
    size = items.agg(F.countDistinct("item_key").alias("items"), F.sum(F.size("shingles")).alias("n")).first()
    spread = F.broadcast if (size["n"] or 0) <= BROADCAST_SHINGLES else (lambda frame: frame)
    rare = F.floor(F.log2(F.lit(max(1, size["items"])) / F.col("items"))).cast("long") + 1
    unknown = min(MOST_WEIGHT, max(1, size["items"]).bit_length())  # as a shingle that one item holds
    weights = stored(
        held.groupBy("h").agg(F.countDistinct("item_key").alias("items"))
        .select("h", F.greatest(F.lit(1), F.least(F.lit(MOST_WEIGHT), rare)).cast("long").alias("w")),
        "weights",
    )

    # Windows: wherever a shingle of an item occurs, the span that aligns both.
    texts = _shingled(_words(docs))
    places = texts.select("key", "doc_id", "n_words", F.posexplode_outer("shingles").alias("at", "h"))
    aligned = held.select("h", F.col("at").alias("item_at"), F.col("n_words").alias("item_words")).distinct()
    hits = places.join(spread(aligned), "h")
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("item_at"), F.col("n_words") - F.col("item_words")))
    windows = stored(
        hits.select(
            "key", "doc_id", start.alias("start_word"), F.least("item_words", "n_words").alias("n_words")
        ).distinct(),
        "windows",
    )

    marked = windows.select("key", "doc_id").distinct()
    again = docs.alias("d").join(
        marked.alias("m"), (F.col("d.key") == F.col("m.key")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")), "left_semi"
    )
    again = _shingled(_words(again)).dropDuplicates(["key", "doc_id"]).withColumnRenamed("n_words", "all_words")
    same = (F.col("w.key") == F.col("t.key")) & F.col("w.doc_id").eqNullSafe(F.col("t.doc_id"))
    inside = F.expr(f"slice(t.shingles, w.start_word + 1, greatest(1, w.n_words - {SHINGLE_WORDS - 1}))")
    opened = windows.alias("w").join(again.alias("t"), same).select(
        "w.key", "w.doc_id", "w.start_word", "w.n_words", F.explode_outer(inside).alias("h")
    )
    where = ["key", "doc_id", "start_word", "n_words"]
    weighted = opened.groupBy(*where, "h").agg(F.count("*").alias("tf")).join(spread(weights), "h", "left")
    weighted = stored(
        weighted.select(*where, "h", "tf", F.coalesce("w", F.lit(unknown).cast("long")).alias("weight")),
        "window-shingles",
    )
    prints = stored(_fingerprints(weighted.withColumn("w", F.expr("tf * weight")), where), "window-prints")

    item_shingles = held.groupBy("item_key", "part", "h").agg(F.count("*").alias("item_tf")).join(weights, "h")
    item_prints = stored(
        _fingerprints(item_shingles.withColumn("w", F.expr("item_tf * w")), ["item_key", "part"]), "item-prints"
    )
    masks = f"filter(sequence(0, {(1 << BLOCK_BITS) - 1}), x -> bit_count(x) <= {BLOCK_RADIUS})"
    filed = item_prints.select(
        "item_key", "part", F.col("f0").alias("i0"), F.col("f1").alias("i1"), F.col("total").alias("item_total"),
        F.explode_outer(F.expr(_blocks())).alias("b"),
    ).select(
        "item_key", "part", "i0", "i1", "item_total", F.col("b.block").alias("block"),
        F.explode_outer(F.expr(f"transform({masks}, x -> b.value ^ CAST(x AS bigint))")).alias("value"),
    )
    asked = prints.select(*where, "total", "f0", "f1", F.explode_outer(F.expr(_blocks())).alias("b")).select(
        *where, "total", "f0", "f1", F.col("b.block").alias("block"), F.col("b.value").alias("value")
    )
    hamming = F.expr("bit_count(f0 ^ i0) + bit_count(f1 ^ i1)")
    near = (
        asked.join(filed, ["block", "value"]).withColumn("hamming", hamming).filter(F.col("hamming") <= RADIUS)
        .select(*where, "total", "item_key", "part", "item_total", "hamming").distinct()
    )

    holds = weighted.join(spread(_heaviest(item_shingles, similarity)), "h").select(*where, "item_key", "part").distinct()
    holds = holds.join(
        spread(item_prints.select("item_key", "part", F.col("f0").alias("i0"), F.col("f1").alias("i1"), F.col("total").alias("item_total"))),
        ["item_key", "part"],
    )
    holds = holds.alias("l").join(
        prints.alias("r"),
        (F.col("l.key") == F.col("r.key")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        & (F.col("l.start_word") == F.col("r.start_word")) & (F.col("l.n_words") == F.col("r.n_words")),
    ).select("l.*", "r.total", "r.f0", "r.f1").withColumn("hamming", hamming)
    near = near.unionByName(holds.select(*near.columns)).distinct()

    paired = near.alias("n").join(
        weighted.alias("s"),
        (F.col("n.key") == F.col("s.key")) & F.col("n.doc_id").eqNullSafe(F.col("s.doc_id"))
        & (F.col("n.start_word") == F.col("s.start_word")) & (F.col("n.n_words") == F.col("s.n_words")),
    ).select("n.*", "s.h", "s.tf", "s.weight")
    common = paired.join(
        item_shingles.select("item_key", "part", "h", "item_tf"), ["item_key", "part", "h"]
    ).groupBy(*where, "total", "item_key", "part", "item_total", "hamming").agg(
        F.sum(F.expr("weight * least(tf, item_tf)")).alias("both")
    )
    alike = F.col("both") / (F.col("total") + F.col("item_total") - F.col("both"))
    best = F.max(F.struct(alike.alias("similarity"), (-F.col("start_word")).alias("first"), "n_words", "hamming"))
    found = common.filter(alike >= similarity).groupBy("key", "doc_id", "item_key", "part").agg(best.alias("best"))
    found = found.select(
        "key", "doc_id", "item_key", "part", (-F.col("best.first")).alias("start_word"), "best.n_words",
        "best.similarity", "best.hamming",
    )
    short = _short_items(docs, items, spread)
    found = found if short is None else found.unionByName(short)
    names = items.select("item_key", "item_id").distinct()
    return found.join(spread(names), "item_key").select(
        "key", "doc_id", "item_id", "part", "start_word", "n_words", "similarity", "hamming"
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of documents without any window similar to a benchmark item; columns as given.

    Rows are judged by doc_id and text together, so a null doc_id is judged as well.
    """
    found = stored(_contaminations(docs, benchmark, similarity).select("key").distinct(), "contaminated")
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    return docs.withColumn("x_key", key).join(found.withColumnRenamed("key", "x_key"), "x_key", "left_anti").select(
        *docs.columns
    )
