"""Lempel-Ziv phrase fingerprints.

A text is parsed into the shortest phrases not yet in its dictionary. The hashes of
the phrases fall into PLACES bins, and the least of each bin makes the signature, a
one-permutation minimum hash. The share of equal bins estimates how many phrases two
texts have in common, as a compressor would notice it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vocatio.llm.words import _powers, mix
from vocatio.llm.tables import once_per_worker

PLACES = 64
EMPTY = 0xFFFF
_BASE = 0xA24BAED4963EE407


def parse(text: str, known: set[str], at: int, ends: list[int]) -> bool:
    """Continue the parse from ``at``; adds phrases to ``known`` and their ends to ``ends``.

    All beginnings of a known phrase are known, so the first unknown length is found by stepping
    from the length of the last phrase. A rest that is known closes the text; the result tells
    whether the last phrase was new.
    """
    n, length = len(text), 2
    while at < n:
        length = min(length, n - at)
        if text[at : at + length] in known:
            while text[at : at + length] in known:
                length += 1
                if at + length > n:
                    ends.append(n)
                    return False
        else:
            while length > 1 and text[at : at + length - 1] not in known:
                length -= 1
        known.add(text[at : at + length])
        at += length
        ends.append(at)
    return True


def _raised(size: int):
    rounded = 1 << max(16, size.bit_length())
    if rounded > 1 << 22:
        return _powers(_BASE, rounded), _powers(pow(_BASE, -1, 1 << 64), rounded)
    return once_per_worker(
        ("phrase powers", rounded), lambda: (_powers(_BASE, rounded), _powers(pow(_BASE, -1, 1 << 64), rounded))
    )


def signature(text: str, ends: list[int]) -> np.ndarray:
    """Least hash per bin over the phrases that end at ``ends``."""
    found = np.full(PLACES, EMPTY, np.uint16)
    if not ends:
        return found
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    powers, inverse = _raised(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)], out=sums[1:])
    last = np.array(ends)
    first = np.concatenate(([0], last[:-1]))
    hashes = mix((sums[last] - sums[first]) * inverse[first] ^ (last - first).astype(np.uint64) << np.uint64(48))
    place = (hashes >> np.uint64(58)).astype(np.int64)
    value = ((hashes >> np.uint64(40)) % np.uint64(EMPTY)).astype(np.uint16)
    order = np.argsort(value, kind="stable")[::-1]
    found[place[order]] = value[order]  # the least is written last
    return found


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those that either text fills; 1 for two empty texts."""
    used = (a != EMPTY) | (b != EMPTY)
    return float((a[used] == b[used]).mean()) if used.any() else 1.0


def as_text(found: np.ndarray) -> str:
    return found.astype(">u2").tobytes().hex()


def both_signatures(text: str, following: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The edited text, and the signatures of the text and of the edited text.

    Both are parsed together as far as they agree.
    """
    half = len(text) // 2
    keep = len(text) - half
    edited = text[:keep] + following[:half]
    known: set[str] = set()
    ends: list[int] = []
    # Phrases of the kept part: parse it alone and drop its last phrase, which may go on.
    new = parse(text[:keep], known, 0, ends)
    if ends:
        last = ends.pop()
        if new:
            known.discard(text[ends[-1] if ends else 0 : last])
    begun = ends[-1] if ends else 0
    ends_of_edited = list(ends)
    known_of_edited = known.copy()
    parse(text, known, begun, ends)
    parse(edited, known_of_edited, begun, ends_of_edited)
    return edited, signature(text, ends), signature(edited, ends_of_edited)


def fingerprint(text: str | None) -> str:
    text = text or ""
    ends: list[int] = []
    parse(text, set(), 0, ends)
    return as_text(signature(text, ends))


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(batches):
    """Rows sorted by range; each is compared with the one after it, the last with the next range's first."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    rows: list[dict] = []
    waiting = None  # the row before, and what its own next neighbour makes of it
    held = None  # a finished row but for the likeness to this one

    def finish(before, after_text):
        edited, own, changed = both_signatures(before["text"], after_text)
        row = {
            "doc_id": before["doc_id"], "n_chars": len(before["text"]),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": as_text(own), "edited_fingerprint": as_text(changed), "near_edited": likeness(own, changed),
        }
        return row, own

    for batch in batches:
        for first in range(0, batch.num_rows, 128):
            for row in batch.slice(first, 128).to_pylist():
                row["text"] = row["text"] or ""
                if waiting is not None and waiting["range_no"] == row["range_no"]:
                    done, own = finish(waiting, row["text"])
                    if held is not None:
                        held[0]["near_next"] = likeness(held[1], own)
                        rows.append(held[0])
                    held = (done, own)
                    if row["ahead"]:
                        ends: list[int] = []
                        parse(row["text"], set(), 0, ends)
                        held[0]["near_next"] = likeness(own, signature(row["text"], ends))
                        rows.append(held[0])
                        held = waiting = None
                        continue
                if row["ahead"]:  # more copies of the next range's first row
                    continue
                waiting = row
            if len(rows) >= 500:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _range_number(splits: list[int]) -> str:
    """Number of splits up to the doc_id, by blocks of 64; null ids come first."""
    as_array = lambda values: f"array({', '.join(f'{v}L' for v in values)})" if values else "CAST(array() AS array<bigint>)"
    coarse = f"size(filter({as_array(splits[63::64])}, x -> x <= doc_id))"
    if len(splits) < 64:
        return f"coalesce(size(filter({as_array(splits)}, x -> x <= doc_id)), 0)"
    fine = f"size(filter(slice({as_array(splits)}, 64 * {coarse} + 1, 64), x -> x <= doc_id))"
    return f"IF(doc_id IS NULL, 0, 64 * {coarse} + {fine})"


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to both neighbours.

    The next document is that of the next doc_id (null ids first, equal ids by text), after the
    last the first; a single document is its own next. The edited text has the last half of the
    code points replaced by as many first ones of the next document. Null is an empty text.
    Every row is returned; other columns are left out; an empty table gives no rows.

    Documents are shuffled once, by ranges of doc_id; only the first one of a range also goes to
    the range before it, so the order needs no single task.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * partitions
    shares = [k / ranges for k in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("p")).first()["p"]
    number = _range_number(sorted(set(found or [])))
    firsts = (
        docs.select("doc_id", F.expr(number).alias("range_no")).groupBy("range_no")
        .agg(F.min("doc_id").alias("first"), (F.count("*") > F.count("doc_id")).alias("nulls"))
        .orderBy("range_no").collect()
    )
    if not firsts:
        return spark.createDataFrame([], OUT)
    size = firsts[-1]["range_no"] + 1
    first_of, before = ["NULL"] * size, ["0"] * size
    for k, row in enumerate(firsts):
        first_of[row["range_no"]] = "NULL" if row["nulls"] else f"{row['first']}L"
        before[row["range_no"]] = str(firsts[k - 1]["range_no"])
    own = docs.withColumn("own", F.expr(number))
    leads = f"element_at(CAST(array({', '.join(first_of)}) AS array<bigint>), own + 1)"
    goes = (
        f"IF(doc_id <=> {leads}, array(struct(own AS range_no, false AS ahead), "
        f"struct(element_at(array({', '.join(before)}), own + 1) AS range_no, true AS ahead)), "
        "array(struct(own AS range_no, false AS ahead)))"
    )
    placed = own.select("doc_id", "text", F.explode_outer(F.expr(goes)).alias("to")).select(
        "doc_id", "text", "to.range_no", "to.ahead"
    )
    return (
        placed.repartition(partitions, "range_no")
        .sortWithinPartitions("range_no", "ahead", "doc_id", "text").mapInArrow(_compared, OUT)
    )
