"""Records of quoted CSV files, read by many tasks per file.

A quoted cell may hold line breaks, so a line of such a file need not be a record. Files are
read as lines, which Spark splits anywhere. Whether a byte range begins inside a quoted cell
depends on all ranges before it, but what it does is a map from one state to another: a first
pass finds, for each range, the state at its end for both states at its beginning, and the
composition of these maps settles where every range begins. A second pass then cuts each
range into records alone. Records that cross a border come as pieces, a few per range, which
are put together by their order.

A quote opens a cell only at the cell's beginning, and a doubled quote stays inside, so stray
quotes within a plain cell do no harm. Line ends are ``\\n`` or ``\\r\\n``; inside cells they
are kept.
"""

from __future__ import annotations

import csv
import io
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vocatio.sources.datasets import size_on_disk

TASKS_PER_CORE = 4
TASK_BYTES = 16 << 20  # of byte ranges that one task reads, if they are smaller

# Cells: quoted with whatever follows up to the delimiter, plain, or empty. Quantifiers are
# possessive, so a doubled quote is never read as an end.
_QUOTED_REST = rb'(?:[^"]++|"")*+"[^,]*+'
_CELL = rb'(?>"' + _QUOTED_REST + rb'|[^",][^,]*+|)'
_WHOLE = re.compile(_CELL + rb"(?:," + _CELL + rb")*+\Z")
_CLOSING = re.compile(_QUOTED_REST + rb"(?:," + _CELL + rb")*+\Z")


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open after a line (without its line end)."""
    if b'"' not in line:
        return inside
    return not (_CLOSING if inside else _WHOLE).match(line)


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, block, line: the lines of the files where they lie; a block is a byte range by its start.

    Where ranges are small a task takes several, one after another: tasks number as the bytes ask
    for, not as the ranges do.
    """
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    cores = spark.sparkContext.defaultParallelism
    return lines.coalesce(max(TASKS_PER_CORE * cores, math.ceil(size_on_disk(spark, files) / TASK_BYTES)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """The lines of a task by block, in order."""

    def rows():
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("file", "block", "line"))
            yield from zip(*columns)

    stream = rows()
    held = next(stream, None)
    while held is not None:
        file, block = held[:2]

        def lines():
            nonlocal held
            while held is not None and held[:2] == (file, block):
                yield held[2]
                held = next(stream, None)

        yield file, block, lines()


_MAP = "file string, block long, after_outside boolean, after_inside boolean, header binary"


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, the state at its end for both at its beginning; of a first block also the first record."""
    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("after_outside", pa.bool_()),
         ("after_inside", pa.bool_()), ("header", pa.binary())]
    )
    for file, block, lines in _blocks(batches):
        outside, inside, header, open_header = False, True, [], block == 0
        for line in lines:
            if outside == inside:
                outside = inside = ends_inside(line, outside)
            else:
                outside, inside = ends_inside(line, outside), ends_inside(line, inside)
            if open_header:
                header.append(line)
                open_header = outside or not line.strip(b"\r\xef\xbb\xbf")
                header = header if any(header) else []
        # A header that goes on beyond its byte range counts as missing.
        first = b"\n".join(header) if block == 0 and not open_header else None
        yield pa.RecordBatch.from_pylist(
            [{"file": file, "block": block, "after_outside": outside, "after_inside": inside, "header": first}], schema
        )


def safe_names(record: bytes) -> list[str]:
    """Column names of a header record; empty ones are numbered, repeated ones too."""
    text = record.decode("utf-8").removeprefix("﻿").rstrip("\r")
    names = next(csv.reader(io.StringIO(text, newline="")), [])
    folded = [name.lower() for name in names]
    return [
        f"_c{i}" if not name else f"{name}{i}" if folded.count(name.lower()) > 1 else name
        for i, name in enumerate(names)
    ]


class Layout:
    """Headers of files, and the blocks that begin inside a quoted cell."""

    def __init__(self, headers: dict[str, tuple[str, ...]], inside: dict[tuple[str, int], bool]):
        self.headers, self.inside = headers, inside


def layout_of(spark: SparkSession, files: list[str]) -> Layout:
    """One distributed pass over the files, whatever their number.

    What comes back is one small row per byte range, as many as the scan has splits.
    """
    rows = _lines(spark, files).mapInArrow(_state_maps, _MAP).collect()
    headers: dict[str, tuple[str, ...]] = {}
    inside: dict[tuple[str, int], bool] = {}
    state: dict[str, bool] = {}
    for row in sorted(rows, key=lambda r: (r["file"], r["block"])):
        begins = state.get(row["file"], False)
        inside[row["file"], row["block"]] = begins
        state[row["file"]] = row["after_inside"] if begins else row["after_outside"]
        if row["header"] is not None:
            headers[row["file"]] = tuple(safe_names(row["header"]))
    headless = sorted(file for file in state if not headers.get(file))
    if headless:
        raise ValueError(f"no header in {headless[:5]}")
    unclosed = sorted(file for file, open_cell in state.items() if open_cell)
    if unclosed:
        raise ValueError(f"a quoted cell is not closed at the end of {unclosed[:5]}")
    return Layout(headers, inside)


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """Headers of files whose lines are records, by one scan."""
    lines = _lines(spark, files).withColumn("at", F.monotonically_increasing_id())
    opening = lines.where((F.col("block") == 0) & (F.trim(F.col("line").cast("string"), F.lit("\r ")) != ""))
    rows = opening.groupBy("file").agg(F.min_by("line", "at").alias("header")).orderBy("file").collect()
    found = {row["file"]: tuple(safe_names(row["header"])) for row in rows}
    if len(found) < len(files):
        raise ValueError(f"no header in {len(files) - len(found)} of the files")
    return found


_RECORD = "file string, block long, pos long, part int, record binary"
WHOLE, TAIL, THROUGH, HEAD = 0, 1, 2, 3


def _starts(inside: dict[tuple[str, int], bool]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per file the sorted beginnings of its blocks and whether they are inside: it goes to every task."""
    of_file: dict[str, list[tuple[int, bool]]] = {}
    for (file, block), begins in sorted(inside.items()):
        of_file.setdefault(file, []).append((block, begins))
    return {
        file: (np.array([block for block, _ in rows], np.int64), np.array([begins for _, begins in rows], bool))
        for file, rows in of_file.items()
    }


def _cut(inside: dict[tuple[str, int], bool]):
    """Cuts blocks into records; ``part`` tells whole ones from the pieces of those that cross a border."""
    known = _starts(inside)
    schema = pa.schema(
        [("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("part", pa.int32()), ("record", pa.binary())]
    )

    def rows(file: str, block: int, lines: Iterator[bytes]):
        starts, begins = known.get(file, (np.empty(0, np.int64), None))
        at = int(np.searchsorted(starts, block))
        if at == len(starts) or starts[at] != block:
            raise ValueError(f"{file} was split otherwise in the first pass; read it again")
        open_cell = bool(begins[at])
        part, held, pos = (HEAD if open_cell else WHOLE), [], 0
        for line in lines:
            held.append(line)
            open_cell = ends_inside(line, open_cell)
            if not open_cell:
                record = b"\n".join(held).rstrip(b"\r")
                if record or part == HEAD:  # empty lines between records are no records
                    yield file, block, pos, part, record
                    pos += 1
                part, held = WHOLE, []
        if held:
            yield file, block, pos, (THROUGH if part == HEAD else TAIL), b"\n".join(held)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for file, block, lines in _blocks(batches):
            for row in rows(file, block, lines):
                found.append(row)
                size += len(row[4])
                if size > 1 << 22 or len(found) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                    found, size = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return records


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from their pieces: every tail opens one, and the next head closes it."""
    order = Window.partitionBy("file").orderBy("block", "pos")
    opened = pieces.withColumn("record_no", F.sum((F.col("part") == TAIL).cast("int")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("block", "pos", "record")))
    whole = opened.groupBy("file", "record_no").agg(ordered.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["record"].cast("string")), "\n")
    first = F.col("pieces")[0]
    return whole.select("file", first["block"].alias("block"), first["pos"].alias("pos"), text.alias("record"))


def read_records(spark: SparkSession, files: list[str], layout: Layout) -> DataFrame:
    """file, block, pos, record: every record but the headers, as text.

    A record belongs to the block in which it begins; ``pos`` orders the records of a block. Both
    passes must list the files alike, as that decides how they are split.
    """
    cut = _lines(spark, files).mapInArrow(_cut(layout.inside), _RECORD)
    whole = cut.where(F.col("part") == WHOLE).select(
        "file", "block", "pos", F.col("record").cast("string").alias("record")
    )
    crossing = any(layout.inside.values())
    found = whole.unionByName(_joined(cut.where(F.col("part") != WHOLE))) if crossing else whole
    return found.where((F.col("block") != 0) | (F.col("pos") != 0))


def parsed(record: Column, names: list[str], options: dict[str, str]) -> Column:
    """The cells of a record as a struct of text columns."""
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    return F.from_csv(record, schema, options)
