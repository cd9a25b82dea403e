"""WARC archives: segmented records written and put together again.

Writing: an HTTP response with chunked transfer framing per page; a payload seen
before becomes a revisit record. A block beyond the segment size is cut; its
continuation records go to a second archive of the task. Reading: continuation
records are grouped by their origin, ordered by segment number, checked against
the total length, and only then parsed and unframed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from vocatio.llm.tables import stored
from vocatio.sources.folders import fresh_folder

SEGMENT_BYTES = 32 << 10
ARCHIVE_BYTES = 8 << 20  # compressed; a new archive is begun beyond it
CHUNK_BYTES = 4096

RECORD = (
    "record_id string, origin_id string, page_id long, record_type string, refers_to long, digest string, "
    "segment int, total_length long, block binary, payload_bytes long, payload_digest string"
)


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes) -> bytes:
    """Chunked transfer framing."""
    out = []
    for at in range(0, len(payload), CHUNK_BYTES):
        chunk = payload[at : at + CHUNK_BYTES]
        out.append(b"%x\r\n%s\r\n" % (len(chunk), chunk))
    return b"".join(out) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes:
    """The payload of a chunked body; broken framing is an error."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    if b"\r\ntransfer-encoding: chunked" in head.lower():
        return unframed(body)
    return body


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*headers, ("Content-Length", len(block))]]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def records_of(archive) -> "iterator":
    """Headers (lower-case names) and block of each record of an open, uncompressed stream."""
    while line := archive.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no record where one should begin")
        headers = {}
        while (line := archive.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = archive.read(size)
        if len(block) < size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def one_line(value) -> str:
    return "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in value or "")


class _Archive:
    """One growing archive of a task, published under its final name when complete."""

    def __init__(self, files, folder: str, name: str):
        self.files, self.folder, self.name, self.count = files, folder, name, 0
        self.parts: list[bytes] = []
        self.size = 0

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, 1, mtime=0)
        self.parts.append(member)
        self.size += len(member)
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.parts:
            made = f"{self.folder}/.{uuid.uuid4().hex}"
            with self.files.open_output_stream(made) as out:
                for part in self.parts:
                    out.write(part)
            self.files.move(made, f"{self.folder}/{self.name}-{self.count:04d}.warc.gz")
            self.count, self.parts, self.size = self.count + 1, [], 0


def write_archives(pages: DataFrame, folder: str, least: int = 0, segment: int = SEGMENT_BYTES) -> int:
    """Write a record per page; returns how many. ``folder`` is an URI all executors reach.

    Of pages with equal payloads of at least ``least`` bytes, the smallest page_id is a response
    and the others revisit it; rows that repeat that page_id are responses too, as are rows
    without page_id whose payload has no id at all. Null html is an empty payload; a null url is
    an empty target. Other columns are left out; an empty table writes nothing. File names follow
    the partition, so a repeated task replaces its own archives.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"),
        (F.octet_length(html) >= least).alias("shared"),
    )
    # Only payloads that occur under several ids are joined; the ids are all that is shuffled for them.
    firsts = (
        rows.filter("shared").groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("sha", "first", F.lit(True).alias("shared"))
    )
    firsts = stored(firsts, "warc-firsts")
    rows = rows.join(firsts, ["sha", "shared"], "left").select("page_id", "url", "html", "first")

    def write(batches):
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        files.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        heads = _Archive(files, base, f"pages-{part:05d}")
        tails = _Archive(files, base, f"continued-{part:05d}")
        written = 0
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                for row in batch.slice(first, 64).to_pylist():
                    written += 1
                    _write_page(row, f"{part}-{written}", segment, heads, tails)
        heads.close()
        tails.close()
        yield pa.RecordBatch.from_pydict({"written": [written]})

    done = rows.mapInArrow(write, "written long").agg(F.sum("written").alias("n")).first()
    return done["n"] or 0


def _write_page(row: dict, number: str, segment: int, heads: _Archive, tails: _Archive) -> None:
    payload = (row["html"] or "").encode()
    own, first = row["page_id"], row["first"]
    name = f"<urn:page:{number}>"
    common = [("WARC-Record-ID", name), ("WARC-Target-URI", one_line(row["url"]))]
    if own is not None:
        common.append(("X-Page-ID", own))
    common.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if first is not None and own != first:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        heads.add(record([("WARC-Type", "revisit"), *common, ("WARC-Profile", profile), ("X-Refers-To-Page", first)], head))
        return
    block = head + framed(payload)
    if len(block) <= segment:
        heads.add(record([("WARC-Type", "response"), *common], block))
        return
    heads.add(record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], block[:segment]))
    starts = range(segment, len(block), segment)
    for k, at in enumerate(starts, 2):
        more = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{number}:{k}>"),
            ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", k),
        ]
        if at == starts[-1]:
            more.append(("WARC-Segment-Total-Length", len(block)))
        tails.add(record(more, block[at : at + segment]))


def _parsed(batches):
    """A row per record; complete records already unframed, segments with their block."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    schema = pa.schema(
        [("record_id", pa.string()), ("origin_id", pa.string()), ("page_id", pa.int64()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()),
         ("segment", pa.int32()), ("total_length", pa.int64()), ("block", pa.binary()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            with gzip.open(io.BytesIO(content.as_buffer())) as archive:
                for headers, block in records_of(archive):
                    row = dict.fromkeys(names)
                    kind, cut = headers["warc-type"], headers.get("warc-segment-number")
                    row["record_id"] = headers["warc-record-id"]
                    row["origin_id"] = headers.get("warc-segment-origin-id", headers["warc-record-id"])
                    row["page_id"] = int(headers["x-page-id"]) if "x-page-id" in headers else None
                    row["record_type"] = kind
                    if "x-refers-to-page" in headers:
                        row["refers_to"] = int(headers["x-refers-to-page"])
                    row["digest"] = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if cut is not None:
                        row["segment"], row["block"] = int(cut), block
                        if "warc-segment-total-length" in headers:
                            row["total_length"] = int(headers["warc-segment-total-length"])
                        held += len(block)
                    elif kind == "response":
                        payload = http_payload(block)
                        row["payload_bytes"], row["payload_digest"] = len(payload), payload_digest(payload)
                    rows.append(row)
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def _reassembled(batches):
    """Rows sorted by origin and segment become one row per origin."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("complete", pa.bool_())]
    )
    keep = schema.names[:-1]

    def whole(origin, parts):
        row = {name: origin[name] for name in keep}
        numbers = [p["segment"] for p in parts]
        block = b"".join(p["block"] for p in parts)
        total = parts[-1]["total_length"]
        row["complete"] = numbers == list(range(1, len(parts) + 1)) and total == len(block)
        if row["complete"]:
            payload = http_payload(block)
            row["payload_bytes"], row["payload_digest"] = len(payload), payload_digest(payload)
        return row

    parts: list[dict] = []
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            rows = []
            for row in batch.slice(first, 256).to_pylist():
                if parts and row["origin_id"] != parts[0]["origin_id"]:
                    rows.append(whole(parts[0], parts))
                    parts = []
                if row["segment"] is None:
                    rows.append({name: row[name] for name in keep} | {"complete": True})
                else:
                    parts.append(row)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
    if parts:
        yield pa.RecordBatch.from_pylist([whole(parts[0], parts)], schema)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, complete: a row per origin record.

    A record with missing segments, a gap or another total length than its last segment says is
    returned with ``complete`` false and no payload. Revisits carry the payload figures of the
    response they refer to. A folder without archives gives no rows.
    """
    held = "page_id long, record_type string, refers_to long, digest string, payload_bytes long, payload_digest string, complete boolean"
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    records = archives.select("content").mapInArrow(_parsed, RECORD)
    whole = (
        records.repartition("origin_id").sortWithinPartitions("origin_id", "segment").mapInArrow(_reassembled, held)
    )
    whole = stored(whole, "warc-records")
    responses = (
        whole.filter("record_type = 'response' AND page_id IS NOT NULL")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest"))
        .agg(F.max("payload_bytes").alias("referred_bytes"))
    )
    found = whole.join(responses, ["refers_to", "digest"], "left")
    revisit = F.col("record_type") == "revisit"
    return found.select(
        "page_id",
        F.when(revisit, F.col("referred_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to",
        (F.col("complete") & F.when(revisit, F.col("referred_bytes").isNotNull()).otherwise(True)).alias("complete"),
    )


def round_trip(pages: DataFrame, least: int = 0, segment: int = SEGMENT_BYTES) -> DataFrame:
    """All pages as archives in the shared folder, read back."""
    folder = fresh_folder(pages.sparkSession, "warc")
    if not write_archives(pages, folder, least, segment):
        return pages.sparkSession.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, complete boolean"
        )
    return read_archives(pages.sparkSession, folder)
