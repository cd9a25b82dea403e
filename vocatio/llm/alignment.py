"""Cross-tokenizer alignment as a reduction of fragments.

Two tokenizers cut the same bytes into tokens. Where tokens of both end, a group closes. A
byte range of a document yields a fragment: the tokens up to its first common end (open
prefix, as earlier tokens may belong to the same group), the groups closed inside, and the
tokens after its last common end (open suffix). Two neighbouring fragments make one: the
suffix of the left and the prefix of the right close a group. That is associative, so the
fragments of a long document are made in as many tasks as it has ranges and reduced as a
tree, by FAN neighbours a round; the rest of a document never waits in one task.

Ranges are cut where both tokenizers start anew whatever stands before: in front of a single
blank or line end between two other characters. There the byte-level vocabulary opens a new
pre-token, and no piece of the other vocabulary goes on after a letter with a blank (this is
checked when it is loaded). Between two such places lies a cell, mostly one word with its
blank; workers remember the tokens of cells. A document without such places is one range.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vocatio.llm.tables import once_per_worker, stored

RANGE_CHARS = 64_000  # longer documents are cut into ranges of about this size
FAN = 16  # neighbouring fragments composed in a round
CELL_CHARS = 48  # longer cells are not remembered
KNOWN_CELLS = 250_000  # cells a worker remembers, twice over; more cost time only
MOST_BROADCAST = 1_000_000  # distinct pairs of ids, 16 bytes each; with more of them counts are shuffled

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


# --- fragments ---------------------------------------------------------------------


@dataclass
class Open:
    """Tokens of both sides in an open stretch: ids and lengths in bytes."""

    a: list[int] = field(default_factory=list)
    a_bytes: list[int] = field(default_factory=list)
    b: list[int] = field(default_factory=list)
    b_bytes: list[int] = field(default_factory=list)

    def __add__(self, other: Open) -> Open:
        return Open(
            self.a + other.a, self.a_bytes + other.a_bytes, self.b + other.b, self.b_bytes + other.b_bytes
        )


@dataclass
class Fragment:
    """What a byte range makes of a document; without a common end all is in ``prefix``."""

    prefix: Open = field(default_factory=Open)
    closed: bool = False  # whether there is a common end
    groups: str = ""  # groups closed inside, joined by ;
    n_groups: int = 0
    links: dict[int, int] = field(default_factory=dict)  # a << 32 | b: links inside closed groups
    suffix: Open = field(default_factory=Open)
    n_a: int = 0
    n_b: int = 0
    sound: bool = True  # whether the tokens' bytes were those of the text


def closed_groups(a: list[int], a_bytes: list[int], b: list[int], b_bytes: list[int]) -> tuple[list[str], list[int]]:
    """Groups and linked pairs of a stretch between common borders, in one walk over both sides."""
    groups: list[str] = []
    pairs: list[int] = []
    if not a or not b:
        return groups, pairs
    i = j = 0
    a_end, b_end, left, right = a_bytes[0], b_bytes[0], str(a[0]), str(b[0])
    while True:
        pairs.append(a[i] << 32 | b[j])
        if a_end == b_end:
            groups.append(f"{left}|{right}")
            i, j = i + 1, j + 1
            if i == len(a) or j == len(b):
                return groups, pairs
            a_end, b_end, left, right = a_end + a_bytes[i], b_end + b_bytes[j], str(a[i]), str(b[j])
        elif a_end < b_end:
            i += 1
            if i == len(a):
                return groups, pairs
            a_end, left = a_end + a_bytes[i], f"{left},{a[i]}"
        else:
            j += 1
            if j == len(b):
                return groups, pairs
            b_end, right = b_end + b_bytes[j], f"{right},{b[j]}"


def group_links(group: Open) -> dict[int, int]:
    """How often each pair of ids overlaps in a group."""
    return Counter(closed_groups(group.a, group.a_bytes, group.b, group.b_bytes)[1])


def group_text(group: Open) -> str:
    return f"{','.join(map(str, group.a))}|{','.join(map(str, group.b))}"


def _with(links: dict[int, int], more: dict[int, int]) -> dict[int, int]:
    small, large = (links, more) if len(links) < len(more) else (more, links)
    large = dict(large)
    for pair, n in small.items():
        large[pair] = large.get(pair, 0) + n
    return large


def compose_all(fragments: list[Fragment]) -> Fragment:
    """Neighbouring fragments as one."""
    found = Fragment()
    texts: list[str] = []
    for f in fragments:
        found.n_a, found.n_b, found.sound = found.n_a + f.n_a, found.n_b + f.n_b, found.sound and f.sound
        if not f.closed:
            if found.closed:
                found.suffix = found.suffix + f.prefix
            else:
                found.prefix = found.prefix + f.prefix
            continue
        if found.closed:
            middle = found.suffix + f.prefix
            if middle.a:  # empty between the last common end and the end of the document
                texts.append(group_text(middle))
                found.n_groups += 1
                found.links = _with(found.links, group_links(middle))
        else:
            found.prefix, found.closed = found.prefix + f.prefix, True
        if f.n_groups:
            texts.append(f.groups)
        found.n_groups += f.n_groups
        found.links = _with(found.links, f.links)
        found.suffix = f.suffix
    found.groups = ";".join(texts)
    return found


def compose(left: Fragment, right: Fragment) -> Fragment:
    return compose_all([left, right])


def finished(whole: Fragment) -> Fragment:
    """A document's fragment with its ends closed: its first and last byte are common borders."""
    edge = Fragment(closed=True)
    return compose_all([edge, whole, edge]) if whole.n_a or whole.n_b else whole


def fragment_of(
    a: list[int], a_bytes: list[int], b: list[int], b_bytes: list[int], ahead: int = 0
) -> Fragment:
    """The fragment of a byte range from the tokens that end in it.

    ``ahead`` is by how many bytes the first token of ``b`` starts after that of ``a``, where
    the range begins inside of tokens.
    """
    a_ends, b_ends = np.cumsum(a_bytes, dtype=np.int64), ahead + np.cumsum(b_bytes, dtype=np.int64)
    common = np.intersect1d(a_ends, b_ends)
    i = np.searchsorted(a_ends, common, "right").tolist()
    j = np.searchsorted(b_ends, common, "right").tolist()

    def part(k: int) -> Open:
        i0, j0 = (i[k - 1], j[k - 1]) if k else (0, 0)
        i1, j1 = (i[k], j[k]) if k < len(i) else (len(a), len(b))
        return Open(a[i0:i1], a_bytes[i0:i1], b[j0:j1], b_bytes[j0:j1])

    found = Fragment(part(0), bool(i), n_a=len(a), n_b=len(b))
    if i:
        inner = [part(k) for k in range(1, len(i))]
        found.groups, found.n_groups = ";".join(map(group_text, inner)), len(inner)
        for group in inner:
            for pair, n in group_links(group).items():
                found.links[pair] = found.links.get(pair, 0) + n
        found.suffix = part(len(i))
    return found


# --- tokens --------------------------------------------------------------------------


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: the other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level(path: str):
    """Ids of a text by a byte-level vocabulary, and the bytes of each id.

    Where ids follow the order of merges, as in this family, the vocabulary serves as ranks of a
    faster encoder; special tokens' strings are ordinary text either way.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    symbols = _byte_of_symbol()
    bytes_of = [b""] * (1 + max(model["vocab"].values()))
    for token, k in model["vocab"].items():
        bytes_of[k] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else b""
    if {bytes([k]) for k in range(256)} - set(bytes_of):
        raise ValueError("a byte has no token of its own, so a text may not be spelled")
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if all(model["vocab"][token] == 256 + i for i, token in enumerate(merged)):
        ranks = {spelled: k for k, spelled in enumerate(bytes_of) if spelled}
        encoder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return encoder.encode_ordinary, bytes_of
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    return (lambda text: slow.encode(text, add_special_tokens=False).ids), bytes_of


class Pair:
    """Both tokenizers of a worker, and the cells it remembers."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.first, self.a_bytes = byte_level(a_path)
        self.second = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        if any("▁" in piece.lstrip("▁") or "\n" in piece for piece in pieces):
            raise ValueError("a piece goes on beyond a blank, so texts may not be cut there")
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in enumerate(pieces)
        ]
        self.a_size, self.b_size = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.long: list[str] = []  # known for the moment only

    def tokens(self, cells: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """Ids of both sides for each cell, which starts with a blank or line end, and whether the second spells it."""
        a = map(self.first, cells)
        # The second tokenizer adds a blank of its own: before a line end it is taken off again.
        b = self.second.encode([c[1:] if c[0] == " " else c for c in cells], num_threads=1)
        found = []
        for cell, of_a, of_b in zip(cells, a, b):
            if cell[0] != " ":
                of_b = of_b[1:]
            found.append((of_a, of_b, b"".join([self.b_bytes[k] for k in of_b]) == cell.encode("utf-8", "surrogatepass")))
        return found

    def fragment(self, a: list[int], b: list[int], sound: bool) -> Fragment:
        if not sound:
            return Fragment(sound=False)
        return fragment_of(a, [self.a_size[k] for k in a], b, [self.b_size[k] for k in b])

    def learn(self, cells: set[str]) -> None:
        """Makes cells known as closed wholes: numbers of tokens and groups, groups, linked pairs, soundness.

        Cells in use outlive those that are not: a full memory becomes the older one.
        """
        if len(self.known) > KNOWN_CELLS:
            self.known, self.older = {}, self.known
        new = []
        for cell in cells.difference(self.known):
            if (held := self.older.get(cell)) is not None:
                self.known[cell] = held
            else:
                new.append(cell)
        for cell, (a, b, sound) in zip(new, self.tokens(new)):
            if not sound:
                a = b = []
            groups, pairs = closed_groups(a, [self.a_size[k] for k in a], b, [self.b_size[k] for k in b])
            self.known[cell] = (len(a), len(b), len(groups), ";".join(groups), pairs, sound)
            if len(cell) > CELL_CHARS:
                self.long.append(cell)


def cells_of(text: str) -> list[str]:
    """A blank and the text, cut where both tokenizers start anew."""
    text = " " + text
    if "\0" not in text and text[1:].replace("\n", " ").split(" ") == text.split():
        return text.replace(" ", "\0 ").replace("\n", "\0\n")[1:].split("\0")
    return _CUT.split(text)


# --- documents -------------------------------------------------------------------------

_OPEN = "struct<a:array<int>,a_bytes:array<int>,b:array<int>,b_bytes:array<int>>"
FRAGMENT = (
    f"prefix {_OPEN}, closed boolean, groups string, n_groups long, pairs array<bigint>, n_links array<int>, "
    f"suffix {_OPEN}, n_a long, n_b long, sound boolean"
)
_INTS = pa.list_(pa.int32())
_OPEN_TYPE = pa.struct([("a", _INTS), ("a_bytes", _INTS), ("b", _INTS), ("b_bytes", _INTS)])
_FIELDS = [
    ("prefix", _OPEN_TYPE), ("closed", pa.bool_()), ("groups", pa.string()), ("n_groups", pa.int64()),
    ("pairs", pa.list_(pa.int64())), ("n_links", _INTS), ("suffix", _OPEN_TYPE), ("n_a", pa.int64()),
    ("n_b", pa.int64()), ("sound", pa.bool_()),
]


def _as_row(f: Fragment) -> dict:
    return {
        "prefix": vars(f.prefix), "closed": f.closed, "groups": f.groups, "n_groups": f.n_groups,
        "pairs": list(f.links), "n_links": list(f.links.values()), "suffix": vars(f.suffix),
        "n_a": f.n_a, "n_b": f.n_b, "sound": f.sound,
    }


def _from_row(row: dict) -> Fragment:
    return Fragment(
        Open(**row["prefix"]), row["closed"], row["groups"], row["n_groups"], dict(zip(row["pairs"], row["n_links"])),
        Open(**row["suffix"]), row["n_a"], row["n_b"], row["sound"],
    )


def _ranges(batches):
    """Long texts in ranges: consecutive cells of about RANGE_CHARS characters."""
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            parts, size, no = [], 0, 0
            for cell in cells_of(text):
                parts.append(cell)
                size += len(cell)
                if size >= RANGE_CHARS:
                    yield pa.RecordBatch.from_pydict({"row": [row], "no": [no], "text": ["".join(parts)]})
                    parts, size, no = [], 0, no + 1
            if parts:
                yield pa.RecordBatch.from_pydict({"row": [row], "no": [no], "text": ["".join(parts)]})


def _range_fragments(a_path: str, b_path: str):
    schema = pa.schema([("row", pa.int64()), ("no", pa.int64()), *_FIELDS])

    def fragments(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = once_per_worker(("pair", a_path, b_path), lambda: Pair(a_path, b_path))
        for batch in batches:
            for row in batch.to_pylist():
                cells, a, b, sound = _CUT.split(row["text"]), [], [], True
                for first in range(0, len(cells), 4096):
                    for of_a, of_b, agrees in pair.tokens(cells[first : first + 4096]):
                        a += of_a
                        b += of_b
                        sound = sound and agrees
                found = {"row": row["row"], "no": row["no"], **_as_row(pair.fragment(a, b, sound))}
                yield pa.RecordBatch.from_pylist([found], schema)

    return fragments


def _composed(rows: pa.Table) -> pa.Table:
    """The fragments of up to FAN neighbours as one."""
    rows = sorted(rows.to_pylist(), key=lambda row: row["no"])
    whole = compose_all([_from_row(row) for row in rows])
    schema = pa.schema([("row", pa.int64()), ("no", pa.int64()), *_FIELDS])
    return pa.Table.from_pylist([{"row": rows[0]["row"], "no": rows[0]["no"] // FAN, **_as_row(whole)}], schema)


_WHOLE = "n_a long, n_b long, n_groups long, groups string, pairs array<bigint>, n_links array<int>"


def _closed(batches):
    """The whole documents of reduced fragments."""
    schema = pa.schema(
        [("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
         ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("n_links", _INTS)]
    )
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            whole = finished(_from_row(row)) if row["sound"] else Fragment()
            rows.append(
                {"row": row["row"], "n_a": whole.n_a, "n_b": whole.n_b, "n_groups": whole.n_groups,
                 "groups": whole.groups, "pairs": list(whole.links), "n_links": list(whole.links.values())}
            )
        yield pa.RecordBatch.from_pylist(rows, schema)


def _short(a_path: str, b_path: str):
    """Documents of one range: the groups of their cells one after another."""

    def whole(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = once_per_worker(("pair", a_path, b_path), lambda: Pair(a_path, b_path))
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [cells_of(t) if t else [] for t in part.column("text").to_pylist()]
                pair.learn(set().union(*texts))
                known, n_a, n_b, n_groups, groups, pairs, n_links, bounds = pair.known, [], [], [], [], [], [], [0]
                for cells in texts:
                    found = [known[cell] for cell in cells]
                    if not all([f[5] for f in found]):
                        found = []
                    n_a.append(sum([f[0] for f in found]))
                    n_b.append(sum([f[1] for f in found]))
                    n_groups.append(sum([f[2] for f in found]))
                    groups.append(";".join([f[3] for f in found]))
                    flat = np.array(list(chain.from_iterable([f[4] for f in found])), np.int64)
                    ids, n = np.unique(flat, return_counts=True)
                    pairs.append(ids)
                    n_links.append(n.astype(np.int32))
                    bounds.append(bounds[-1] + len(ids))
                for cell in pair.long:
                    known.pop(cell, None)
                pair.long = []
                bounds = pa.array(bounds, pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x))) for x in (pairs, n_links)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                     pa.array(n_groups, pa.int64()), pa.array(groups), *lists],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "n_links"],
                )

    return whole


def reduced(fragments: DataFrame) -> DataFrame:
    """One fragment per row number from those of its ranges, by rounds of FAN neighbours."""
    fragments = stored(fragments, "fragments")
    while fragments.filter("no > 0").take(1):
        group = F.floor(F.col("no") / FAN).alias("group")
        schema = f"row long, no long, {FRAGMENT}"
        fragments = stored(fragments.groupBy("row", group).applyInArrow(_composed, schema), "fragments")
    return fragments


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups, pairs, n_links: a row per row of ``docs``.

    The first tokenizer (byte-level) gets a blank and the text, the second (pieces) the text, to
    which it adds a blank; special tokens' strings are plain text. ``groups`` reads like
    ``a1,a2|b1;a3|b2,b3``. ``pairs`` are the distinct linked pairs of ids (a << 32 | b) and
    ``n_links`` how many occurrences of each are linked: tokens whose byte ranges overlap. Texts
    that are null, empty or whose tokens do not spell a blank and the text have no tokens: zeros,
    empty groups and pairs. Repeated rows, repeated and null ids are rows of their own; other
    columns are left out; an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.filter(F.length("text") <= RANGE_CHARS).mapInArrow(_short(a_path, b_path), f"doc_id {id_type}, {_WHOLE}")
    long = docs.filter(F.length("text") > RANGE_CHARS)
    long = stored(long.withColumn("row", F.monotonically_increasing_id()), "long-texts")
    if not long.take(1):
        return found
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = long.select("row", "text").mapInArrow(_ranges, "row long, no long, text string")
    ranges = ranges.repartition(parts, "row", "no")  # the ranges of one document go to many tasks
    fragments = ranges.mapInArrow(_range_fragments(a_path, b_path), f"row long, no long, {FRAGMENT}")
    whole = reduced(fragments).mapInArrow(_closed, f"row long, {_WHOLE}")
    return found.unionByName(long.select("row", "doc_id").join(whole, "row").drop("row"))


# --- counts over the corpus ---------------------------------------------------------------


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, documents, best: in how many rows a pair is linked, and whether no pair of its first id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = stored(counts.withColumn("a", F.shiftrightunsigned("pair", 32)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame) -> DataFrame:
    """The rows of a stored table of ``align`` with n_all (links), n_best and count_sum.

    ``n_best`` links have the highest count of their first id, ties included; ``count_sum`` adds the
    counts of all links. Counts are broadcast up to MOST_BROADCAST distinct pairs; beyond that links
    are shuffled to them.
    """
    counts = stored(pair_counts(aligned), "best-pairs")
    if counts.count() <= MOST_BROADCAST:
        counts = F.broadcast(counts)
    aligned = stored(aligned.withColumn("x_row", F.monotonically_increasing_id()), "aligned")
    opened = aligned.select("x_row", F.explode(F.arrays_zip("pairs", "n_links")).alias("link"))
    sums = (
        opened.select("x_row", F.col("link.pairs").alias("pair"), F.col("link.n_links").cast("long").alias("n"))
        .join(counts, "pair").groupBy("x_row").agg(
            F.sum("n").alias("n_all"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("documents")).alias("count_sum"),
        )
    )
    return aligned.join(sums, "x_row", "left").drop("x_row").fillna(0, ["n_all", "n_best", "count_sum"])
