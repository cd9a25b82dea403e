"""Packing by powers of two: pieces of binary length, one sequence each.

A document's ids and a closing id 0 are cut into as many pieces of the longest
length as fit and then into the binary digits of the rest. Equal lengths form a
bucket, so that no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from vocatio.llm.tables import lean, once_per_worker

KNOWN_WORDS = 300_000  # words whose ids a worker remembers, twice over; more cost time only

_MARKS = "!#$%&*+,./:;=?@~"


class WordIds:
    """Ids of whole texts as little-endian 32-bit bytes, remembered by word.

    A blank or line end between two other characters always opens a new pre-token of the byte-level
    vocabulary, so a text may be cut before it. Texts with other white space, or several in a row,
    and those with the string of a special token are encoded whole. Words in use outlive those that
    are not: a full memory becomes the older one.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # A special token between words keeps them apart within one string.
        self.joined = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self.joined.get_added_tokens_decoder().items() if t.special]
        self.mark_id, self.mark = special[0]
        self.special = [content for _, content in special]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, words: list[str]) -> list[bytes]:
        mark = self.mark
        groups = [words[k : k + 512] for k in range(0, len(words), 512)]
        found = self.joined.encode_batch_fast([mark.join(group) for group in groups], add_special_tokens=False)
        cut = []
        for group, encoded in zip(groups, found):
            ids = np.array(encoded.ids, "<u4")
            data, at = ids.tobytes(), np.flatnonzero(ids == self.mark_id)
            if len(at) != len(group) - 1:  # a word holds the mark itself
                cut += map(self.whole, group)
                continue
            starts = [0, *(4 * at + 4).tolist()]
            ends = [*(4 * at).tolist(), len(data)]
            cut += [data[a:b] for a, b in zip(starts, ends)]
        return cut

    def learn(self, words: set[str]) -> None:
        """Make the ids of these words known."""
        new = []
        for word in words.difference(self.known):
            if (ids := self.older.get(word)) is not None:
                self.known[word] = ids
            else:
                new.append(word)
        self.known.update(zip(new, self.encode(new)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            if "\0" in text or any(s in text for s in self.special) or text.replace("\n", " ").split(" ") != text.split():
                cut.append([text])
            else:
                cut.append(text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0"))
        if len(self.known) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        known = self.known
        new = set().union(*cut).difference(known)
        # Marks after a letter or digit at the end of a word are a pre-token of their own.
        ending = {}
        for word in new:
            core = word.rstrip(_MARKS)
            if core is not word and core and core[-1].isalnum():
                ending[word] = core
        self.learn({*new.difference(ending), *ending.values(), *(w[len(c) :] for w, c in ending.items())})
        for word, core in ending.items():
            known[word] = known[core] + known[word[len(core) :]]
        return [b"".join(map(known.__getitem__, words)) for words in cut]


def cuts(n: int, longest: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens."""
    whole, rest = divmod(n, longest)
    found, at = [(i * longest, longest) for i in range(whole)], whole * longest
    for bit in reversed(range(longest.bit_length())):
        if rest >> bit & 1:
            found.append((at, 1 << bit))
            at += 1 << bit
    return found


def pack(
    docs: DataFrame, tokenizer: str, longest: int = 1024, with_ids: bool = True, special_as_text: bool = False
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, bucket,
    sequence_id, offset and, if asked for, ids.

    ``longest`` is a power of two. The string of a special token in a text becomes its id, as the
    tokenizer does by itself, or ordinary text with ``special_as_text``. A null or empty text has the closing id only. Every row is a
    document, repeated ids and rows too; a null id stays null. Other columns are left out. An
    empty table gives no pieces. Sequence ids follow the order of the input's partitions.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    id_type = docs.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", id_type),
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")),
        T.StructField("bucket", T.IntegerType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def pieces(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of = once_per_worker(
            ("ids", tokenizer, special_as_text), lambda: WordIds(tokenizer, special_as_text)
        )
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows, values, bounds = [], [], [0]
                texts = [t or "" for t in part.column("text").to_pylist()]
                for i, found in enumerate(ids_of(texts)):
                    found += b"\0\0\0\0"
                    for at, n in cuts(len(found) // 4, longest):
                        piece = found[4 * at : 4 * (at + n)]
                        crc = zlib.crc32(piece)
                        rows.append((i, at, n, crc, len(found) // 4, n.bit_length() - 1))
                        if with_ids:
                            values.append(piece)
                            bounds.append(bounds[-1] + n)
                table = np.array(rows, np.int64).reshape(-1, 6)
                arrays = [part.column("doc_id").take(pa.array(table[:, 0]))]
                arrays += [pa.array(table[:, k]) for k in range(1, 5)]
                arrays.append(pa.array(table[:, 5].astype(np.int32)))
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(values), "<i4"))
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.array(bounds, np.int32)), flat))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    found = docs.select("doc_id", "text").mapInArrow(lean(pieces), T.StructType(fields))
    return found.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long")
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder of equal-length sequences per bucket."""
    pieces.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
