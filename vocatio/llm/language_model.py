"""Scoring by a bigram model held in Elias-Fano tries, one per group of words.

The model is a unigram with one added to every count, smoothed into bigrams with a
Dirichlet prior of MASS: p(w|h) = (c(h,w) + MASS p(w)) / (c(h) + MASS). Its logarithm
is a sum of one part that only the word's group knows and one that only the
context's group knows. So every token goes to the group of its word once, for
learning and scoring alike, and a document's score is the sum of what the groups
send back. No group holds more than its share: a word with many tokens is dealt out
over the groups by its contexts, its count being known from a first pass.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from vocatio.llm.elias_fano import CONTEXT_BITS, STEP, BigramTrie, quantised
from vocatio.llm.tables import id_remainder, stored
from vocatio.llm.words import document_words, mix

MASS = 1000.0
END = np.uint64(0x9AE16A3B2F90404F)  # the closing token
START = np.uint64(0xC3A5C85C97CB3127)  # the context of a first word
GROUP_TOKENS = 800_000
BLOCK_TOKENS = 2_000_000
FIXED = 1 << 32  # base scores are summed in whole numbers of this fraction


def _blocks_of(batches, columns: list[str]):
    """Word arrays and the given columns of consecutive rows, BLOCK_TOKENS together."""
    words, kept, size = [], [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column("text")]
            words += list(document_words(texts))
            kept.append([part.column(c) for c in columns])
            size += sum(map(len, words[-len(texts) :])) + len(texts)
            if size >= BLOCK_TOKENS:
                yield words, [pa.concat_arrays([k[i] for k in kept]) for i in range(len(columns))]
                words, kept, size = [], [], 0
    if words:
        yield words, [pa.concat_arrays([k[i] for k in kept]) for i in range(len(columns))]


def _counted(batches):
    for words, _ in _blocks_of(batches, []):
        found, counts = np.unique(np.concatenate(words), return_counts=True)
        found = np.append(found, END).view(np.int64)
        counts = np.append(counts, len(words))
        for first in range(0, len(found), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[first : first + (1 << 16)]), pa.array(counts[first : first + (1 << 16)])], names=["word", "c"]
            )


def _packed(values: np.ndarray) -> bytes:
    """A rising or falling array of whole numbers in the fewest bytes that hold it."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _join(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(data) -> list[memoryview]:
    found, at, view = [], 0, memoryview(data)
    while at < len(view):
        size = int.from_bytes(view[at : at + 4], "little")
        found.append(view[at + 4 : at + 4 + size])
        at += 4 + size
    return found


def _unpacked(data) -> np.ndarray:
    return np.frombuffer(data[1:], f"u{data[0]}")


def _sent(words: np.ndarray, contexts: np.ndarray, docs: np.ndarray) -> bytes:
    """Tokens of one block and group as sorted runs: word, its contexts, their documents."""
    order = np.lexsort((docs, contexts, words))
    words, contexts, docs = words[order], contexts[order], docs[order]
    new_word = np.append(True, words[1:] != words[:-1])
    new_pair = new_word.copy()
    new_pair[1:] |= contexts[1:] != contexts[:-1]
    at_word, at_pair = np.flatnonzero(new_word), np.flatnonzero(new_pair)
    pair_word = np.cumsum(new_word[at_pair]) - 1
    low = contexts[at_pair]
    return _join(
        [
            words[at_word].tobytes(),
            _packed(np.bincount(pair_word, minlength=len(at_word))),
            low.astype("<u4").tobytes(),
            _packed(np.diff(np.append(at_pair, len(words)))),
            _packed(docs),
        ]
    )


def _received(data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words, per_word, contexts, per_pair, docs = _split(data)
    words = np.frombuffer(words, np.uint64)
    contexts = np.frombuffer(contexts, "<u4").astype(np.uint64)
    per_pair = _unpacked(per_pair).astype(np.int64)
    of_pair = np.repeat(words, _unpacked(per_word).astype(np.int64))
    return np.repeat(of_pair, per_pair), np.repeat(contexts, per_pair), _unpacked(docs).astype(np.int64)


def _dealt(groups: int, hot: np.ndarray):
    """Rows (group, block, ids, train, tokens): every token to the group of its word."""

    def deal(batches):
        part = TaskContext.get().partitionId()
        for number, (words, (ids, train)) in enumerate(_blocks_of(batches, ["doc_id", "train"])):
            block = (part << 24) | number
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(sizes) - 1
            flat = np.empty(sizes.sum(), np.uint64)
            inner = np.ones(len(flat), bool)
            inner[ends] = False
            flat[inner] = np.concatenate(words)
            flat[ends] = END
            before = np.empty_like(flat)
            before[1:] = flat[:-1]
            before[ends - sizes + 1] = START
            docs = np.repeat(np.arange(len(words)), sizes)
            place = mix(flat + np.uint64(1))
            if len(hot):
                busy = hot[np.minimum(np.searchsorted(hot, flat), len(hot) - 1)] == flat
                place[busy] = mix(place[busy] ^ before[busy])
            group = (place % np.uint64(groups)).astype(np.int32)
            context = before & np.uint64((1 << CONTEXT_BITS) - 1)
            order = np.argsort(group, kind="stable")
            found, at = np.unique(group[order], return_index=True)
            # Ids and sizes travel once, as an Arrow stream, nulls and all.
            listed = pa.RecordBatch.from_arrays([ids, pa.array(sizes)], names=["doc_id", "n_tokens"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, listed.schema) as out:
                out.write_batch(listed)
            flags = np.packbits(train.to_numpy(zero_copy_only=False)).tobytes()
            own = found[block % len(found)]
            for k, rows in zip(found, np.split(order, at[1:])):
                tokens = _sent(flat[rows], context[rows], docs[rows])
                lead = sink.getvalue().to_pybytes() if k == own else None
                yield pa.RecordBatch.from_pylist(
                    [{"group_no": int(k), "block": block, "docs": len(words), "ids": lead, "train": flags, "tokens": tokens}],
                    _DEALT_ARROW,
                )

    return deal


_DEALT_ARROW = pa.schema(
    [("group_no", pa.int32()), ("block", pa.int64()), ("docs", pa.int32()), ("ids", pa.binary()), ("train", pa.binary()), ("tokens", pa.binary())]
)
_DEALT = "group_no int, block long, docs int, ids binary, train binary, tokens binary"
_PART_ARROW = pa.schema([("block", pa.int64()), ("docs", pa.int32()), ("ids", pa.binary()), ("sums", pa.binary())])
_PART = "block long, docs int, ids binary, sums binary"


def _group_sums(rows: list[dict], total: int, distinct: int, hot: np.ndarray, hot_counts: np.ndarray):
    """Build the group's trie from its training tokens and score all its tokens."""
    words, contexts, docs, train = [], [], [], []
    base_doc = 0
    for row in rows:
        w, c, d = _received(row["tokens"])
        flags = np.unpackbits(np.frombuffer(row["train"], np.uint8), count=row["docs"]).astype(bool)
        words.append(w)
        contexts.append(c)
        docs.append(d + base_doc)
        train.append(flags[d])
        base_doc += row["docs"]
    words, contexts, docs, train = (np.concatenate(x) for x in (words, contexts, docs, train))
    unique_words, word_no = np.unique(words, return_inverse=True)
    keys = (word_no.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts
    pairs, pair_no = np.unique(keys, return_inverse=True)
    pair_word = (pairs >> np.uint64(CONTEXT_BITS)).astype(np.int64)
    pair_context = pairs & np.uint64((1 << CONTEXT_BITS) - 1)

    # Learn: counts of words and pairs in training documents.
    pair_counts = np.bincount(pair_no, weights=train, minlength=len(pairs))
    counts = np.bincount(pair_word, weights=pair_counts, minlength=len(unique_words))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, unique_words), len(hot) - 1)
        counts = np.where(hot[at] == unique_words, hot_counts[at], counts)
    size = total + distinct + 1
    seen = counts > 0
    place_of = np.cumsum(seen) - 1
    prior = MASS * (counts + 1) / size
    known_pair = pair_counts > 0
    trie = BigramTrie(
        unique_words[seen],
        np.log10(np.stack([prior[seen], counts[seen] + MASS], axis=1)).ravel(),
        place_of[pair_word[known_pair]],
        pair_context[known_pair],
        np.log10(pair_counts[known_pair] + prior[pair_word[known_pair]]),
    )

    # Score: every distinct word and pair is looked up once. Codes are whole numbers, so are their sums.
    alone = np.full(len(unique_words), int(quantised(np.log10(MASS / size))))
    below = np.full(len(unique_words), int(quantised(np.log10(MASS))))
    place, there = trie.find_words(unique_words)
    alone[there], below[there] = trie.word_codes(2 * place[there]), trie.word_codes(2 * place[there] + 1)
    below[unique_words == END] = int(quantised(np.zeros(())))  # nothing follows it: the logarithm of one
    found = alone[pair_word]
    ask = np.flatnonzero(there[pair_word])
    if len(ask) and known_pair.any():
        pair_place, pair_there = trie.find_pairs(place[pair_word[ask]], pair_context[ask])
        found[ask[pair_there]] = trie.pair_codes(pair_place[pair_there])
    base = np.rint(np.log10(counts + 1) * FIXED)
    total_of = lambda values: np.bincount(docs, weights=values, minlength=base_doc).astype(np.int64)
    sums = np.stack([total_of((found - below[pair_word])[pair_no]), total_of(base[word_no]), total_of(seen[word_no])])
    held = np.bincount(docs, minlength=base_doc) > 0
    at = 0
    for row in rows:
        own = np.flatnonzero(held[at : at + row["docs"]])
        part = sums[:, at + own]
        at += row["docs"]
        bitmap = np.zeros(row["docs"], bool)
        bitmap[own] = True
        as_bits, as_list = np.packbits(bitmap).tobytes(), _packed(own)
        least = int(part[0].min(initial=0))
        data = _join(
            [b"b" + as_bits if len(as_bits) < len(as_list) else b"l" + as_list, least.to_bytes(8, "little", signed=True),
             _packed(part[0] - least), (part[1] & 0xFFFFFFFF).astype("<u4").tobytes(), _packed(part[1] >> 32), _packed(part[2])]
        )
        yield {"block": row["block"], "docs": row["docs"], "ids": row["ids"], "sums": data}


def _grouped(total: int, distinct: int, hot: np.ndarray, hot_counts: np.ndarray):
    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if rows and row["group_no"] != rows[0]["group_no"]:
                    yield pa.RecordBatch.from_pylist(list(_group_sums(rows, total, distinct, hot, hot_counts)), _PART_ARROW)
                    rows = []
                rows.append(row)
        if rows:
            yield pa.RecordBatch.from_pylist(list(_group_sums(rows, total, distinct, hot, hot_counts)), _PART_ARROW)

    return run


def _document_sums(opening: float, total: int, distinct: int):
    """Adds up what the groups sent for each block of documents."""
    size = total + distinct + 1

    def finished(ids, sums):
        with pa.ipc.open_stream(ids) as stream:
            listed = stream.read_all().combine_chunks()
        n = listed.column("n_tokens").to_numpy()
        column = listed.column("doc_id")
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
        return pa.RecordBatch.from_arrays(
            [column, pa.array(n), pa.array(sums[2]), pa.array(np.full(len(n), total, np.int64)),
             pa.array(sums[1] / FIXED - n * math.log10(size)), pa.array(sums[0] * STEP - opening)],
            names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches):
        block, ids, sums = None, None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["block"] != block:
                    if block is not None:
                        yield finished(ids, sums)
                    block, ids, sums = row["block"], None, np.zeros((3, row["docs"]), np.int64)
                own, least, score, low, high, known = _split(row["sums"])
                if own[:1] == b"b":
                    own = np.flatnonzero(np.unpackbits(np.frombuffer(own[1:], np.uint8), count=row["docs"]))
                else:
                    own = _unpacked(own[1:])
                sums[0, own] += _unpacked(score).astype(np.int64) + int.from_bytes(least, "little", signed=True)
                sums[1, own] += np.frombuffer(low, "<u4").astype(np.int64) + (_unpacked(high).astype(np.int64) << 32)
                sums[2, own] += _unpacked(known).astype(np.int64)
                ids = row["ids"] if row["ids"] is not None else ids
        if block is not None:
            yield finished(ids, sums)

    return run


def learn_and_score(docs: DataFrame, train) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``.

    ``train`` is a condition on doc_id: those rows are learned from. Tokens are lower-cased (A-Z)
    words and one closing token, so an empty or null text has one token. Repeated rows count and
    are scored each; null ids stay null; other columns are left out; an empty table gives no rows.
    Without training rows all counts are 0 and all scores follow from the smoothing.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), train.alias("train"))
    words = stored(
        docs.filter("train").select("text").mapInArrow(_counted, "word long, c long")
        .groupBy("word").agg(F.sum("c").alias("c")),
        "word-counts",
    )
    sums = words.agg(F.sum("c").alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = sums["total"] or 0, sums["distinct"]
    groups = max(1, math.ceil(1.2 * total / GROUP_TOKENS))
    # Words with a quarter of a group's tokens: at most 4 per group, whatever the input.
    busy = words.filter(F.col("c") >= GROUP_TOKENS // 4).collect()
    order = sorted((row["word"] % (1 << 64), row["c"]) for row in busy)
    hot = np.array([w for w, _ in order], np.uint64)
    hot_counts = np.array([c for _, c in order], np.float64)
    ending = words.filter(F.col("word") == int(END.view(np.int64))).first()
    opening = math.log10((ending["c"] if ending else 0) + MASS)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (
        docs.mapInArrow(_dealt(groups, hot), _DEALT)
        .repartition(partitions, "group_no").sortWithinPartitions("group_no", "block")
        .mapInArrow(_grouped(total, distinct, hot, hot_counts), _PART)
        .repartition(partitions, "block").sortWithinPartitions("block")
        .mapInArrow(_document_sums(opening, total, distinct), scores)
    )


def held_out():
    return id_remainder("doc_id", 7) == 2
