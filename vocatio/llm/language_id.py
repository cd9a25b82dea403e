"""Language identification with a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time. The state starts anew at every
word, so equal words have equal labels and each is run once per group of texts.
Every byte gets a probability per language; a document's probabilities are the
mean over all its positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from vocatio.llm.tables import id_remainder, lean, texts_by_size

HIDDEN = 16
LONGEST = 32  # bytes run together; a longer word is cut between characters, in training as in use
KNOWN_WORDS = 150_000  # words whose sums a task remembers; more cost time only
CHUNK_BYTES = 1 << 20

# Bounds of the training sample: documents per language, languages, characters of each document's window.
SAMPLE_DOCS = 300
SAMPLE_LANGS = 200
SAMPLE_CHARS = 1500
TRAIN_STEPS = 350
TRAIN_WORDS = 256  # words per step


@dataclass
class Network:
    langs: list[str]
    inputs: np.ndarray  # direction, byte, 3 hidden: reset, update, candidate
    states: np.ndarray  # direction, hidden, 3 hidden
    out: np.ndarray  # 2 hidden, langs
    bias: np.ndarray  # langs


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(net: Network, codes: np.ndarray, present: np.ndarray, way: int, keep: bool):
    """States at every position and, if asked for, what the way back needs. codes, present: (length, words)."""
    size = net.states.shape[1]
    h = np.zeros((codes.shape[1], size), np.float32)
    kept = []
    order = range(len(codes)) if way == 0 else range(len(codes) - 1, -1, -1)
    states = np.zeros((len(codes), codes.shape[1], size), np.float32)
    for t in order:
        x = net.inputs[way][codes[t]]
        g = h @ net.states[way]
        gates = _sigmoid(x[:, : 2 * size] + g[:, : 2 * size])
        r, z = gates[:, :size], gates[:, size:]
        c = np.tanh(x[:, 2 * size :] + r * g[:, 2 * size :])
        new = c + z * (h - c)
        on = present[t][:, None]
        new = np.where(on, new, h)
        if keep:
            kept.append((t, h, r, z, c, g[:, 2 * size :], on))
        h = states[t] = new
    return states, kept


def _logits(net: Network, codes, present, keep: bool = False):
    there, kept_there = _forward(net, codes, present, 0, keep)
    back, kept_back = _forward(net, codes, present, 1, keep)
    both = np.concatenate([there, back], axis=2)
    return both @ net.out + net.bias, both, (kept_there, kept_back)


def _softmax(x):
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def _gradients(net: Network, codes, present, labels):
    logits, both, kept = _logits(net, codes, present, keep=True)
    weight = present.astype(np.float32)[:, :, None] / max(1, present.sum())
    wrong = _softmax(logits)
    np.put_along_axis(wrong, np.broadcast_to(labels[None, :, None], (*codes.shape, 1)).copy(),
                      np.take_along_axis(wrong, np.broadcast_to(labels[None, :, None], (*codes.shape, 1)), 2) - 1, 2)
    wrong *= weight
    found = {name: np.zeros_like(getattr(net, name)) for name in ("inputs", "states", "out", "bias")}
    found["out"] = np.einsum("tbh,tbl->hl", both, wrong)
    found["bias"] = wrong.sum(axis=(0, 1))
    size = net.states.shape[1]
    into = wrong @ net.out.T
    for way in (0, 1):
        d_next = np.zeros((codes.shape[1], size), np.float32)
        U = net.states[way]
        for t, h, r, z, c, g, on in reversed(kept[way]):
            d = d_next + into[t][:, way * size : (way + 1) * size]
            d_on = d * on
            d_c = d_on * (1 - z) * (1 - c * c)
            d_z = d_on * (h - c) * z * (1 - z)
            d_r = d_c * g * r * (1 - r)
            d_x = np.concatenate([d_r, d_z, d_c], axis=1)
            d_g = np.concatenate([d_r, d_z, d_c * r], axis=1)
            np.add.at(found["inputs"][way], codes[t], d_x)
            found["states"][way] += h.T @ d_g
            d_next = d_on * z + d_g @ U.T + d * ~on
    return found


def pieces_of(word: bytes) -> list[bytes]:
    """A word in parts of LONGEST bytes at most, cut between characters."""
    if len(word) <= LONGEST:
        return [word]
    found, at = [], 0
    while at < len(word):
        end = min(at + LONGEST, len(word))
        while end < len(word) and end > at + 1 and word[end] & 0xC0 == 0x80:
            end -= 1
        found.append(word[at:end])
        at = end
    return found


def train(sample: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """A network from (language, text) pairs; None without any."""
    langs = sorted({lang for lang, _ in sample})
    words: list[list[bytes]] = [[] for _ in langs]
    for lang, text in sample:
        words[langs.index(lang)] += [piece for w in text.encode().split() for piece in pieces_of(w)]
    words = [w or [b" "] for w in words]
    if not langs:
        return None
    random = np.random.default_rng(seed)
    small = lambda *shape: random.normal(0, 0.3, shape).astype(np.float32)
    net = Network(langs, small(2, 256, 3 * HIDDEN), small(2, HIDDEN, 3 * HIDDEN), small(2 * HIDDEN, len(langs)), np.zeros(len(langs), np.float32))
    names = ("inputs", "states", "out", "bias")
    first = {name: np.zeros_like(getattr(net, name)) for name in names}
    second = {name: np.zeros_like(getattr(net, name)) for name in names}
    for step in range(1, TRAIN_STEPS + 1):
        labels = random.integers(0, len(langs), TRAIN_WORDS)
        batch = [words[k][random.integers(len(words[k]))] for k in labels]
        codes, present = _padded(batch)
        found = _gradients(net, codes, present, labels)
        rate = 0.02 * min(1, 3 * (1 - step / (TRAIN_STEPS + 1)))
        for name in names:
            g = found[name]
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.01 * (g * g - second[name])
            m = first[name] / (1 - 0.9**step)
            v = second[name] / (1 - 0.99**step)
            getattr(net, name)[...] -= rate * m / (np.sqrt(v) + 1e-8)
    return net


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, words))
    flat = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return flat.reshape(len(words), longest).T, np.arange(longest)[:, None] < sizes[None, :]


def position_sums(net: Network, words: list[bytes]) -> np.ndarray:
    """Sum over the positions of each word of the language probabilities, and the number of positions."""
    pieces = [(i, piece) for i, w in enumerate(words) for piece in pieces_of(w)]
    pieces.sort(key=lambda p: len(p[1]))
    found = np.zeros((len(words), len(net.langs) + 1), np.float64)
    for first in range(0, len(pieces), 4096):
        group = pieces[first : first + 4096]
        codes, present = _padded([w for _, w in group])
        labels = _softmax(_logits(net, codes, present)[0])  # a label for every position
        sums = (labels * present[:, :, None]).sum(axis=0)
        to = [i for i, _ in group]
        np.add.at(found, (to, slice(None, -1)), sums)
        np.add.at(found[:, -1], to, present.sum(axis=0))
    return found


class _Numbers(dict):
    """Words numbered as they come; ``new`` holds those that came last."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Pool:
    """Mean of the position probabilities of whole texts."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.sums = np.zeros((0, len(self.net.langs) + 1))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """(texts, langs); zeros for a text without words."""
        found = np.zeros((len(texts), len(self.net.langs) + 1))
        for first, last in texts_by_size(texts, CHUNK_BYTES):
            if len(self.numbers) > KNOWN_WORDS:
                self.forget()
            words = [t.split() for t in texts[first:last]]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            numbers = np.fromiter((self.numbers[w] for ws in words for w in ws), np.int64, sizes.sum())
            if self.numbers.new:
                self.sums = np.concatenate([self.sums, position_sums(self.net, self.numbers.new)])
                self.numbers.new = []
            full = np.flatnonzero(sizes)
            if len(full):
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                found[first + full] = np.add.reduceat(self.sums[numbers], starts, axis=0)
        return found[:, :-1] / np.maximum(found[:, -1:], 1)


def labelled_sample(docs: DataFrame, docs_per_lang: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """At most ``docs_per_lang`` documents of each of the SAMPLE_LANGS commonest languages.

    Each contributes a window of SAMPLE_CHARS characters at a place drawn by its hash. Languages
    are counted first, so that the draw passes a few documents per language to the ranking.
    """
    order = F.xxhash64("doc_id", F.lit(11))
    counts = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_LANGS).collect()
    if not counts:
        return []
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, 4 * docs_per_lang / row["count"]))).otherwise(share)
    drawn = docs.filter(F.pmod(order, F.lit(1 << 30)) < share * (1 << 30))
    length = F.char_length("text")
    at = F.when(length > SAMPLE_CHARS, F.pmod(F.xxhash64("doc_id", F.lit(12)), length - SAMPLE_CHARS)).otherwise(0)
    window = F.col("text").substr((at + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("order", "window"))
    picked = (
        drawn.select("lang", order.alias("order"), window.alias("window"))
        .withColumn("rank", rank).filter(F.col("rank") <= docs_per_lang)
    )
    return [(r["lang"], r["window"]) for r in picked.orderBy("lang", "order", "window").collect()]


def fit(docs: DataFrame) -> Network | None:
    """A network learned from text and lang of the given rows; rows without either are left out."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    return train(labelled_sample(known))


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score and probabilities by language of each row of ``docs``.

    A null text and one without any letter is ``und`` with score 0, and so is every text when no
    label was there to learn from. Null ids stay null, repeated rows stay, other columns are left
    out. Equal texts get equal results. Of equally probable languages the first by name is taken.
    """
    id_type = docs.schema["doc_id"].dataType
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    fields = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("lang_pred", T.StringType()),
         T.StructField("score", T.DoubleType()), T.StructField("probabilities", T.ArrayType(T.DoubleType()))]
    )

    def label(batches):
        pool = Pool(net) if net is not None else None
        names = np.array([*(net.langs if net else []), "und"], object)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                lettered = part.column("lettered").to_numpy(zero_copy_only=False)
                if pool is None:
                    found = np.zeros((part.num_rows, 0))
                    best, score = np.zeros(part.num_rows, int), np.zeros(part.num_rows)
                else:
                    texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column("text")]
                    found = pool([t if on else b"" for t, on in zip(texts, lettered)])
                    best = np.where(lettered, found.argmax(axis=1), len(names) - 1)
                    score = np.where(lettered, np.clip(found.max(axis=1), 0, 1), 0.0)
                bounds = np.arange(part.num_rows + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.ravel()))],
                    names=fields.names,
                )

    return docs.select("doc_id", "text", lettered.alias("lettered")).mapInArrow(lean(label), fields)


SCORE_STEPS = 1 << 16  # in which scores are counted


def least_score(net: Network | None, labelled: list[tuple[str, str]] | DataFrame) -> float:
    """A score that texts of the learned languages reach: halfway from chance to their lowest hundredth.

    ``labelled`` are (language, text) pairs, or rows of ``scored``, however many: they are counted
    by score in SCORE_STEPS steps, so a row per step at most comes back. The score follows the
    number of languages; it is 0 without a network.
    """
    if net is None:
        return 0.0
    if isinstance(labelled, DataFrame):
        step = F.floor(F.col(SCORE) * SCORE_STEPS)
        counts = sorted((r["step"], r["count"]) for r in labelled.groupBy(step.alias("step")).count().collect())
    else:
        scores = Pool(net)([text.encode() for _, text in labelled if text.split()]).max(axis=1)
        counts = list(zip(*np.unique(np.floor(scores * SCORE_STEPS), return_counts=True)))
    if not counts:
        return 0.0
    steps, sizes = (np.array(column, np.float64) for column in zip(*counts))
    reached = np.cumsum(sizes)
    lowest = steps[np.searchsorted(reached, 0.01 * (reached[-1] - 1), side="right")] / SCORE_STEPS
    chance = 1 / len(net.langs)
    return float(chance + (lowest - chance) / 2)


SCORE = "x_language_score"


def scored(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows with a letter in their text and the probability of its likeliest language as x_language_score.

    Null without a network, as nothing can be judged then.
    """
    found = docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if net is None:
        return found.withColumn(SCORE, F.lit(None).cast("double"))

    def score(batches):
        pool = Pool(net)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [t.as_buffer().to_pybytes() for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pool(texts).max(axis=1))], names=[*part.schema.names, SCORE]
                )

    return found.mapInArrow(lean(score), T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())]))


def keep_identified(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The rows whose language is known with a score of at least ``least``; columns as given.

    A null text and one without letters go. Without a network nothing can be judged: only those go.
    """
    return keep_scored(scored(docs, net), least)


def keep_scored(rows: DataFrame, least: float) -> DataFrame:
    """The rows of ``scored`` with at least that score, without it."""
    return rows.filter(F.col(SCORE).isNull() | (F.col(SCORE) >= least)).drop(SCORE)


def held_out():
    return id_remainder("doc_id", 3) == 1


def fit_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and label all; adds held_out."""
    net = fit(docs.filter(~held_out()))
    return identify(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "probabilities")
