"""Runs of repeating words, by a suffix automaton with link-cut access.

The suffix links of the automaton form a tree in which the path of a prefix holds all its
suffixes. Every node knows where its strings ended last. Appending a word accesses the path
of the new prefix and recolours it with the new end: link-cut access walks it by segments
of one last end each. A segment whose strings of length L ended d words earlier, d <= L,
shows a square of period d; it is extended to the run around it. The first square of a run
has its own smallest period as distance to the last end, so that no run is missed and none
is found with a multiple of its period.

Before the automaton, stretches of a text where no six-word sequence occurs twice are set
aside. A run of at least max(12, 2 q) words repeats at least six words at distance q, and
its recurring six-word sequences cover it without a gap, so it lies in one of the stretches
left. This is repeated within the stretches while it shortens them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vocatio.llm.tables import texts_by_size
from vocatio.llm.words import CHUNK_BYTES, column_bytes, mix, pieces

LEAST_WORDS = 12  # of a run, which has two periods at least
GRAM = LEAST_WORDS // 2  # words that a run repeats at the distance of its period

_ODD = np.random.default_rng(20261103).integers(0, 1 << 63, GRAM, dtype=np.uint64) | np.uint64(1)


# --- stretches that may hold runs -----------------------------------------------


def recurring_stretches(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place (exclusive) of the stretches covered by sequences that recur in them.

    ``values`` are the words of several texts one after another, ``owner`` tells them apart.
    """
    places = np.arange(len(values))
    while len(places) >= GRAM:
        n = len(places) - GRAM + 1
        grams = np.zeros(n, np.uint64)
        for k in range(GRAM):
            grams += values[k : n + k] * _ODD[k]
        grams = mix(grams ^ mix(owner[:n].astype(np.uint64) + np.uint64(1)))
        inside = np.flatnonzero(owner[:n] == owner[GRAM - 1 :])
        order = inside[np.argsort(grams[inside])]
        same = grams[order[1:]] == grams[order[:-1]]
        recurs = np.zeros(n + 1, bool)
        recurs[order[1:][same]] = True
        recurs[order[:-1][same]] = True
        starts = np.flatnonzero(recurs)
        steps = np.zeros(len(places) + 1, np.int32)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + GRAM, -1)
        covered = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        before = len(places)
        values, owner, places = values[covered], owner[covered], places[covered]
        if len(places) == 0:
            break
        fresh = (places[1:] != places[:-1] + 1) | (owner[1:] != owner[:-1])
        owner = np.concatenate(([0], np.cumsum(fresh)))
        if len(places) > 0.9 * before:  # hardly anything falls away any more
            break
    if len(places) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turns = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    first = places[np.concatenate(([0], turns))]
    last = places[np.concatenate((turns - 1, [len(places) - 1]))] + 1
    return first, last


# --- suffix automaton and link-cut access -----------------------------------------


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest length of each state (1 is the root, 0 none), and the state of each prefix."""
    link, length, steps = [0, 0], [0, 0], [{}, {}]
    prefixes, last = [], 1
    for word in words:
        state = len(link)
        link.append(1)
        length.append(length[last] + 1)
        steps.append({})
        at = last
        while at and word not in steps[at]:
            steps[at][word] = state
            at = link[at]
        if at:
            target = steps[at][word]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(link)
                link.append(link[target])
                length.append(length[at] + 1)
                steps.append(steps[target].copy())
                link[target] = link[state] = copy
                while at and steps[at].get(word) == target:
                    steps[at][word] = copy
                    at = link[at]
        prefixes.append(state)
        last = state
    return link, length, prefixes


class LastEnds:
    """Last end of the strings of every state: a link-cut forest whose paths have one colour each.

    A path of states that ended last at the same place is one splay tree, ordered by length; the
    place is kept at its root. ``up`` of such a root is the state above the path.
    """

    def __init__(self, link: list[int], length: list[int]):
        self.up, self.length = link, length
        self.left, self.right = [0] * len(link), [0] * len(link)
        self.end = [0] * len(link)

    def _splay(self, x: int) -> None:
        up, left, right, end = self.up, self.left, self.right, self.end
        while True:
            p = up[x]
            if not p:
                return
            if left[p] == x:
                x_left = True
            elif right[p] == x:
                x_left = False
            else:
                return
            g = up[p]
            if g and left[g] == p:
                p_side = 1
            elif g and right[g] == p:
                p_side = 2
            else:
                p_side = 0
                end[x] = end[p]  # p was the root of the path
            if p_side and (p_side == 1) == x_left:  # zig-zig: p above g first
                above = up[g]
                if x_left:
                    c = left[g] = right[p]
                    right[p] = g
                else:
                    c = right[g] = left[p]
                    left[p] = g
                if c:
                    up[c] = g
                up[g], up[p] = p, above
                if above:
                    if left[above] == g:
                        left[above] = p
                    elif right[above] == g:
                        right[above] = p
                    else:
                        end[p] = end[g]
                else:
                    end[p] = end[g]
            above = up[p]  # then, or else alone, x above p
            if x_left:
                c = left[p] = right[x]
                right[x] = p
            else:
                c = right[p] = left[x]
                left[x] = p
            if c:
                up[c] = p
            up[p], up[x] = x, above
            if above:
                if left[above] == p:
                    left[above] = x
                elif right[above] == p:
                    right[above] = x
                else:
                    end[x] = end[p]
            else:
                end[x] = end[p]

    def append(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolours the path of a prefix; longest length and previous end of each segment that ended before."""
        up, right, ends = self.up, self.right, self.end
        found, below, x = [], 0, state
        while x:
            self._splay(x)
            before = ends[x]
            if before:
                found.append((self.length[x], before))
            if right[x]:
                ends[right[x]] = before  # the rest of the old path stays as it was
            right[x] = below
            below, x = x, up[x]
        ends[below] = end
        return found


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements are equal, looked at in growing parts."""
    n, done, size = min(len(a), len(b)), 0, 32
    a, b = a[:n], b[:n]
    while done < n:
        unequal = np.flatnonzero(a[done : done + size] != b[done : done + size])
        if len(unequal):
            return done + int(unequal[0])
        done, size = done + size, 2 * size
    return n


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of two periods and LEAST_WORDS words at least, sorted."""
    numbered = np.unique(words, return_inverse=True)[1]
    link, length, prefixes = automaton(numbered.tolist())
    forest = LastEnds(link, length)
    reach: dict[int, int] = {}  # by period, where its last run ends
    found = []
    for end, state in enumerate(prefixes, 1):
        for longest, before in forest.append(state, end):
            period = end - before
            if period > longest or reach.get(period, 0) >= end:
                continue
            stop = end + _agreement(numbered[end:], numbered[end - period :])
            back = _agreement(numbered[end - 1 :: -1], numbered[end - 1 - period :: -1])
            start = end - back - period
            reach[period] = stop
            if stop - start >= max(LEAST_WORDS, 2 * period):
                found.append((start, stop - start, period))
    return sorted(found)


# --- documents ---------------------------------------------------------------------


def _hashed(text: bytes) -> np.ndarray:
    """A 64-bit hash per word; bytes.split() cuts at exactly the separators of words."""
    parts = [np.fromiter(map(hash, words), np.int64, len(words)) for words in map(bytes.split, pieces(text))]
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)).view(np.uint64)


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs or in a run's first period, joined by single spaces."""
    if not runs:
        return b" ".join([b" ".join(words) for words in map(bytes.split, pieces(text)) if words])
    words, kept, at = text.split(), [], 0
    for first, last in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:first]
        at = max(at, last)
    return b" ".join(kept + words[at:])


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _found(batches):
    for batch in batches:
        texts = column_bytes(batch.column("text"))
        for low, high in texts_by_size(texts, CHUNK_BYTES):
            hashed = [_hashed(text) for text in texts[low:high]]
            sizes = np.array([len(words) for words in hashed], np.int64)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            values = np.concatenate(hashed)
            runs: list[list] = [[] for _ in hashed]
            for first, last in zip(*recurring_stretches(values, np.repeat(np.arange(len(sizes)), sizes))):
                owner = int(np.searchsorted(starts, first, "right")) - 1
                shift = int(first - starts[owner])
                runs[owner] += [(s + shift, n, q) for s, n, q in runs_of(values[first:last])]
            short = [collapsed(text, own) for text, own in zip(texts[low:high], runs)]
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(low, high - low), pa.array(sizes), pa.array(rows, _RUN_LIST),
                 pa.array(short, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs, collapsed: a row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of words with smallest period q, of at
    least max(12, 2 q) words, that no neighbouring word extends; runs are sorted by start, then
    period, and may overlap. ``collapsed`` holds the words outside of runs and those of each run's
    first period, unless they lie in the rest of another run, joined by single spaces. A null or
    empty text has no words, no runs and an empty collapsed text. Repeated rows, repeated and null
    ids are rows of their own; other columns are left out; an empty table gives no rows.

    Texts are read where they lie, without a shuffle. Memory grows with the longest recurring
    stretch of a single text. Words are compared by 64-bit hashes.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_found, f"doc_id {id_type}, n_words long, runs {RUNS}, collapsed string")
