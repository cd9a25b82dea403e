"""Elias-Fano sequences and a two-level trie over them, in one flat buffer.

A level is a buffer of bytes that may as well be a mapped file: upper bits in unary,
lower bits packed, a count of zeros per 64 bits. Queries are answered for whole
arrays: the bucket of the upper bits by selecting zeros, then a binary search among
the packed lower bits.
"""

from __future__ import annotations

import mmap

import numpy as np


def _mapped(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Copies of the arrays, 8 bytes aligned, in one anonymous memory map."""
    sizes = [-(-p.nbytes // 8) * 8 for p in parts]
    space = mmap.mmap(-1, max(8, sum(sizes)))
    found, at = [], 0
    for part, size in zip(parts, sizes):
        view = np.frombuffer(space, part.dtype, part.size, at)
        view[:] = part
        found.append(view)
        at += size
    return found


class EliasFano:
    """A non-decreasing sequence of numbers below ``universe`` (at most 2^64)."""

    def __init__(self, values: np.ndarray, universe: int):
        values = values.astype(np.uint64)
        self.size = n = len(values)
        self.low_bits = low = max(0, (universe // max(1, n)).bit_length() - 1)
        self.top = top = ((universe - 1) >> low) + 1 if universe else 1  # buckets
        upper = np.zeros(-(-(n + top + 1) // 64) * 64, np.uint8)
        if n:
            upper[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
        bits = np.packbits(upper, bitorder="little")
        zeros = np.concatenate(([0], np.cumsum(64 - upper.reshape(-1, 64).sum(axis=1, dtype=np.int64))))
        packed = np.zeros(-(-n * low // 64) + 2, np.uint64)
        if low and n:
            rest = values & np.uint64((1 << low) - 1)
            at = np.arange(n, dtype=np.int64) * low
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(packed, word, rest << shift)
            over = np.flatnonzero((at & 63) + low > 64)
            np.bitwise_or.at(packed, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        self.bits, self.zeros, self.packed = _mapped([bits, zeros.astype(np.uint32), packed])

    @property
    def nbytes(self) -> int:
        return self.bits.nbytes + self.zeros.nbytes + self.packed.nbytes

    def lows(self, at: np.ndarray) -> np.ndarray:
        """The lower bits of the elements at these places."""
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at.astype(np.int64) * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        found = self.packed[word] >> shift
        spill = (np.uint64(64) - shift) & np.uint64(63)
        more = np.where(shift > 0, self.packed[word + 1] << spill, np.uint64(0))
        return (found | more) & np.uint64((1 << self.low_bits) - 1)

    def starts(self, buckets: np.ndarray) -> np.ndarray:
        """How many elements lie in earlier buckets."""
        found = np.zeros(len(buckets), np.int64)
        ask = np.flatnonzero(buckets > 0)
        for first in range(0, len(ask), 1 << 14):
            part = ask[first : first + (1 << 14)]
            nth = buckets[part].astype(np.int64) - 1  # the zero that closes the bucket before
            word = np.searchsorted(self.zeros, nth, "right") - 1
            left = nth - self.zeros[word]
            octets = self.bits.reshape(-1, 8)[word]
            ahead = np.cumsum(np.unpackbits(octets, axis=1, bitorder="little") ^ 1, axis=1, dtype=np.uint8)
            inside = (ahead <= left[:, None]).sum(axis=1)
            found[part] = word * 64 + inside - nth
        return found

    def successor(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element not below each number, and whether it is that number."""
        asked = asked.astype(np.uint64)
        bucket = (asked >> np.uint64(self.low_bits)).astype(np.int64)
        rest = asked & np.uint64((1 << self.low_bits) - 1)
        distinct, back = np.unique(np.concatenate([bucket, bucket + 1]), return_inverse=True)
        starts = self.starts(np.minimum(distinct, self.top))[back]
        low, high = starts[: len(asked)].copy(), starts[len(asked) :].copy()
        end = high.copy()
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            below = self.lows(middle) < rest[going]
            low[going[below]] = middle[below] + 1
            high[going[~below]] = middle[~below]
            going = going[low[going] < high[going]]
        equal = low < end
        equal[equal] = self.lows(low[equal]) == rest[equal]
        return low, equal

    def access(self, at: np.ndarray) -> np.ndarray:
        """The elements at these places, by selecting ones among all upper bits."""
        ones = np.flatnonzero(np.unpackbits(self.bits, bitorder="little"))
        return ((ones[at] - at).astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(at)


STEP = 1 / 2048  # of the quantised logarithms
LEAST = -24.0


def quantised(logs: np.ndarray) -> np.ndarray:
    """Base-10 logarithms between -24 and 8 in 16 bits."""
    return np.clip(np.rint((logs - LEAST) / STEP), 0, 65535).astype(np.uint16)


CONTEXT_BITS = 32


class BigramTrie:
    """Words, and below each word the contexts it was seen after.

    ``words`` is sorted; ``owner`` (place of the word) and ``contexts`` are sorted together.
    ``unigram_logs`` has a row of logarithms per word, ``bigram_logs`` one per pair.
    """

    def __init__(self, words, unigram_logs, owner, contexts, bigram_logs):
        self.words = EliasFano(words, 1 << 64)
        pointers = np.searchsorted(owner, np.arange(len(words) + 1))
        self.pointers = EliasFano(pointers, len(owner) + 1)
        # Contexts relative to their word: the word's place raises them above all earlier ones.
        self.relative = EliasFano(
            (owner.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts, max(1, len(words)) << CONTEXT_BITS
        )
        self.unigrams, self.bigrams = _mapped([quantised(unigram_logs), quantised(bigram_logs)])

    def find_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.words.successor(words)

    def word_codes(self, places: np.ndarray) -> np.ndarray:
        return self.unigrams[places].astype(np.int64)

    def find_pairs(self, places: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each (word place, context) among the pairs, and whether it is there."""
        return self.relative.successor((places.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts)

    def pair_codes(self, places: np.ndarray) -> np.ndarray:
        return self.bigrams[places].astype(np.int64)
