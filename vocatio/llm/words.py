"""Words of texts as 64-bit hashes, for many texts at once with numpy.

A word is a run of bytes other than space and x09 to x0D, A-Z lower-cased. Its
hash is a polynomial over its bytes modulo 2^64, taken from one running sum.
"""

from __future__ import annotations

import numpy as np

from vocatio.llm.tables import once_per_worker, texts_by_size

CHUNK_BYTES = 1 << 20

_SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def _powers(base: int, size: int) -> np.ndarray:
    found = np.ones(size, np.uint64)
    done, step = 1, np.uint64(base)
    while done < size:  # found[done:2 done] = found[:done] * base^done
        part = min(done, size - done)
        found[done : done + part] = found[:part] * np.uint64(pow(base, done, 1 << 64))
        done += part
    return found


def _tables(size: int):
    rounded = 1 << max(size - 1, 2 * CHUNK_BYTES - 1).bit_length()
    if rounded > 1 << 24:  # a single huge word: not kept
        return _powers(_BASE, rounded), _powers(pow(_BASE, -1, 1 << 64), rounded)
    return once_per_worker(
        ("powers", rounded), lambda: (_powers(_BASE, rounded), _powers(pow(_BASE, -1, 1 << 64), rounded))
    )


def _lookup():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    apart = np.zeros(256, bool)
    apart[list(_SEPARATORS)] = True
    return lower, apart


def _hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a byte string that ends in a separator."""
    lower, apart = once_per_worker("letters", _lookup)
    codes = np.frombuffer(joined, np.uint8)
    gap = apart[codes]
    turn = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        turn = np.concatenate(([0], turn))
    starts, ends = turn[0::2], turn[1::2]
    powers, inverse = _tables(len(codes))
    sums = np.cumsum((lower[codes].astype(np.uint64) + np.uint64(1)) * powers[: len(codes)])
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    found = (sums[ends - 1] - before) * inverse[starts]
    return mix(found ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), starts


def pieces(text: bytes):
    """A long text in pieces that end between words."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        cut = max(text.rfind(bytes([s]), at, at + CHUNK_BYTES) for s in _SEPARATORS)
        if cut < 0:
            later = [p for s in _SEPARATORS if (p := text.find(bytes([s]), at + CHUNK_BYTES)) >= 0]
            cut = min(later, default=len(text) - 1)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def document_words(texts: list[bytes]):
    """The word hashes of each text, in order; no words for an empty text."""
    for first, last in texts_by_size(texts, CHUNK_BYTES):
        if last - first == 1 and len(texts[first]) > CHUNK_BYTES:
            yield np.concatenate([_hashes(piece + b" ")[0] for piece in pieces(texts[first])])
            continue
        group = texts[first:last]
        found, starts = _hashes(b" ".join(group) + b" ")
        sizes = np.fromiter((len(t) + 1 for t in group), np.int64, len(group))
        yield from np.split(found, np.searchsorted(starts, np.cumsum(sizes)[:-1]))


def column_bytes(column) -> list[bytes]:
    """The texts of an Arrow column as bytes; null becomes empty."""
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column]
