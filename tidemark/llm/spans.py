"""Words and character n-grams of a batch of texts, as numpy arrays.

Texts come as an Arrow string column and stay bytes: words are pairs of byte
offsets, and the hash of any stretch of bytes follows from running sums. Columns
are handled in pieces of whole texts of about ``PIECE`` bytes, so that memory is
bounded by the piece or by one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import SPACE_BYTES

PIECE = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_BYTES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Letters of ASCII and every byte of a longer code point.
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True

_DRAW = np.random.Generator(np.random.PCG64(20240229))
_CODES = _DRAW.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Piece(NamedTuple):
    """Texts ``first`` .. of a column: their bytes, and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """Runs of whole texts of up to ``limit`` bytes, or one longer text; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, where, data = column.buffers()
    where = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(where, where[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Piece(at, data[where[at] : where[to]], where[at : to + 1] - where[at])
        at = to


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ~IS_SPACE) -> Words:
    """Longest runs of bytes of a ``kind`` within each text."""
    inside = kind[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1)


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of stretches of ``data`` by their bytes; equal bytes, equal hashes."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Hasher._up) < n + 1:
            size = max(n + 1, PIECE + 1)
            Hasher._up = np.full(size, _BASE)
            Hasher._down = np.full(size, _UNBASE)
            Hasher._up[0] = Hasher._down[0] = 1
            np.cumprod(Hasher._up, out=Hasher._up)
            np.cumprod(Hasher._down, out=Hasher._down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * Hasher._up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * Hasher._down[start])


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 0, 3): owners 0 0 2 2 2 and places 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, place


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size`` words in a row per text, sorted by (text, hash).

    A text of fewer words has its whole sequence as the one shingle, and one
    without words has none.
    """
    count = np.bincount(text, minlength=n_texts)
    first = np.cumsum(count) - count
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    owner, place = spread(made)
    at = first[owner] + place
    last = first[owner] + count[owner]
    mixed = np.zeros(len(at), np.uint64)
    for i in range(size):
        here = at + i < last
        word = np.where(here, hashes[np.minimum(at + i, len(hashes) - 1)], np.uint64(i + 1)) if len(at) else mixed
        mixed = scramble(mixed * _BASE + word)
    order = np.lexsort((mixed, owner))
    owner, mixed = owner[order], mixed[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (mixed[1:] != mixed[:-1])
    return owner[new], mixed[new]


class Characters:
    """Code points of ``data``, so that n-grams and affixes are cut between them."""

    def __init__(self, data: np.ndarray):
        self.begin = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))

    def place(self, at: np.ndarray) -> np.ndarray:
        """Number of the code point that begins at byte ``at``."""
        return np.searchsorted(self.begin, at)


def ngrams(
    hasher: Hasher, chars: Characters, start: np.ndarray, end: np.ndarray, sizes: tuple[int, ...]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, (word number, hash) of all n-grams of that many code points in the words."""
    low, high = chars.place(start), chars.place(end)
    for n in sizes:
        word, place = spread(np.maximum(high - low - n + 1, 0))
        at = low[word] + place
        yield word, hasher.of(chars.begin[at], chars.begin[at + n])


def affixes(
    hasher: Hasher, chars: Characters, start: np.ndarray, end: np.ndarray, sizes: tuple[int, ...]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, (word number, hash) of the first and of the last n code points, marked as such."""
    low, high = chars.place(start), chars.place(end)
    for n in sizes:
        word = np.flatnonzero(high - low >= n)
        first = hasher.of(start[word], chars.begin[low[word] + n])
        yield word, scramble(first + np.uint64(2 * n))
        last = hasher.of(chars.begin[high[word] - n], end[word])
        yield word, scramble(last + np.uint64(2 * n + 1))
