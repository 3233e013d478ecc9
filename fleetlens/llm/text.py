"""Words of whole texts as 64-bit hashes, computed over Arrow buffers without Python strings.

A word is a longest run of ASCII letters, digits and non-ASCII characters of the lower-cased text.
Work goes through slices of about a megabyte that end between words, so memory is bounded by
the slice, the longest word and eight bytes per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x80:] = True
for _low, _high in ((b"0", b"9"), (b"a", b"z"), (b"A", b"Z")):
    _IS_WORD[_low[0] : _high[0] + 1] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the base and of its inverse, grown to the longest slice seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            ones = np.ones(n, dtype=np.uint64)
            self.up, self.down = ones * _BASE, ones * _INVERSE
            self.up[0] = self.down[0] = 1
            self.up = np.multiply.accumulate(self.up)
            self.down = np.multiply.accumulate(self.down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Words:
    """Hashes of all words of a batch in order; words of text i are hashes[first[i]:first[i+1]]."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by a line feed, and the offset of each text; null
    texts count as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    empty, feed = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    column = pc.binary_join_element_wise(column, empty, feed)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, size: int = SLICE):
    """Bounds of slices that end after a byte outside words."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data):
            gap = np.flatnonzero(~_IS_WORD[data[end : end + 4096]])
            if len(gap):
                end += int(gap[0]) + 1
                break
            end += 4096
        end = min(end, len(data))
        yield at, end
        at = end


def _word_bounds(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(part) + 2, dtype=np.int8)
    inside[1:-1] = _IS_WORD[part]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hash_words(column: pa.Array) -> Words:
    data, offsets = texts_of(column)
    starts, hashes = [], []
    for at, end in slices(data):
        part = data[at:end]
        first, last = _word_bounds(part)
        if not len(first):
            continue
        up, down = _POWERS.of(len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * up, out=total[1:])
        hashes.append(mix((total[last] - total[first]) * down[first]))
        starts.append(first + at)
    if not starts:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    first = np.searchsorted(np.concatenate(starts), offsets)
    return Words(np.concatenate(hashes), first)


def shingles(words: Words, size: int = SHINGLE) -> Words:
    """Hashes of all runs of ``size`` words; a shorter text with any word has one run, of all."""
    h, counts = words.hashes, words.counts
    if not len(h):
        return Words(h, words.first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(words.first[:-1] - first[:-1], n) + np.arange(first[-1])
    left = np.repeat(words.first[1:], n) - at
    out = np.zeros(len(at), dtype=np.uint64)
    factor = np.uint64(1)
    for k in range(size):
        word = h[np.minimum(at + k, len(h) - 1)]
        out += np.where(left > k, word, np.uint64(k + 1)) * factor
        factor = np.uint64((int(factor) * int(_BASE)) & 0xFFFFFFFFFFFFFFFF)
    return Words(mix(out), first)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over the rows first[i]:first[i+1]; empty ranges give zero."""
    total = np.zeros((len(first) - 1, *values.shape[1:]), dtype=values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        total[full] = np.add.reduceat(values, first[full], axis=0)
    return total


def parts(words: Words, size: int = 1 << 18):
    """Ranges of texts that hold about ``size`` words together, at least one text each."""
    at, n = 0, len(words.first) - 1
    while at < n:
        end = int(np.searchsorted(words.first, words.first[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end
