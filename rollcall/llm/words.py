"""
Words of whole texts, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, with A-Z lower-cased: the pattern
[^\\x20\\x09-\\x0D]+. Every word gets a 64-bit hash; two words are taken as equal if their hashes
are. A batch is worked through in slices of bounded size, each holding at least one text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 500_000

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):       # another C library than GNU's
    _trim = None


def give_back() -> None:
    """Return memory that this worker has freed to the system; earlier tasks leave much of it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def stream(seed: int, count: int) -> np.ndarray:
    """The first `count` 64-bit numbers of a fixed pseudorandom sequence."""
    start = mix(np.array([seed], np.uint64))[0]
    with np.errstate(over="ignore"):
        return mix(start + np.arange(1, count + 1, dtype=np.uint64) * _ODD)


_BYTE_CODES = stream(1, 256)
for _upper in range(65, 91):
    _BYTE_CODES[_upper] = _BYTE_CODES[_upper + 32]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_CODES[_IS_SPACE] = 0
_BASE = stream(2, 1)[0] | np.uint64(1)


def powers(count: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(1, count), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """
    The words of some texts, in order. `first` has, for each text and one more, the index of its
    first word; starts and ends are byte positions in `data`, in which text i takes the bytes
    offsets[i] to offsets[i + 1].
    """

    row: int                 # index of the first text in its batch
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    codes: np.ndarray        # 64-bit hash of each word

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self)), self.counts)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if column.offset:
        column = pa.concat_arrays([column])
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1) \
        if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES,
                between: np.ndarray = _IS_SPACE) -> Iterator[Words]:
    """The words of a text column, some texts at a time; `between` tells for each byte whether it
    separates words."""
    give_back()
    data, offsets = buffers(column)
    row = 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + slice_bytes, "right")) - 1
        end = min(max(end, row + 1), len(offsets) - 1)
        own = offsets[row:end + 1] - offsets[row]
        yield _split(row, data[offsets[row]:offsets[end]], own, between)
        row = end


def _split(row: int, data: np.ndarray, offsets: np.ndarray, between: np.ndarray) -> Words:
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(row, data, offsets, none, none, np.zeros(len(offsets), np.int64),
                     np.zeros(0, np.uint64))
    inside = ~between[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.concatenate([[False], inside[:-1]])
    before[edges] = False
    after = np.concatenate([inside[1:], [False]])
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(row, data, offsets, starts, ends, first, np.zeros(0, np.uint64))
    lengths = ends - starts
    factors = powers(int(lengths.max()))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    np.minimum(place, len(factors) - 1, out=place)
    values = np.where(between, np.uint64(0), _BYTE_CODES)
    codes = np.add.reduceat(values[data[starts[0]:]] * factors[place], starts - starts[0])
    codes = mix(codes ^ (lengths.astype(np.uint64) * _ODD))
    return Words(row, data, offsets, starts, ends, first, codes)


def fold(codes: np.ndarray, at: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash of the `width` words from each position in `at` on, in order."""
    out = np.full(len(at), mix(np.array([seed * 64 + width], np.uint64))[0])
    for k in range(width):
        out = mix((out ^ codes[at + k]) * _ODD)
    return out


def shingle_sets(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """
    (sorted distinct shingles of all texts one behind the other, their number per text).

    A text with fewer than `width` words, but at least one, has its whole sequence as one.
    """
    counts = words.counts
    text = words.texts()
    last = len(text) - width
    at = np.flatnonzero(text[:last + 1] == text[width - 1:]) if last >= 0 else np.zeros(0, np.int64)
    parts, owners = [fold(words.codes, at, width)], [text[at]]
    for short in range(1, width):
        own = np.flatnonzero(counts == short)
        parts.append(fold(words.codes, words.first[own], short))
        owners.append(own)
    codes, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return codes[fresh], np.bincount(owner[fresh], minlength=len(words))


def prefix_codes(words: Words, at: np.ndarray, width: int) -> np.ndarray:
    """A hash of the first `width` bytes of the words at `at`; of a word that is not longer, one that
    tells it from longer words that begin so."""
    if not len(at):
        return np.zeros(0, np.uint64)
    starts, lengths = words.starts[at], words.ends[at] - words.starts[at]
    cut = np.minimum(lengths, width)
    first = np.cumsum(cut) - cut
    place = np.arange(first[-1] + cut[-1]) - np.repeat(first, cut)
    values = _BYTE_CODES[words.data[np.repeat(starts, cut) + place]] \
        * powers(int(cut.max()))[place]
    sums = np.add.reduceat(values, first)
    return mix(sums ^ ((2 * cut + (lengths <= width)).astype(np.uint64) * _ODD))
