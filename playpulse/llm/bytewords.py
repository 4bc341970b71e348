"""Words of many texts at once, by numpy over their UTF-8 bytes.

A word is a run of ASCII digits, ASCII letters and bytes from 0x80 (every byte of a
character outside ASCII); A-Z count as a-z. Texts come as an Arrow column, and a word is
known by its place and a 64-bit hash. Long columns are cut into slices of about
SLICE_BYTES, so the arrays stay small whatever the batch holds; one text longer than that
is a slice of its own, hashed in pieces that end between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=_U)
    factors[0] = 1
    return np.cumprod(factors)


_POWERS = _powers(_BASE, SLICE_BYTES + 2)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), SLICE_BYTES + 2)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[65:91] = _IN_WORD[128:] = True
#: A number for each byte after lower-casing; the hash of a word is a polynomial in them.
BYTE_VALUE = mix(np.arange(1, 257))[_LOWER]


@dataclass
class Words:
    """Words of a slice of texts, in order; those of text i are bounds[i] to bounds[i + 1]."""

    first_row: int
    data: np.ndarray
    text_starts: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        """For each word, the number of its text within the slice."""
        return np.repeat(np.arange(self.n_texts), self.counts)

    def text(self, i: int) -> bytes:
        return self.data[self.text_starts[i] : self.text_starts[i + 1]].tobytes()

    def word(self, j: int) -> bytes:
        return _LOWER[self.data[self.starts[j] : self.ends[j]]].tobytes()


def text_slices(
    column: pa.Array | pa.ChunkedArray,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, text starts) of slices of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    values = np.frombuffer(data or b"", dtype=np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(starts, starts[row] + SLICE_BYTES, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, values[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
        row = end


def byte_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Hashes of the given spans of data (in order, none across a piece of SLICE_BYTES)."""
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(values[data] * _POWERS[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(_U)
    return mix((sums[ends] - sums[starts]) * _INVERSE[starts] + lengths * _U(0xD6E8FEB86659FD93))


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if len(data) <= SLICE_BYTES:
        return byte_hashes(data, starts, ends, BYTE_VALUE)
    hashes, at = np.empty(len(starts), dtype=_U), 0
    while at < len(starts):
        origin = starts[at]
        to = int(np.searchsorted(ends, origin + SLICE_BYTES, side="right"))
        if to == at:  # one word longer than a piece: its pieces' hashes are hashed in turn
            word = data[origin : ends[at]]
            cuts = np.arange(0, len(word), SLICE_BYTES)
            parts = [
                byte_hashes(piece, np.array([0]), np.array([len(piece)]), BYTE_VALUE)[0]
                for piece in (word[c : c + SLICE_BYTES] for c in cuts)
            ]
            hashes[at] = rolling(np.array(parts, dtype=_U), len(parts))[0]
            to = at + 1
        else:
            piece = data[origin : ends[to - 1]]
            hashes[at:to] = byte_hashes(
                piece, starts[at:to] - origin, ends[at:to] - origin, BYTE_VALUE
            )
        at = to
    return hashes


def words(column: pa.Array | pa.ChunkedArray) -> Iterator[Words]:
    """The words of a text column, slice by slice."""
    for first_row, data, text_starts in text_slices(column):
        inside = _IN_WORD[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        # A text's first byte begins a word even where the last text ended with one.
        firsts = text_starts[:-1][text_starts[:-1] < len(data)]
        before[firsts] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros_like(inside)
        after[:-1] = inside[1:]
        after[firsts[firsts > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        bounds = np.searchsorted(starts, text_starts)
        yield Words(
            first_row, data, text_starts, bounds, starts, ends, _hash_spans(data, starts, ends)
        )


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; element i is of the words i to i + k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    total = np.zeros(n, dtype=_U)
    for j in range(k):
        total = total * _U(0xD1342543DE82EF95) + hashes[j : j + n]
    return mix(total)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0] + 1, ... of each span, one span after the other."""
    total = int(lengths.sum())
    steps = np.ones(total, dtype=np.int64)
    used = lengths > 0
    s, n = starts[used], lengths[used]
    if not len(s):
        return np.empty(0, dtype=np.int64)
    steps[0] = s[0]
    steps[np.cumsum(n)[:-1]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(steps)
