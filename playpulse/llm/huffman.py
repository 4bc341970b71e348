"""Canonical Huffman coding of token ids with a limit on code length, by numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols between two checkpoints of the bit offset.
STEP = 128


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code in which none exceeds the limit (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes longer than {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    weights, from_leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        pairs = len(weights) // 2
        packages = weights[: 2 * pairs : 2] + weights[1 : 2 * pairs : 2]
        both = np.concatenate((leaves, packages))
        place = np.argsort(both, kind="stable")
        weights = both[place]
        from_leaf.append(place < n)
    lengths, wanted = np.zeros(n, dtype=np.int64), 2 * n - 2
    for flags in reversed(from_leaf):
        chosen = int(flags[:wanted].sum())
        lengths[:chosen] += 1
        wanted = 2 * (wanted - chosen)
    result = np.empty(n, dtype=np.int64)
    result[order] = lengths
    return result


@dataclass
class Code:
    """A canonical code: symbols by (length, symbol) get consecutive codewords."""

    symbols: np.ndarray
    lengths: np.ndarray

    def __post_init__(self) -> None:
        order = np.lexsort((self.symbols, self.lengths))
        self.symbols = np.asarray(self.symbols, dtype=np.int64)[order]
        self.lengths = np.asarray(self.lengths, dtype=np.int64)[order]
        self.width = int(self.lengths[-1]) if len(self.lengths) else 0
        # In units of the longest code each codeword is the sum of the spans before it.
        spans = np.int64(1) << (self.width - self.lengths)
        self.words = (np.cumsum(spans) - spans) >> (self.width - self.lengths)

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Codeword and length by symbol."""
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 0
        words, lengths = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        words[self.symbols], lengths[self.symbols] = self.words, self.lengths
        return words, lengths

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length by the next `width` bits."""
        spans = np.int64(1) << (self.width - self.lengths)
        symbols, lengths = np.repeat(self.symbols, spans), np.repeat(self.lengths, spans)
        rest = (1 << self.width) - len(symbols)  # a single symbol leaves half the table
        return np.pad(symbols, (0, rest)).astype(np.uint32), np.pad(lengths, (0, rest))


def encode(
    ids: np.ndarray, bounds: np.ndarray, words: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, byte bounds, bits of each step, step bounds) of several texts.

    Each text begins on a byte, and has ceil(ids / STEP) steps.
    """
    bits = lengths[ids]
    reached = np.append(0, np.cumsum(bits))
    n_bytes = -(-np.diff(reached[bounds]) // 8)
    byte_bounds = np.append(0, np.cumsum(n_bytes))
    shift = 8 * byte_bounds[:-1] - reached[bounds[:-1]]
    places = reached[:-1] + np.repeat(shift, np.diff(bounds))
    # Each codeword falls into a 32-bit cell and the one after it.
    cell, inside = places >> 5, places & 31
    value = words[ids] << (64 - inside - bits).astype(np.uint64)
    out = np.zeros(int(byte_bounds[-1] // 4) + 2, dtype=np.uint32)
    if len(ids):
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        high = np.bitwise_or.reduceat((value >> np.uint64(32)).astype(np.uint32), first)
        low = np.bitwise_or.reduceat(value.astype(np.uint32), first)
        out[cell[first]] |= high
        out[cell[first] + 1] |= low
    data = out.astype(">u4").view(np.uint8)[: byte_bounds[-1]]
    n_steps = -(-np.diff(bounds) // STEP)
    step_bounds = np.append(0, np.cumsum(n_steps))
    text = np.repeat(np.arange(len(n_steps)), n_steps)
    turn = np.arange(step_bounds[-1]) - step_bounds[text]
    begin = bounds[text] + turn * STEP
    end = np.minimum(begin + STEP, bounds[text + 1])
    return data, byte_bounds, (reached[end] - reached[begin]).astype(np.uint32), step_bounds


def decode(
    data: np.ndarray,
    byte_starts: np.ndarray,
    n_ids: np.ndarray,
    step_bits: np.ndarray,
    symbols: np.ndarray,
    lengths: np.ndarray,
) -> np.ndarray:
    """The ids of several texts, one after the other; all steps are decoded side by side."""
    width = len(symbols).bit_length() - 1
    n_steps = -(-n_ids // STEP)
    total = int(n_ids.sum())
    if not total:
        return np.empty(0, dtype=np.uint32)
    text = np.repeat(np.arange(len(n_ids)), n_steps)
    step_start = np.cumsum(n_steps) - n_steps
    turn = np.arange(len(text)) - step_start[text]
    reached = np.cumsum(step_bits.astype(np.int64)) - step_bits
    place = 8 * byte_starts[text] + reached - reached[step_start[text]]
    left = np.minimum(STEP, n_ids[text] - turn * STEP)
    target = (np.cumsum(n_ids) - n_ids)[text] + turn * STEP
    # The 32 bits from each byte on, so that a peek is one lookup and two shifts.
    b = np.concatenate((data, np.zeros(4, dtype=np.uint8))).astype(np.uint32)
    ahead = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    out = np.empty(total, dtype=np.uint32)
    longest = np.argsort(-left, kind="stable")
    place, left, target = place[longest], left[longest], target[longest]
    active = len(left)
    for turn in range(STEP):
        active = int(np.searchsorted(-left[:active], -turn, side="left"))
        if not active:
            break
        at = place[:active]
        peek = (ahead[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - width)
        out[target[:active] + turn] = symbols[peek]
        place[:active] = at + lengths[peek]
    return out
