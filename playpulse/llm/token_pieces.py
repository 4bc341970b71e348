"""Token ids of many texts at once: each distinct piece of text is tokenized once per worker.

Texts are cut into pieces at places where the tokenizer's own pre-tokenization always cuts
and nothing to the left or right matters: at blanks and line feeds, and between an ASCII
letter or digit and other ASCII that is no apostrophe. The ids of a text are then the ids
of its pieces, one after the other. Pieces go through the tokenizers library; a table of
fixed size keeps their ids by a 64-bit hash. Pieces longer than KEPT_BYTES are always
tokenized anew, and a text that spells a special token is one piece. Where tokens show the
end of a word, new pieces of letters are joined by blanks and tokenized together, and their
ids are told apart by these ends; every such piece is one word or more, so if a joined text
has as many ends as pieces, each is one word, and if not, it is tokenized piece by piece.
Where the tokenizer lower-cases after composing characters, A-Z count as a-z in a piece
except before a byte outside ASCII, which may compose with them.

This holds for tokenizers that split words from punctuation and drop white space, such as
word_bpe_49k; for another, the cutting must be checked first.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from playpulse.llm import bytewords

KEPT_BYTES = 48
_SLOTS = 1 << 21
_MOST_ENTRIES = 1 << 20
_AT_ONCE = 2048
_JOINED = 256

_BLANK, _LETTER, _DIGIT, _OTHER, _OPEN = range(5)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[10, 32]] = _BLANK
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[39] = _KIND[128:] = _OPEN  # never cut beside an apostrophe or a byte outside ASCII
_CUT = np.zeros((5, 5), dtype=bool)
_CUT[_BLANK, :] = _CUT[:, _BLANK] = True
for _a, _b in ((_LETTER, _DIGIT), (_LETTER, _OTHER), (_DIGIT, _OTHER)):
    _CUT[_a, _b] = _CUT[_b, _a] = True
_VALUES = bytewords.mix(np.arange(1, 257))


def _word_ends(definition: str, n_ids: int) -> np.ndarray | None:
    """Which ids end a word; None where the model does not mark that for every byte."""
    from tokenizers.pre_tokenizers import ByteLevel

    known = json.loads(definition)
    suffix, vocabulary = known["model"].get("end_of_word_suffix"), known["model"]["vocab"]
    if not suffix or '"ByteLevel"' not in json.dumps(known["pre_tokenizer"]):
        return None
    if any(c not in vocabulary or c + suffix not in vocabulary for c in ByteLevel.alphabet()):
        return None
    ends = np.zeros(n_ids, dtype=bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def _letters(text: str) -> bool:
    """Whether a piece is of letters, composed and lower-cased too."""
    return text.isalpha() and (
        text.isascii() or unicodedata.normalize("NFC", text).lower().isalpha()
    )


def _lowers(definition: str) -> bool:
    """Whether the tokenizer lower-cases, and does nothing else but compose and blank."""
    normalizer = json.loads(definition).get("normalizer") or {}
    steps = normalizer.get("normalizers", [normalizer])
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    kinds = [s.get("type") for s in steps if s != blanks]
    return "Lowercase" in kinds and set(kinds) <= {"NFC", "Lowercase"}


class Tokens:
    """A tokenizer with the ids of the pieces seen so far."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lowers = _lowers(definition)
        n_ids = max(self.tokenizer.get_vocab().values(), default=0) + 1
        self.word_end = _word_ends(definition, n_ids)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(_SLOTS, dtype=np.uint64)
        self.entry = np.zeros(_SLOTS, dtype=np.int32)
        self.begin = np.zeros(1, dtype=np.int64)
        self.pool = np.empty(0, dtype=np.uint32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        at = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            key = self.keys[at[open_]]
            hit = key == hashes[open_]
            found[open_[hit]] = self.entry[at[open_[hit]]]
            open_ = open_[~hit & (key != 0)]
            at[open_] = (at[open_] + 1) % _SLOTS
        return found

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for at in range(0, len(texts), _AT_ONCE):
            some = texts[at : at + _AT_ONCE]
            for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                yield np.array(e.ids, dtype=np.uint32)

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece)."""
        texts = [p.decode() for p in pieces]
        counts = np.zeros(len(texts), dtype=np.int64)
        held, places, alone = [], [], np.arange(len(texts))
        if self.word_end is not None:
            plain = np.fromiter(map(_letters, texts), dtype=bool, count=len(texts))
            at, rest = np.flatnonzero(plain), [np.flatnonzero(~plain)]
            groups = [at[i : i + _JOINED] for i in range(0, len(at), _JOINED)]
            joined = [" ".join([texts[i] for i in g.tolist()]) for g in groups]
            for group, ids in zip(groups, self._encoded(joined), strict=True):
                ends = np.flatnonzero(self.word_end[ids])
                if len(ends) == len(group) and ends[-1] == len(ids) - 1:
                    counts[group] = np.diff(ends, prepend=-1)
                    held.append(ids)
                    places.append(group)
                else:
                    rest.append(group)
            alone = np.concatenate(rest)
        for i, ids in zip(alone.tolist(), self._encoded([texts[i] for i in alone.tolist()]), strict=True):
            counts[i] = len(ids)
            held.append(ids)
        places = np.concatenate([*places, alone])
        flat = np.concatenate(held) if held else np.empty(0, dtype=np.uint32)
        # flat follows places; put the ids in the order of the pieces
        starts = np.empty(len(texts), dtype=np.int64)
        starts[places] = np.cumsum(counts[places]) - counts[places]
        return flat[bytewords.expand(starts, counts)], counts

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> int:
        """Enter new pieces; the entry of the first, which the others follow."""
        if len(self.begin) + len(pieces) > _MOST_ENTRIES:
            self._clear()
        first = len(self.begin) - 1
        flat, counts = self._ids(pieces)
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(counts))
        self.pool = np.append(self.pool, flat)
        at = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            free = open_[self.keys[at[open_]] == 0]
            _, one = np.unique(at[free], return_index=True)  # one newcomer for each free slot
            placed = free[one]
            self.keys[at[placed]] = hashes[placed]
            self.entry[at[placed]] = first + placed
            open_ = open_[self.keys[at[open_]] != hashes[open_]]
            at[open_] = (at[open_] + 1) % _SLOTS
        return first

    def _pieces(
        self, data: np.ndarray, starts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of a slice, and its bytes in the case that counts."""
        kind = _KIND[data]
        cut = np.empty(len(data), dtype=bool)
        cut[:1] = True
        cut[1:] = _CUT[kind[:-1], kind[1:]]
        used = starts[:-1][np.diff(starts) > 0]
        cut[used] = True
        dropped = kind == _BLANK
        raw = data.tobytes()
        folded = np.zeros(len(data), dtype=bool)
        if self.lowers:
            folded = (data >= 65) & (data <= 90)
            folded[:-1] &= data[1:] < 128
        if any(s in raw for s in self.special):
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if any(s in raw[a:b] for s in self.special):
                    cut[a + 1 : b] = False
                    dropped[a:b] = False
                    folded[a:b] = False
        begins = np.flatnonzero(cut)
        ends = np.append(begins[1:], len(data))
        keep = ~dropped[begins]
        return begins[keep], ends[keep], data + (folded.view(np.uint8) << 5)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i of a slice are ids[bounds[i]:bounds[i + 1]]."""
        begins, ends, data = self._pieces(data, starts)
        short = ends - begins <= KEPT_BYTES
        hashes = np.ones(len(begins), dtype=np.uint64)
        if len(data) <= bytewords.SLICE_BYTES:
            hashes[short] = bytewords.byte_hashes(data, begins[short], ends[short], _VALUES)
        else:
            hashes[short] = _in_parts(data, begins[short], ends[short])
        hashes[hashes == 0] = 1
        entry = np.full(len(begins), -1, dtype=np.int64)
        entry[short] = self._find(hashes[short])
        new = np.flatnonzero(short & (entry < 0))
        if len(new):
            known = len(self.begin) - 1
            fresh, first, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            at = self._learn(fresh, [data[begins[i] : ends[i]].tobytes() for i in new[first]])
            entry[new] = at + which
            if at < known:  # the table was emptied: every piece anew
                fresh, first, which = np.unique(
                    hashes[short], return_index=True, return_inverse=True
                )
                places = np.flatnonzero(short)[first]
                self._clear()
                self._learn(fresh, [data[begins[i] : ends[i]].tobytes() for i in places])
                entry[short] = which
        begin = np.zeros(len(begins), dtype=np.int64)
        count = np.zeros(len(begins), dtype=np.int64)
        begin[short] = self.begin[entry[short]]
        count[short] = self.begin[entry[short] + 1] - begin[short]
        pool, long = self.pool, np.flatnonzero(~short)
        if len(long):
            flat, counts = self._ids([data[begins[i] : ends[i]].tobytes() for i in long])
            begin[long] = len(pool) + np.cumsum(counts) - counts
            count[long] = counts
            pool = np.append(pool, flat)
        reached = np.append(0, np.cumsum(count))
        bounds = reached[np.searchsorted(begins, starts)]
        return pool[bytewords.expand(begin, count)], bounds


def _in_parts(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of short spans of data longer than a slice."""
    hashes, at, part = np.empty(len(begins), dtype=np.uint64), 0, bytewords.SLICE_BYTES
    while at < len(begins):
        origin = begins[at]
        to = int(np.searchsorted(ends, origin + part, side="right"))
        piece = data[origin : ends[to - 1]]
        hashes[at:to] = bytewords.byte_hashes(
            piece, begins[at:to] - origin, ends[at:to] - origin, _VALUES
        )
        at = to
    return hashes


_LOADED: dict[str, Tokens] = {}


def tokens(definition: str) -> Tokens:
    """The tokenizer of this definition, kept by the worker between batches and tasks."""
    if definition not in _LOADED:
        _LOADED.clear()
        _LOADED[definition] = Tokens(definition)
    return _LOADED[definition]


def forget() -> None:
    """Give up the worker's tokenizer and pieces, and the memory that Arrow holds unused."""
    if _LOADED:
        _LOADED.clear()
        pa.default_memory_pool().release_unused()


def encoded(
    definition: str, column: pa.Array, end_id: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, bounds) of slices of a text column; every text ends with end_id."""
    coder = tokens(definition)
    for first_row, data, starts in bytewords.text_slices(column):
        ids, bounds = coder.encode(data, starts)
        ids = np.insert(ids, bounds[1:], np.uint32(end_id))
        yield first_row, ids, bounds + np.arange(len(bounds))
