"""Removal of repeated word sequences by super-k-mer partitioning.

Words are runs of bytes other than ASCII white space, unchanged. A window is K consecutive
words of one document. A word goes if a window that covers it stands earlier too: in a
document of smaller id, or earlier in its own. Windows are judged on the input.

Method: the minimiser of a window is the smallest hash of its M-word grams (the first of
equal ones). Consecutive windows whose minimiser is the same place of the text form a
super-k-mer, which travels as one packed string to the bucket of the minimiser. Equal
windows have equal minimisers and so meet in one bucket, at about three words moved for each
word instead of K. Strings are packed reversibly, common words as codes of two or three
bytes. In the bucket the windows are sorted by hash, and windows of equal hash are compared
byte by byte, so counts are exact.

Hot minimisers (those of frequent phrases, and of texts copied thousands of times) are
found by a first pass that counts. Their super-k-mers are cut into single windows, each in
a bucket by its own hash, and equal ones are folded inside a task before they travel: of
all but the earliest it is known at once that they repeat. Which minimisers are hot decides
where windows travel, never what is found.

Plan: documents are read three times (count, cut, apply); one shuffle of packed strings by
bucket, sorted by place; only the places of repeated windows come out of it, are grouped by
document and joined to the texts. No group of unbounded size is held: a bucket has a
bounded number of strings (HOT_MOST and what a task may leave uncounted), a document's
places no more than its words.

Defined cases: a null text has no words and stays null, an empty one stays empty. Rows equal
in doc_id and text are one document and get equal results. Rows of equal doc_id and
different texts are documents of their own, in the order of the texts' hashes; a null
doc_id comes after all others. Texts may be of any length. With no rows there are no rows.
Other columns pass through, whatever their names; columns n_words and n_removed of the input
are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.llm import bitfilter, bytewords
from playpulse.llm.scratch import cut

K = 20
M = 3
#: A minimiser is hot above total / 2**HOT_SHIFT super-k-mers, within these bounds.
HOT_SHIFT, HOT_LEAST, HOT_MOST = 10, 512, 20_000
#: Minimisers that a task has met fewer times are not counted in the first pass.
TASK_LEAST = 4
#: One word in so many is counted for the codes, and a task names so many of the commonest.
SAMPLED, TASK_WORDS = 8, 1 << 13
#: Single windows that a task folds at once.
FOLDED = 50_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


class Words:
    """The words of a slice of texts: joined by single spaces, with places and hashes."""

    def __init__(self, first_row: int, data: np.ndarray, text_starts: np.ndarray) -> None:
        # A space after each text keeps its last word apart from the next text's first.
        n = len(text_starts) - 1
        apart = np.insert(data, text_starts[1:], 32)
        inside = ~_SPACE[apart]
        after_word = np.zeros_like(inside)
        after_word[1:] = inside[:-1] & ~inside[1:]
        taken = inside | after_word
        self.first_row = first_row
        self.data = np.where(inside, apart, np.uint8(32))[taken]
        self.ends = np.flatnonzero(self.data == 32)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        word_ends = np.flatnonzero(after_word)  # in `apart`, one for each word
        self.bounds = np.searchsorted(word_ends, text_starts + np.arange(n + 1))
        self.hashes = bytewords._hash_spans(self.data, self.starts, self.ends)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(column: pa.Array | pa.ChunkedArray) -> Iterator[Words]:
    for first_row, data, text_starts in bytewords.text_slices(column):
        yield Words(first_row, data, text_starts)


# Packed words: one of the commonest is a code of two or three bytes, any other its bytes and
# a space. Codes begin with a byte that UTF-8 does not have and go on with others that are
# neither such a byte nor a space, so the ends of words can be told.
_LEADS_2 = np.array([0xC0, 0xC1, *range(0xF5, 0xFC)], dtype=np.uint8)
_LEADS_3 = np.arange(0xFC, 0x100).astype(np.uint8)
_CODE_SIZE = np.zeros(256, dtype=np.int64)  # by the first byte; 0: none
_CODE_SIZE[_LEADS_2], _CODE_SIZE[_LEADS_3] = 2, 3
_NEXT = np.array([b for b in range(256) if b != 32 and not _CODE_SIZE[b]], dtype=np.uint8)
_SHORT = len(_LEADS_2) * len(_NEXT)
CODED = 1 << 16
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
LONGEST_CODED = 16


def _sixteen(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bytes of each word as two integers, and its length; exact for words of 16 bytes at most."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    eights = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    n = ends - starts
    low = eights[starts] & _MASKS[np.minimum(n, 8)]
    return low, eights[starts + 8] & _MASKS[np.clip(n - 8, 0, 8)], n


def _spread(low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
    return bytewords.mix(low + bytewords.mix(high + n.astype(np.uint64)))


class Codes:
    """Short codes of the commonest words, the commonest first."""

    def __init__(self, common: list[bytes]) -> None:
        common = [w for w in dict.fromkeys(common) if len(w) <= LONGEST_CODED][:CODED]
        data = np.frombuffer(b"".join(common) or b"", dtype=np.uint8)
        ends = np.cumsum([len(w) for w in common], dtype=np.int64)
        low, high, n = _sixteen(data, ends - np.diff(ends, prepend=0), ends)
        keys = _spread(low, high, n)
        rank, steps = np.arange(len(common)), len(_NEXT)
        long = rank >= _SHORT
        rest = np.where(long, rank - _SHORT, rank)
        first = np.where(long, _LEADS_3[rest // steps**2 % 4], _LEADS_2[rest // steps % 9])
        second = np.where(long, _NEXT[rest // steps % steps], _NEXT[rest % steps])
        code = np.stack([first, second, _NEXT[rest % steps]], axis=1).astype(np.uint8)
        _, one = np.unique(keys, return_index=True)  # of words with one key only the first
        self.keys, self.low, self.high, self.n = keys[one], low[one], high[one], n[one]
        self.code, self.size = code[one], np.where(long, 3, 2)[one]

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(whether it has a code, its place here) of each word."""
        low, high, n = _sixteen(words.data, words.starts, words.ends)
        keys = _spread(low, high, n)
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.low[at] == low) & (self.high[at] == high) & (self.n[at] == n)
        return found, at


class Packed:
    """The packed words of a slice of texts, and strings of consecutive ones."""

    def __init__(self, words: Words, codes: Codes) -> None:
        coded, at = codes.find(words)
        plain = words.ends + 1 - words.starts
        sizes = np.where(coded, codes.size[at] if len(codes.size) else 0, plain)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.data = np.empty(int(sizes.sum()), dtype=np.uint8)
        to, code = self.starts[coded], codes.code[at[coded]]
        self.data[to], self.data[to + 1] = code[:, 0], code[:, 1]
        three = sizes[coded] == 3
        self.data[to[three] + 2] = code[three, 2]
        free = ~coded
        self.data[bytewords.expand(self.starts[free], sizes[free])] = words.data[
            bytewords.expand(words.starts[free], sizes[free])
        ]

    def strings(self, firsts: np.ndarray, n_words: np.ndarray) -> pa.Array:
        """The words firsts[i] to firsts[i] + n_words[i] - 1 as one string each."""
        a, b = self.starts[firsts], self.ends[firsts + n_words - 1]
        lengths = b - a
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        values = self.data[bytewords.expand(a, lengths)]
        return pa.Array.from_buffers(
            pa.large_binary(), len(firsts), [None, pa.py_buffer(offsets), pa.py_buffer(values)]
        )


class Unpacked:
    """Where the words of packed strings are, and their hashes."""

    def __init__(self, strings: pa.Array) -> None:
        self.data, text_starts = _flat(strings)
        begins = np.zeros(len(self.data) + 1, dtype=bool)
        begins[text_starts] = True
        begins[np.flatnonzero(self.data == 32) + 1] = True
        sizes = _CODE_SIZE[self.data]
        lead = np.flatnonzero(sizes)
        begins[lead + sizes[lead]] = True
        edges = np.flatnonzero(begins)
        self.starts, self.ends = edges[:-1], edges[1:]
        self.bounds = np.searchsorted(self.starts, text_starts)
        self.hashes = bytewords._hash_spans(self.data, self.starts, self.ends)


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of each `width` consecutive values, by doubling."""
    at = np.arange(len(grams))

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[right] < grams[left], right, left)

    size = 1
    while size * 2 <= width:
        at = better(at[: len(at) - size], at[size:])
        size *= 2
    n = len(grams) - width + 1
    return better(at[:n], at[width - size : width - size + n])


def super_kmers(words: Words, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, minimiser) of each run of windows that share a minimiser's place."""
    n = len(words.hashes) - k + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    grams = bytewords.rolling(words.hashes, m)
    at = _least(grams, k - m + 1)
    rows = words.rows
    valid = rows[:n] == rows[k - 1 :]  # no window goes over the end of a text
    begins, ends = valid.copy(), valid.copy()
    same = valid[1:] & valid[:-1] & (at[1:] == at[:-1])
    begins[1:] &= ~same
    ends[:-1] &= ~same
    firsts = np.flatnonzero(begins)
    return firsts, np.flatnonzero(ends) - firsts + 1, grams[at[firsts]].view(np.int64)


class _Counts:
    """Numbers of equal records, merged now and then so that few are held."""

    def __init__(self, kind: np.dtype) -> None:
        self.values, self.counts = np.empty(0, kind), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.n_waiting += len(values)
        if self.n_waiting > max(1 << 17, len(self.values) // 2):
            self.merge()

    def merge(self) -> None:
        fresh = np.concatenate([self.values, *self.waiting])
        weights = np.ones(len(fresh), np.int64)
        weights[: len(self.counts)] = self.counts
        self.values, inverse = np.unique(fresh, return_inverse=True)
        self.counts = np.bincount(inverse, weights, len(self.values)).astype(np.int64)
        self.waiting, self.n_waiting = [], 0


_WORD = np.dtype([("low", "<u8"), ("high", "<u8"), ("n", "<i8")])


def _counter(k: int, m: int) -> Callable:
    """Numbers of minimisers and of words (a sample of them: they only choose the codes)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minimisers, common, total = _Counts(np.int64), _Counts(_WORD), 0
        for batch in batches:
            for words in words_of(batch.column("text")):
                found = super_kmers(words, k, m)[2]
                total += len(found)
                minimisers.add(found)
                low, high, n = _sixteen(words.data, words.starts[::SAMPLED], words.ends[::SAMPLED])
                fits = n <= LONGEST_CODED
                sample = np.empty(int(fits.sum()), dtype=_WORD)
                sample["low"], sample["high"], sample["n"] = low[fits], high[fits], n[fits]
                common.add(sample)
        minimisers.merge()
        common.merge()
        often = minimisers.counts >= TASK_LEAST
        most = np.argsort(-common.counts, kind="stable")[:TASK_WORDS]
        spelled = [
            (w["low"].tobytes() + w["high"].tobytes())[: int(w["n"])] for w in common.values[most]
        ]
        hashes = minimisers.values[often].tolist()
        yield pa.RecordBatch.from_pydict(
            {
                "hash": pa.array([None, *hashes, *[None] * len(spelled)], pa.int64()),
                "word": pa.array([*[None] * (len(hashes) + 1), *spelled], pa.binary()),
                "n": pa.array(
                    [total, *minimisers.counts[often].tolist(), *common.counts[most].tolist()],
                    pa.int64(),
                ),
            }
        )

    return count


def survey(texts: DataFrame, k: int = K, m: int = M) -> tuple[np.ndarray, Codes]:
    """(a filter of fixed size that lets all hot minimisers through, codes of common words)."""
    counts = cut(
        texts.select("text")
        .mapInArrow(_counter(k, m), "hash long, word binary, n long")
        .groupBy("hash", "word")
        .agg(F.sum("n").alias("n"))
    )
    is_hash, is_word = F.col("hash").isNotNull(), F.col("word").isNotNull()
    total = counts.where(~is_hash & ~is_word).agg(F.max("n")).first()[0] or 0
    bar = min(max(HOT_LEAST, total >> HOT_SHIFT), HOT_MOST)
    hot = bitfilter.build(counts.where(is_hash & (F.col("n") > bar)))
    common = counts.where(is_word).orderBy(F.desc("n"), "word").limit(CODED).select("word")
    return hot, Codes([bytes(row.word) for row in common.collect()])


def _cutter(k: int, m: int, hot: np.ndarray, codes: Codes, schema: pa.Schema) -> Callable:
    """Super-k-mers by bucket; rows without words say that the window at `start` repeats."""

    def rows(
        batch: pa.RecordBatch, at: np.ndarray, bucket: np.ndarray, words: pa.Array, start: np.ndarray
    ) -> pa.RecordBatch:
        taken = pa.array(at)
        columns = {
            "bucket": pa.array(bucket >> 32, pa.int32()),  # half of the hash spreads as well
            "words": words.cast(pa.binary()),
            "doc_id": batch.column("doc_id").take(taken),
            "text_hash": batch.column("text_hash").take(taken),
            "start": pa.array(start, pa.int64()),
        }
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    def listed(values: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*values), schema)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # window -> (its bucket, place); places sort as (no id, id, text hash, start).
        earliest: dict[bytes, tuple[int, tuple]] = {}
        repeats: list[tuple] = []

        def out() -> Iterator[pa.RecordBatch]:
            held = [(b, w, p[1], p[2], p[3]) for w, (b, p) in earliest.items()]
            for values in (held, repeats):
                if values:
                    yield listed(values)
            earliest.clear()
            repeats.clear()

        for batch in batches:
            ids, text_hashes = batch.column("doc_id"), batch.column("text_hash")
            for words in words_of(batch.column("text")):
                firsts, n, minimisers = super_kmers(words, k, m)
                if not len(firsts):
                    continue
                packed = Packed(words, codes)
                text = words.rows[firsts]
                is_hot = bitfilter.passing(hot, minimisers)
                cold = ~is_hot
                yield rows(
                    batch,
                    words.first_row + text[cold],
                    minimisers[cold],
                    packed.strings(firsts[cold], n[cold] + (k - 1)),
                    (firsts - words.bounds[text])[cold],
                )
                if not is_hot.any():
                    continue
                windows = bytewords.expand(firsts[is_hot], n[is_hot])
                buckets = (bytewords.rolling(words.hashes, k)[windows].view(np.int64) >> 32).tolist()
                of_text = np.repeat(text[is_hot], n[is_hot])
                data = packed.data.tobytes()
                spans = zip(packed.starts[windows].tolist(), packed.ends[windows + k - 1].tolist())
                begin = (windows - words.bounds[of_text]).tolist()
                last, key = -1, ()
                for at, bucket, (a, b), start in zip(of_text.tolist(), buckets, spans, begin):
                    if at != last:
                        row = words.first_row + at
                        doc_id = ids[row].as_py()
                        last, key = at, (doc_id is None, doc_id, text_hashes[row].as_py())
                    place = (*key, start)
                    window = data[a:b]
                    first = earliest.get(window)
                    if first is None:
                        earliest[window] = (bucket, place)
                    elif first[1] != place:  # rows that are equal altogether are one document
                        if place < first[1]:
                            earliest[window] = (bucket, place)
                            place = first[1]
                        # Its bucket only spreads the rows.
                        spread = zlib.crc32(b"%d %d" % (place[2], place[3])) >> 1
                        repeats.append((spread ^ row & 0xFFFF, None, *place[1:]))
                    if len(earliest) + len(repeats) >= FOLDED:
                        yield from out()
        yield from out()

    return run


def _repeated_windows(strings: pa.Array, bucket: np.ndarray, same: np.ndarray, k: int) -> np.ndarray:
    """For each string, bits of its windows that an earlier string of its bucket has too.

    Strings come in the order of their places. same: the string is that of the row before it
    (equal rows), which is no repeat.
    """
    words = Unpacked(strings)
    n_windows = np.diff(words.bounds) - (k - 1)
    windows = bytewords.expand(words.bounds[:-1], n_windows)
    of_string = np.repeat(np.arange(len(n_windows)), n_windows)
    hashes = bytewords.rolling(words.hashes, k)[windows]
    order = np.lexsort((hashes, bucket[of_string]))
    h, b = hashes[order], bucket[of_string][order]
    again = np.flatnonzero((h[1:] == h[:-1]) & (b[1:] == b[:-1])) + 1
    bits = np.zeros(len(strings), dtype=np.int64)
    if not len(again):
        return bits
    data = words.data.tobytes()
    starts, ends = words.starts[windows].tolist(), words.ends[windows + k - 1].tolist()
    offset = windows - words.bounds[of_string]
    group = np.zeros(len(order), dtype=np.int64)
    new = np.ones(len(order), dtype=bool)
    new[again] = False
    group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    known: dict[bytes, int] = {}
    at_group = -1
    # Equal rows stand beside each other and count as their first.
    own = np.maximum.accumulate(np.where(same, 0, np.arange(len(same)))).tolist()
    for i, g in zip(again.tolist(), group[again].tolist()):
        if g != at_group:
            j = int(order[g])
            at_group, known = g, {data[starts[j] : ends[j]]: own[int(of_string[j])]}
        j = int(order[i])
        s = int(of_string[j])
        if known.setdefault(data[starts[j] : ends[j]], own[s]) != own[s]:
            bits[s] |= 1 << int(offset[j])
    return bits


def _flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    strings = strings.cast(pa.large_binary())
    _, offsets, data = strings.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    values = np.frombuffer(data or b"", dtype=np.uint8)
    return values[starts[0] : starts[-1]], starts - starts[0]


def _marker(k: int) -> Callable:
    """Places of repeated windows, from strings sorted by bucket and place."""

    def marks(table: pa.Table) -> Iterator[pa.RecordBatch]:
        known = table.filter(pc.is_null(table.column("words")))
        strings = table.filter(pc.is_valid(table.column("words"))).combine_chunks()
        out = []
        if len(known):
            out.append(known.select(["doc_id", "text_hash", "start"]).append_column(
                "bits", pa.array(np.ones(len(known), np.int64))
            ))
        if len(strings) > 1:
            bucket = strings.column("bucket").to_numpy()
            beside = bucket[1:] == bucket[:-1]
            shared = np.zeros(len(bucket), dtype=bool)
            shared[1:] |= beside
            shared[:-1] |= beside
            strings = strings.filter(pa.array(shared))  # a string alone in its bucket repeats nothing
            if len(strings):
                bucket = bucket[shared]
                same = np.zeros(len(bucket), dtype=bool)
                same[1:] = bucket[1:] == bucket[:-1]
                for name in ("text_hash", "start", "doc_id"):
                    column = strings.column(name)
                    left, right = column.slice(1), column.slice(0, len(column) - 1)
                    equal = pc.or_(
                        pc.fill_null(pc.equal(left, right), False),
                        pc.and_(pc.is_null(left), pc.is_null(right)),
                    )
                    same[1:] &= equal.to_numpy(zero_copy_only=False)
                words = strings.column("words").combine_chunks()
                bits = _repeated_windows(words, bucket, same, k)
                some = bits != 0
                out.append(
                    strings.select(["doc_id", "text_hash", "start"])
                    .append_column("bits", pa.array(bits))
                    .filter(pa.array(some))
                )
        for found in out:
            yield from found.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last bucket met
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            if not len(bucket):
                continue
            last = int(np.searchsorted(bucket, bucket[-1], side="left"))
            if held and bucket[0] != held[-1].column("bucket")[-1].as_py():
                yield from marks(pa.Table.from_batches(held))
                held = []
            if last:
                yield from marks(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from marks(pa.Table.from_batches(held))

    return run


def told_apart(documents: DataFrame) -> DataFrame:
    """Documents with text_hash, which tells documents of one doc_id apart.

    It is 0 for nearly all doc_ids that occur once, to travel light.
    """
    again = documents.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    table = cut(bitfilter.cells(again.select(F.xxhash64("doc_id").alias("hash"))))
    rows = bitfilter.passes(
        documents.select(F.struct("*").alias("row"), "doc_id", "text"),
        table,
        F.xxhash64("doc_id"),
        "twice",
    )
    text_hash = F.when(F.col("twice"), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))
    return rows.select("row", "doc_id", "text", text_hash.alias("text_hash"))


def _repeated_windows_of(texts: DataFrame, k: int, m: int) -> DataFrame:
    """(doc_id, text_hash, start, bits): bit i is set where the window at word start + i repeats."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    places = f"doc_id {kind}, text_hash long, start long"
    hot, codes = survey(texts, k, m)
    names = ["bucket", "words", "doc_id", "text_hash", "start"]
    id_type = texts.select("doc_id").limit(0).toArrow().schema.field(0).type
    types = [pa.int32(), pa.binary(), id_type, pa.int64(), pa.int64()]
    strings = texts.where(F.col("text").isNotNull()).mapInArrow(
        _cutter(k, m, hot, codes, pa.schema(list(zip(names, types)))),
        f"bucket int, words binary, {places}",
    )
    return (
        strings.repartition("bucket")
        .sortWithinPartitions("bucket", F.asc_nulls_last("doc_id"), "text_hash", "start")
        .mapInArrow(_marker(k), f"{places}, bits long")
    )


def repeated_windows(documents: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """(doc_id, text_hash, start, bits) of the windows that stand earlier too."""
    return _repeated_windows_of(told_apart(documents).select("doc_id", "text_hash", "text"), k, m)


def _kept_words(k: int) -> Callable:
    @F.arrow_udf("text string, n_words long, n_removed long")
    def kept(texts: pa.Array, marks: pa.Array) -> pa.Array:
        out, counts, removed = [], [], []
        lists = marks.to_pylist() if marks.null_count < len(marks) else [None] * len(marks)
        for text, places in zip(texts, lists):
            value = text.as_py()
            if value is None or not places:
                out.append(value)
                counts.append(0 if value is None else len(value.encode().split()))
                removed.append(0)
                continue
            words = value.encode().split()
            change = np.zeros(len(words) + 1, dtype=np.int64)
            for place in places:
                start, bits = place >> k, place & (1 << k) - 1
                for i in range(bits.bit_length()):
                    if bits >> i & 1:
                        change[start + i] += 1
                        change[start + i + k] -= 1
            gone = np.cumsum(change[:-1]) > 0
            out.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
            counts.append(len(words))
            removed.append(int(gone.sum()))
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
            names=["text", "n_words", "n_removed"],
        )

    return kept


def dedup_substrings(documents: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """All rows of documents, with text without repeated windows of k words (32 at most),
    n_words and n_removed.

    A text that loses words has those left joined by one space; others stay as they are.
    """
    rows = told_apart(documents)
    marks = cut(
        _repeated_windows_of(rows.select("doc_id", "text_hash", "text"), k, m)
        .groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"))
        .agg(F.collect_list(F.shiftleft("start", k).bitwiseOR(F.col("bits"))).alias("marks"))
    )
    rows = rows.withColumnRenamed("doc_id", "id")
    # Only documents that pass a filter of the marked ones are shuffled; it decides nothing.
    table = cut(bitfilter.cells(marks.select(F.xxhash64("m_id", "m_hash").alias("hash"))))
    rows = bitfilter.passes(rows, table, F.xxhash64("id", "text_hash"), "doubt")
    same = F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash"))
    doubted = rows.where("doubt").join(marks, same, "left").select("row", "text", "marks")
    clear = rows.where(~F.col("doubt")).select(
        "row", "text", F.lit(None).cast(doubted.schema["marks"].dataType).alias("marks")
    )
    own = {"text", "n_words", "n_removed"}
    others = [F.col("row")[c].alias(c) for c in documents.columns if c.lower() not in own]
    return (
        clear.unionByName(doubted)
        .select("row", _kept_words(k)(F.col("text"), F.col("marks")).alias("kept"))
        .select(*others, "kept.text", "kept.n_words", "kept.n_removed")
    )


def digests(deduplicated: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): the words left, joined by one space."""

    @F.arrow_udf("string")
    def sha256(texts: pa.Array) -> pa.Array:
        import hashlib

        return pa.array(
            [hashlib.sha256(b" ".join((t.as_py() or "").encode().split())).hexdigest() for t in texts],
            pa.string(),
        )

    return deduplicated.select("doc_id", "n_words", "n_removed", sha256("text").alias("kept_sha256"))


#: The query as direct SQL.
ORACLE_SQL = rf"""
WITH words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents)
), windows AS (
    SELECT doc_id, i, word,
           CASE WHEN count(*) OVER k = {K} THEN string_agg(word, ' ') OVER k END AS span
    FROM words
    WINDOW k AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {K - 1} FOLLOWING)
), judged AS (
    SELECT doc_id, i, word,
           span IS NOT NULL
           AND row_number() OVER (PARTITION BY span ORDER BY doc_id, i) > 1 AS repeats
    FROM windows
), covered AS (
    SELECT doc_id, i, word, bool_or(repeats) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN {K - 1} PRECEDING AND CURRENT ROW) AS gone
    FROM judged
), kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
    FROM covered GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
