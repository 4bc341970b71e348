"""Near-duplicate classes by ProbMinHash.

A text is the weighted set of its five-word shingles, weight = how often the shingle
occurs; the similarity of two texts is the probability Jaccard index of these weights,

    J(A, B) = sum over common d of 1 / sum over all e of max(A[e] / A[d], B[e] / B[d]),

the plain Jaccard index where nothing repeats. ProbMinHash: each shingle is a Poisson
process whose rate is its weight and whose points each fall on one of REGISTERS registers;
a register keeps the shingle of its earliest point. Points come in order of time, so a
shingle is done once its next point is later than every register's. Two texts agree in a
register with probability J. BANDS bands of ROWS registers name the buckets: a pair at 0.8
shares none with probability 5e-5, one at 0.5 shares some with probability 0.55, one at
0.2 with 0.008.

Copies (equal words) are folded before anything else, with a map-side combine, so a huge
group of copies is one node. Texts that share a bucket with another go on; verification
then compares whole texts exactly. Even in one bucket most pairs need no comparison: two
similar texts have a rare shingle in common (see _partners), so the texts of a bucket meet
by their rare shingles. These groups are searched in rounds: one member of each, the hub,
is compared with the members that are not yet in its class, then leaves the group; groups
all of one class are finished. Thousands of near copies of one text thus cost one
comparison each, not one for each pair. The hub is the member with most in common with
others. After HUB_ROUNDS rounds the members that are left, in groups of several classes,
meet in blocks of about BLOCK: a row holds a block, or two of one group, and the task goes
through its pairs with numpy. It keeps those that may be similar by what their sketches
bound (how many of a text's distinct shingles fall into each of CELLS cells); only these
become rows, in the first bucket they share, and only these texts are compared. No group is capped: every pair of a group
is compared, excluded by an exact bound, or already in one class.

Defined cases: a text of one to four words is one shingle; texts without words match only
equal texts; null texts match nothing. Rows with equal doc_id and text share a class. An
empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playpulse.llm import bitfilter, bytewords
from playpulse.llm.components import components
from playpulse.llm.names import free_names
from playpulse.llm.scratch import cut

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
REGISTERS = BANDS * ROWS
HUB_ROUNDS = 2
BLOCK = 256
CELLS = 128
NAMED = 16
_PAIRS_AT_ONCE = 1 << 14

_TIME_SEED = 0x8CB92BA72F3D8DD7
_PLACE_SEED = 0xAEF17502108EF2D9


def _seed(seed: int, turn: int) -> np.uint64:
    return np.uint64(seed * turn % (1 << 64))


def shingles(words: bytewords.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of the shingles of a slice, repeated as they occur."""
    hashes, rows = bytewords.rolling(words.hashes, size), words.rows
    n = len(hashes)
    whole = rows[:n] == rows[size - 1 :] if n else np.empty(0, bool)
    at, found = [rows[:n][whole]], [hashes[whole]]
    for length in range(1, size):  # short texts: all their words are one shingle
        short = np.flatnonzero(words.counts == length)
        if len(short):
            grams = bytewords.rolling(words.hashes, length)
            at.append(short)
            found.append(bytewords.mix(grams[words.bounds[short]] + np.uint64(length)))
    return np.concatenate(at), np.concatenate(found)


def weighted(
    rows: np.ndarray, hashes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, count) without repetition."""
    keys = bytewords.mix(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    return rows[first], hashes[first], counts


def signatures(
    rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_texts: int
) -> np.ndarray:
    """Registers (texts x REGISTERS): the shingle whose point came first on each."""
    times = np.full(n_texts * REGISTERS, np.inf)
    holders = np.zeros(n_texts * REGISTERS, dtype=np.uint64)
    clock, turn = np.zeros(len(rows)), 0
    while len(rows):
        turn += 1
        draw = bytewords.mix(hashes + _seed(_TIME_SEED, turn))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        clock = clock - np.log(uniform) / weights
        latest = times.reshape(n_texts, REGISTERS).max(axis=1)
        alive = clock < latest[rows]
        rows, hashes, weights, clock = rows[alive], hashes[alive], weights[alive], clock[alive]
        place = bytewords.mix(hashes + _seed(_PLACE_SEED, turn)) % np.uint64(REGISTERS)
        place = rows * REGISTERS + place.astype(np.int64)
        np.minimum.at(times, place, clock)
        first = clock == times[place]
        holders[place[first]] = hashes[first]
    return holders.reshape(n_texts, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One bucket name (texts x BANDS) for each band of registers."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        keys = bytewords.mix(keys * np.uint64(0xD1342543DE82EF95) + parts[:, :, r])
    return keys


def _word_text(words: bytewords.Words, i: int) -> bytes:
    """The words of a text, lower-cased, joined by one blank."""
    a, b = words.bounds[i], words.bounds[i + 1]
    if a == b:
        return b""
    starts, ends = words.starts[a:b], words.ends[a:b]
    data = words.data[starts[0] : ends[-1] + 1].copy()
    keep = np.zeros(len(data) + 1, dtype=np.int8)
    keep[starts - starts[0]] += 1
    keep[ends - starts[0]] -= 1
    inside = np.cumsum(keep)[: len(data)].astype(bool)
    blank = ends[:-1] - starts[0]
    data[blank] = 32
    inside[blank] = True
    return bytewords._LOWER[data[inside]].tobytes()


def _node(ids: pa.Array, texts: pa.Array, row: int, words: bytewords.Words, i: int) -> bytes:
    if not texts[row].is_valid:
        content = b"n" + str(ids[row].as_py()).encode()
    elif words.bounds[i] == words.bounds[i + 1]:
        content = b"t" + words.text(i)
    else:
        content = b"w" + _word_text(words, i)
    return hashlib.blake2b(content, digest_size=16).digest()


def _nodes(ids: pa.Array, texts: pa.Array) -> list[bytes]:
    return [
        _node(ids, texts, words.first_row + i, words, i)
        for words in bytewords.words(texts)
        for i in range(words.n_texts)
    ]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for words in bytewords.words(texts):
            n, at = words.n_texts, words.first_row
            keys = band_keys(signatures(*weighted(*shingles(words)), n))
            empty = words.counts == 0
            bounds = np.concatenate(([0], np.cumsum(np.where(empty, 0, BANDS)))).astype(np.int32)
            yield pa.record_batch(
                {
                    "doc_id": ids[at : at + n],
                    "node": pa.array(
                        [_node(ids, texts, at + i, words, i) for i in range(n)], pa.binary()
                    ),
                    "bands": pa.ListArray.from_arrays(
                        bounds, pa.array(keys[~empty].reshape(-1).view(np.int64))
                    ),
                }
            )


def _marks(nodes: list[bytes], ids: pa.Array) -> np.ndarray:
    """A 64-bit hash of node and doc_id."""
    digests = (
        hashlib.blake2b(node + str(i).encode(), digest_size=8).digest()
        for node, i in zip(nodes, ids.to_pylist(), strict=True)
    )
    return np.frombuffer(b"".join(digests), dtype=np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the mark of (node, id) as `hash`."""
    for batch in batches:
        marks = _marks(batch.column("node").to_pylist(), batch.column("id"))
        yield batch.append_column("hash", pa.array(marks))


def _marked(rows: DataFrame) -> DataFrame:
    """Rows (node, id as text, ...) with their mark."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_mark, f"{kinds}, hash long")


def _texts_of(filled: np.ndarray):
    """(node, hash, text) of the documents whose mark passes the filter."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = _nodes(batch.column("id"), batch.column("text"))
            counts = np.concatenate([w.counts for w in bytewords.words(batch.column("text"))])
            marks = _marks(nodes, batch.column("id"))
            keep = pa.array(np.flatnonzero(bitfilter.passing(filled, marks.view(np.uint64))))
            yield pa.record_batch(
                {
                    "node": pa.array(nodes, pa.binary()).take(keep),
                    "hash": pa.array(marks).take(keep),
                    "n_shingles": pa.array(np.maximum(counts - SHINGLE + 1, 1)).take(keep),
                    "text": batch.column("text").take(keep),
                }
            )

    return texts


def _own_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, owner, weight) of every text, without repetition."""
    for batch in batches:
        owners = batch.column("hash").to_numpy()
        for words in bytewords.words(batch.column("text")):
            rows, hashes, counts = weighted(*shingles(words))
            yield pa.record_batch(
                {
                    "shingle": hashes.view(np.int64),
                    "owner": owners[words.first_row + rows],
                    "weight": counts.astype(np.int64),
                }
            )


def _linkable(
    rows: DataFrame, texts: DataFrame, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """(shingles that several texts have, texts with enough of them).

    J(A, B) is at most the weight of the common shingles as a share of A's. So a text whose
    shingles are found elsewhere for less than the threshold has no links.
    """
    counts = rows.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("owner").alias("owner"), F.min("weight").alias("weight")
    )
    single = counts.where("n = 1").groupBy("owner").agg(F.sum("weight").alias("single"))
    kept = (
        texts.select("node", F.col("hash").alias("owner"), F.col("n_shingles").alias("total"))
        .join(single, "owner", "left")
        .withColumn("single", F.coalesce("single", F.lit(0)))
        .withColumn("share", 1 - F.col("single") / F.col("total"))
        .where(F.col("share") >= threshold - 1e-9)
    )
    return counts.where("n > 1").select("shingle", "n"), cut(kept)


def _partners(texts: DataFrame, threshold: float) -> DataFrame:
    """(bucket, node, share, used): texts by those of their rare shingles a link must share.

    Let shingles be ordered by how many texts have them. The first one that two linked texts
    have in common must come before more than 1 - threshold of either's weight is used up,
    or too little would be left; so texts need to meet at these shingles only. `used` is the
    share of the text's weight that comes before the shingle. Texts without links are taken
    out first.
    """
    rows = texts.select("hash", "text").mapInArrow(
        _own_shingles, "shingle long, owner long, weight long"
    )
    shared, kept = _linkable(rows, texts, threshold)
    order = Window.partitionBy("owner").orderBy("n", "shingle")
    before = F.coalesce(
        F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        rows.join(shared, "shingle")
        .join(kept, "owner")
        .withColumn("used", (F.col("single") + before) / F.col("total"))
        .where(F.col("used") <= 1 - threshold + 1e-9)
        .select(F.col("shingle").alias("bucket"), "node", "share", "used")
    )


def _may_link(used_a: Column, used_b: Column, threshold: float) -> Column:
    """Whether texts that first meet after these shares of their weights can be similar.

    If u of A's weight is not in B and v of B's not in A, J <= (1 - u)(1 - v) / (1 - uv).
    """
    return (1 - used_a) * (1 - used_b) >= threshold * (1 - used_a * used_b) - 1e-9


def probability_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """J of two texts, given the hashes of their shingles as they occur."""
    a, wa = np.unique(a, return_counts=True)
    b, wb = np.unique(b, return_counts=True)
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    only_a = wa.sum() - wa[ia].sum()
    only_b = wb.sum() - wb[ib].sum()
    ca, cb = wa[ia].astype(float), wb[ib].astype(float)
    total = 0.0
    ratios, which = np.unique(ca / cb, return_inverse=True)
    shares = np.bincount(which, weights=ca)
    for ratio, share in zip(ratios, shares, strict=True):
        total += share / (only_a + only_b * ratio + np.maximum(ca, cb * ratio).sum())
    return float(total)


def _each_shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    for words in bytewords.words(texts):
        rows, hashes = shingles(words)
        order = np.argsort(rows, kind="stable")
        bounds = np.searchsorted(rows[order], np.arange(words.n_texts + 1))
        for i in range(words.n_texts):
            yield hashes[order[bounds[i] : bounds[i + 1]]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(
            _each_shingles(batch.column("text_a")),
            _each_shingles(batch.column("text_b")),
            strict=True,
        )
        yield pa.record_batch(
            {
                "a": batch.column("a"),
                "b": batch.column("b"),
                "similarity": pa.array([probability_jaccard(x, y) for x, y in pairs], pa.float64()),
            }
        )


def _links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) of nodes whose texts are similar."""
    sides = pairs.join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    ).join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    found = sides.mapInArrow(_compare, "a binary, b binary, similarity double")
    return found.where(F.col("similarity") >= threshold).select("a", "b")


def _round(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(pairs of hub and member in different classes, members left for the next round).

    members: (bucket, node, share, used, label), in buckets of several classes. The hub is the
    member that has most in common with others, as the common origin of copies has.
    """
    first = members.groupBy("bucket").agg(
        F.min(F.struct((-F.col("share")).alias("order"), "node", "label", "used")).alias("h")
    )
    ranked = cut(members.join(first, "bucket"))
    pairs = ranked.where(
        (F.col("label") != F.col("h.label"))
        & _may_link(F.col("used"), F.col("h.used"), threshold)
    ).select(F.col("h.node").alias("a"), F.col("node").alias("b"))
    left = ranked.where(F.col("node") != F.col("h.node"))
    return pairs.distinct(), left.select("bucket", "node", "share", "used")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, total, distinct, sketch): shingles of a text, distinct ones, and these by cell.

    A text with 255 or more in a cell counts as having none that others lack (distinct 0).
    """
    for batch in batches:
        for words in bytewords.words(batch.column("text")):
            rows, hashes, counts = weighted(*shingles(words))
            n, at = words.n_texts, words.first_row
            place = rows * CELLS + (bytewords.mix(hashes) % np.uint64(CELLS)).astype(np.int64)
            cells = np.bincount(place, minlength=n * CELLS).reshape(n, CELLS)
            distinct = np.where(cells.max(axis=1) < 255, cells.sum(axis=1), 0)
            sketches = np.minimum(cells, 255).astype(np.uint8)
            yield pa.record_batch(
                {
                    "node": batch.column("node").slice(at, n),
                    "total": np.bincount(rows, counts, n).astype(np.int64),
                    "distinct": distinct.astype(np.int64),
                    "sketch": pa.array([row.tobytes() for row in sketches], pa.binary()),
                }
            )


class _Members:
    """The members in a column of blocks, one block after the other."""

    def __init__(self, blocks: pa.ListArray) -> None:
        self.lengths = blocks.value_lengths().to_numpy()
        self.bounds = np.append(0, np.cumsum(self.lengths, dtype=np.int64))
        flat = blocks.flatten()
        held = dict(zip((f.name for f in flat.type), flat.flatten(), strict=True))
        self.node = held["node"]
        self.label = self._bytes(held["label"], 16).view(np.uint64)
        self.sketch = self._bytes(held["sketch"], CELLS)
        self.used, self.total, self.distinct = (
            held[c].to_numpy() for c in ("used", "total", "distinct")
        )
        n_named = held["named"].value_lengths().to_numpy()
        self.has = np.arange(NAMED) < n_named[:, None]
        self.named = np.zeros(self.has.shape, dtype=np.int64)
        self.named[self.has] = held["named"].flatten().to_numpy()

    @staticmethod
    def _bytes(column: pa.Array, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _may_be_similar(
    a: _Members, i: np.ndarray, b: _Members, j: np.ndarray, threshold: float
) -> np.ndarray:
    """Which pairs are of different classes and not excluded by what is used or by sketches.

    Two texts have at most the sum of the lesser cells in common, and weight above that only
    where shingles repeat.
    """
    close = (a.label[i] != b.label[j]).any(axis=1)
    close[close] = _may_link(a.used[i[close]], b.used[j[close]], threshold)
    i, j = i[close], j[close]
    common = np.minimum(a.sketch[i], b.sketch[j]).sum(axis=1, dtype=np.int64)
    alone_a = np.maximum(a.distinct[i] - common, 0) / a.total[i]
    alone_b = np.maximum(b.distinct[j] - common, 0) / b.total[j]
    close[close] = _may_link(alone_a, alone_b, threshold)
    return close


def _due(
    a: _Members, i: np.ndarray, b: _Members, j: np.ndarray, bucket: np.ndarray
) -> np.ndarray:
    """Whether this bucket is the first that both name, or they name none in common.

    Buckets are named in the order of shingles that all texts share, so the first is the one
    where least is used.
    """
    both = (a.named[i][:, :, None] == b.named[j][:, None, :]) & b.has[j][:, None, :]
    both = both.any(axis=2) & a.has[i]
    first = a.named[i, both.argmax(axis=1)]
    return ~both.any(axis=1) | (first == bucket)


def _meet(threshold: float):
    """Pairs (a, b) of nodes from blocks m, or from blocks m and o of one group."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = b = _Members(batch.column("m"))
            n = len(a.node)
            bucket = np.repeat(batch.column("bucket").to_numpy(), a.lengths)
            if "o" in batch.schema.names:
                b = _Members(batch.column("o"))
                starts = np.repeat(b.bounds[:-1], a.lengths)
                counts = np.repeat(b.lengths, a.lengths).astype(np.int64)
            else:
                starts = np.arange(1, n + 1)
                counts = np.repeat(a.bounds[1:], a.lengths) - starts
            reached, at = np.append(0, np.cumsum(counts)), 0
            while at < n:
                to = int(np.searchsorted(reached, reached[at] + _PAIRS_AT_ONCE, side="right")) - 1
                to = max(to, at + 1)
                i = np.repeat(np.arange(at, to), counts[at:to])
                j = bytewords.expand(starts[at:to], counts[at:to])
                close = _may_be_similar(a, i, b, j, threshold)
                i, j = i[close], j[close]
                due = _due(a, i, b, j, bucket[i])
                i, j = i[due], j[due]
                yield pa.record_batch({"a": a.node.take(pa.array(i)), "b": b.node.take(pa.array(j))})
                at = to

    return meet


def _block_pairs(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """All pairs of members of one bucket and different classes that may be similar.

    Large buckets are dealt to blocks by a hash of the node, and blocks of a bucket are paired.
    """
    nodes = members.groupBy("node").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("used", "bucket"))), 1, NAMED)["bucket"].alias(
            "named"
        )
    )
    sketches = (
        texts.select("node", "text")
        .join(nodes.select("node"), "node", "left_semi")
        .mapInArrow(_sketch, "node binary, total long, distinct long, sketch binary")
    )
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))
    member = ["node", "label", "named", "used", "total", "distinct", "sketch"]
    blocks = cut(
        members.join(sizes, "bucket")
        .withColumn("block", block)
        .join(sketches.join(nodes, "node"), "node")
        .groupBy("bucket", "block")
        .agg(F.collect_list(F.struct(*member)).alias("m"))
    )
    others = blocks.select(
        "bucket", F.col("block").alias("other"), F.col("m").alias("o")
    )
    across = blocks.join(others, "bucket").where("block < other")
    found = (
        blocks.where(F.size("m") > 1)
        .select("bucket", "m")
        .mapInArrow(_meet(threshold), "a binary, b binary")
        .union(across.select("bucket", "m", "o").mapInArrow(_meet(threshold), "a binary, b binary"))
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with their class, of those buckets that hold several classes."""
    if labels is None:
        found = members.withColumn("label", F.col("node"))
    else:
        found = members.join(labels, "node", "left").withColumn(
            "label", F.coalesce("label", "node")
        )
    several = (
        found.groupBy("bucket")
        .agg(F.min(F.xxhash64("label")).alias("l"), F.max(F.xxhash64("label")).alias("m"))
        .where("l <> m")
        .select("bucket")
    )
    return found.join(several, "bucket", "left_semi")


def _similar_nodes(documents: DataFrame, signed: DataFrame, threshold: float) -> DataFrame | None:
    """(node, label) for every node with similar others; None if there are none."""
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands")
    )
    members = cut(_labelled(nodes.select(F.explode("bands").alias("bucket"), "node"), None))
    if members.isEmpty():
        return None
    # The text of one document for each node that shares a bucket, found by a filter of
    # fixed size and then by the node itself.
    wanted = nodes.select("node", "first_id").join(
        members.select("node").distinct(), "node", "left_semi"
    )
    wanted = cut(_marked(wanted.withColumn("id", F.col("first_id").cast("string"))))
    filled = bitfilter.build(wanted.select("hash"))
    texts = (
        documents.select(F.col("doc_id").cast("string").alias("id"), "text")
        .mapInArrow(_texts_of(filled), "node binary, hash long, n_shingles long, text string")
        .join(wanted.select("node", "hash"), ["node", "hash"], "left_semi")
        .dropDuplicates(["node"])
    )
    texts = cut(texts)
    members = cut(_labelled(_partners(texts, threshold), None))
    labels = None
    for _ in range(HUB_ROUNDS):
        pairs, left = _round(members, threshold)
        labels = _joined(cut(_links(pairs, texts, threshold)), labels)
        members = cut(_labelled(left, labels))
        if members.isEmpty():
            return labels
    pairs = _block_pairs(members, texts, threshold)
    return _joined(cut(_links(pairs, texts, threshold)), labels)


def _joined(found: DataFrame, labels: DataFrame | None) -> DataFrame | None:
    """Classes after new links: components of the links and of what is joined already."""
    if found.isEmpty():
        return labels
    if labels is None:
        return components(found)
    stars = labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return components(found.union(stars))


def _classified(documents: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of each document; (node, class_id, class_size) of each node."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    signed = cut(rows.mapInArrow(_sign, f"doc_id {id_type}, node binary, bands array<long>"))
    labels = _similar_nodes(rows, signed, threshold)
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    if labels is not None:
        nodes = nodes.join(labels, "node", "left")
    else:
        nodes = nodes.withColumn("label", F.lit(None).cast("binary"))
    alone = nodes.where(F.col("label").isNull()).select(
        "node", F.col("first_id").alias("class_id"), F.col("n").alias("class_size")
    )
    grouped = nodes.where(F.col("label").isNotNull())
    classes = grouped.groupBy("label").agg(
        F.min("first_id").alias("class_id"), F.sum("n").alias("class_size")
    )
    together = grouped.select("node", "label").join(classes, "label").select(
        "node", "class_id", "class_size"
    )
    return signed.select("doc_id", "node"), cut(alone.union(together))


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size) for every row of documents; class_id is the least doc_id."""
    rows, nodes = _classified(documents, threshold)
    return rows.join(nodes, "node").select("doc_id", "class_id", "class_size")


def dedup(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one of least doc_id; all columns unchanged.

    Rows that certainly stay are told by a filter of fixed size and are not shuffled. Of rows
    of equal doc_id and text one stays, with its own other columns; these may have any names.
    """
    rows, nodes = _classified(documents, threshold)
    counted = rows.groupBy("doc_id", "node").agg(F.count("*").alias("n"))
    # Where one id has several texts of a class, the one of least node stays.
    lead = (
        counted.join(nodes, "node")
        .where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("class_id")
        .agg(F.min("node").alias("lead"))
    )
    judged = counted.join(nodes, "node").join(lead, "class_id", "left")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (
        F.coalesce(F.col("lead"), F.col("node")) == F.col("node")
    )
    changed = judged.where(~stays | (F.col("n") > 1)).select(
        F.col("doc_id").cast("string").alias("id"), "node", stays.alias("once")
    )
    changed = cut(_marked(changed))
    filled = bitfilter.build(changed.select("hash"))
    j_id, j_node, once, node, doubt, told = free_names(
        documents, "j_id", "j_node", "once", "__node", "__doubt", "__told"
    )
    changed = changed.select(
        F.col("id").alias(j_id), F.col("node").alias(j_node), F.col("once").alias(once)
    )

    @F.arrow_udf("node binary, doubt boolean")
    def tell(ids: pa.Array, texts: pa.Array) -> pa.Array:
        nodes = _nodes(ids, texts)
        doubtful = bitfilter.passing(filled, _marks(nodes, ids).view(np.uint64))
        return pa.StructArray.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(doubtful)], ["node", "doubt"]
        )

    text_id = F.col("doc_id").cast("string")
    # Spark must not repeat the function in a filter: one Python worker a task is enough.
    once_told = tell.asNondeterministic()(text_id, F.col("text").cast("string"))
    marked = (
        documents.withColumn(told, once_told)
        .withColumn(node, F.col(told)["node"])
        .withColumn(doubt, F.col(told)["doubt"])
        .drop(told)
    )
    same = (F.col(node) == F.col(j_node)) & text_id.eqNullSafe(F.col(j_id))
    doubted = marked.where(F.col(doubt)).join(changed, same, "left")
    extra = [j_id, j_node, once, node, doubt]
    surely = marked.where(~F.col(doubt)).drop(*extra)
    unique = doubted.where(F.col(once).isNull()).drop(*extra)
    repeated = doubted.where(F.col(once)).dropDuplicates([node, "doc_id"]).drop(*extra)
    return surely.union(unique).union(repeated)
