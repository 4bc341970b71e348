"""Benchmark decontamination by winnowing.

Every window of 10 words holds three 8-grams; its fingerprint is the smallest hash of the
three. A text and a benchmark item that share 10 words in a row therefore share a
fingerprint at the same place of the shared span. Fingerprints are joined by hash, and
each hit is extended word by word in both directions; a run counts if it covers a whole
window, so hash collisions never show in the result. An item of fewer words than a window
is one window of its own length, matched by the hash of all its words.

Plan: the fingerprints of the benchmark set bits in a filter of fixed size (1 MB,
whatever the benchmark's size). Documents are read once, and only fingerprints
that pass it leave the task, grouped by hash, with the texts that have some. The rest is a
join by hash, a grouping by document and the extension, all on those few documents. The
filter saves work and decides nothing.

Defined cases: a null text has no words and is clean. Rows with equal doc_id and text have
equal results. Several items of one item_id count once; items of null item_id are matched
but neither counted nor listed. With no benchmark every document is clean, and without
documents there is no result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from playpulse.llm import bitfilter, bytewords
from playpulse.llm.names import free_names
from playpulse.llm.scratch import cut

WINDOW = 10
GRAM = 8

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _own_gram(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all spans of `length` words, apart from those of other lengths."""
    return bytewords.mix(bytewords.rolling(hashes, length) + np.uint64(length))


def fingerprints(
    words: bytewords.Words, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word places (within the slice) of the winnowed grams of each text."""
    grams = _own_gram(words.hashes, gram)
    n = len(words.hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = words.rows
    best, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for j in range(1, window - gram + 1):
        other = grams[j : j + n]
        better = other <= best  # the last of equal hashes
        best = np.where(better, other, best)
        at[better] = j
    whole = rows[:n] == rows[window - 1 :]
    places = np.unique((np.arange(n) + at)[whole])
    return grams[places], places


def _short_grams(words: bytewords.Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(words.hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = words.rows
    places = np.flatnonzero(rows[:n] == rows[length - 1 :])
    return _own_gram(words.hashes, length)[places], places


def _benchmark_prints(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(hash, item, place, length) of every fingerprint of every item."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("item").to_numpy(zero_copy_only=False)
            for words in bytewords.words(batch.column("item_text")):
                found = [(*fingerprints(words, window, gram), window)]
                found += [(*_short_grams(words, n), n) for n in range(1, window)]
                rows, counts = words.rows, words.counts
                for hashes, places, length in found:
                    at = rows[places]
                    if length < window:  # only items of just that many words
                        own = counts[at] == length
                        hashes, places, at = hashes[own], places[own], at[own]
                    yield pa.record_batch(
                        {
                            "hash": hashes.view(np.int64),
                            "item": keys[words.first_row + at],
                            "item_place": (places - words.bounds[at]).astype(np.int32),
                            "length": np.full(len(at), length, dtype=np.int32),
                        }
                    )

    return items.select("item", "item_text").mapInArrow(
        prints, "hash long, item long, item_place int, length int"
    )


def _candidates(
    words: bytewords.Words, filled: np.ndarray, lengths: list[int], window: int, gram: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a slice that pass the filter."""
    found = [fingerprints(words, window, gram)] if window in lengths else []
    found += [_short_grams(words, n) for n in lengths if n < window]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.concatenate([h for h, _ in found])
    places = np.concatenate([p for _, p in found])
    keep = bitfilter.passing(filled, hashes)
    return hashes[keep], places[keep]


def _scan(
    filled: np.ndarray, lengths: list[int], window: int, gram: int, id_type: pa.DataType
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document its number of words, and hashes with their places and text if any pass."""
    place_type = pa.list_(pa.int32())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = (batch.column(c) for c in ("doc_id", "text_key", "text"))
            for words in bytewords.words(texts):
                hashes, places = _candidates(words, filled, lengths, window, gram)
                at = words.rows[places]
                order = np.lexsort((places, hashes, at))
                hashes, places, at = hashes[order], places[order], at[order]
                own = (places - words.bounds[at]).astype(np.int32)
                # One entry for each text and hash, with all its places.
                new = np.ones(len(at), dtype=bool)
                new[1:] = (at[1:] != at[:-1]) | (hashes[1:] != hashes[:-1])
                begins = np.flatnonzero(new)
                groups = pa.ListArray.from_arrays(
                    np.append(begins, len(at)).astype(np.int32), pa.array(own)
                )
                n = words.n_texts
                bounds = np.searchsorted(at[begins], np.arange(n + 1)).astype(np.int32)
                some = np.diff(bounds) > 0
                rows = slice(words.first_row, words.first_row + n)
                text = texts[rows.start : rows.stop]
                yield pa.record_batch(
                    {
                        "doc_id": ids[rows.start : rows.stop].cast(id_type),
                        "text_key": keys[rows.start : rows.stop],
                        "n_words": words.counts.astype(np.int64),
                        "hashes": pa.ListArray.from_arrays(
                            bounds, pa.array(hashes[begins].view(np.int64))
                        ),
                        "places": pa.ListArray.from_arrays(bounds, groups.cast(place_type)),
                        "text": text.take(pa.array(np.arange(n), mask=~some)).cast(pa.string()),
                    }
                )

    return scan


def _words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(_LOWER))


def shared_runs(
    text: list[bytes], item: list[bytes], hits: list[tuple[int, int]], length: int
) -> list[tuple[int, int]]:
    """Maximal runs of at least `length` equal words through the hits (text, item place)."""
    runs, covered = [], {}
    for place, item_place in sorted(hits):
        shift = place - item_place
        if place < covered.get(shift, -1):
            continue
        begin = end = place
        while begin > 0 and begin > shift and text[begin - 1] == item[begin - 1 - shift]:
            begin -= 1
        stop = min(len(text), len(item) + shift)
        while end < stop and text[end] == item[end - shift]:
            end += 1
        covered[shift] = max(end, place + 1)
        if end - begin >= length and end > place:
            runs.append((begin, end))
    return runs


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per suspect document and item the spans of words they share."""
    for batch in batches:
        spans: dict[str, list] = {k: [] for k in ("begins", "ends", "items")}
        for row in batch.select(["text", "found"]).to_pylist():
            text, begins, ends, ids = _words_of(row["text"]), [], [], []
            for item in row["found"]:
                hits = [
                    (p, h["item_place"]) for h in item["hits"] for p in h["places"]
                ]
                for b, e in shared_runs(text, _words_of(item["item_text"]), hits, item["length"]):
                    begins.append(b)
                    ends.append(e)
                    ids.append(item["item"])
            spans["begins"].append(begins)
            spans["ends"].append(ends)
            spans["items"].append(ids)
        ints = pa.list_(pa.int32())
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "text_key": batch.column("text_key"),
                "begins": pa.array(spans["begins"], ints),
                "ends": pa.array(spans["ends"], ints),
                "items": pa.array(spans["items"], pa.list_(pa.int64())),
            }
        )


class Matcher:
    """A benchmark's fingerprints, ready to be matched against documents."""

    def __init__(self, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> None:
        self.window, self.gram = window, min(gram, window)
        texts = benchmark.select(
            "item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("item_text")
        ).distinct()
        self.items = texts.withColumn("item", F.xxhash64("item_id", "item_text"))
        self.prints = cut(_benchmark_prints(self.items, window, self.gram))
        self.filled = bitfilter.build(self.prints)
        self.lengths = sorted(r[0] for r in self.prints.select("length").distinct().collect())

    def scan(self, documents: DataFrame) -> DataFrame:
        id_field = documents.schema["doc_id"]
        rows = documents.select(
            "doc_id",
            F.xxhash64(F.lit(0), "doc_id", "text").alias("text_key"),
            F.col("text").cast("string").alias("text"),
        )
        scan = _scan(
            self.filled, self.lengths, self.window, self.gram, to_arrow_type(id_field.dataType)
        )
        return rows.mapInArrow(
            scan,
            f"doc_id {id_field.dataType.simpleString()}, text_key long, n_words long, "
            "hashes array<long>, places array<array<int>>, text string",
        )

    def suspect(self):
        """A column function: whether a text has fingerprints that pass the filter."""
        filled, lengths, window, gram = self.filled, self.lengths, self.window, self.gram

        @F.arrow_udf("boolean")
        def any_print(texts: pa.Array) -> pa.Array:
            out = np.zeros(len(texts), dtype=bool)
            for words in bytewords.words(texts):
                _, places = _candidates(words, filled, lengths, window, gram)
                out[words.first_row + np.unique(words.rows[places])] = True
            return pa.array(out)

        return any_print

    def spans(self, scanned: DataFrame) -> DataFrame:
        """(doc_id, text_key, begins, ends, items) for documents that share a window."""
        suspects = scanned.where(F.size("hashes") > 0)
        entries = suspects.select(
            "doc_id", "text_key", F.explode(F.arrays_zip("hashes", "places")).alias("e")
        ).select("doc_id", "text_key", F.col("e.hashes").alias("hash"), "e.places")
        entries = entries.dropDuplicates(["doc_id", "text_key", "hash"])
        hits = (
            entries.join(self.prints, "hash")
            .groupBy("doc_id", "text_key", "item")
            .agg(
                F.first("length").alias("length"),
                F.collect_list(F.struct("item_place", "places")).alias("hits"),
            )
            .join(self.items.select("item", "item_text"), "item")
            .groupBy("doc_id", "text_key")
            .agg(F.collect_list(F.struct("item", "item_text", "length", "hits")).alias("found"))
        )
        texts = suspects.select("doc_id", "text_key", "text").dropDuplicates(["doc_id", "text_key"])
        found = texts.join(
            hits.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("text_key", "hit_key"),
            F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")),
        ).select("doc_id", "text_key", "text", "found")
        id_type = scanned.schema["doc_id"].dataType.simpleString()
        return found.mapInArrow(
            _extend,
            f"doc_id {id_type}, text_key long, begins array<int>, ends array<int>, "
            "items array<long>",
        ).where(F.size("begins") > 0)


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per document the words and spans it shares with benchmark items.

    Columns: doc_id, n_words, n_hit (words inside spans), item_ids (sorted as strings),
    spans (begin, end in words). Documents without hits have zero and empty arrays.
    """
    matcher = Matcher(benchmark, window, gram)
    scanned = cut(matcher.scan(documents))
    spans = cut(matcher.spans(scanned))
    ids = (
        spans.select("doc_id", "text_key", F.explode(F.array_distinct("items")).alias("item"))
        .join(matcher.items.select("item", "item_id"), "item")
        .where(F.col("item_id").isNotNull())
        .groupBy(F.col("doc_id").alias("i_id"), F.col("text_key").alias("i_key"))
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    )
    # Spans are merged by walking them in order, so overlaps count once.
    pairs = F.array_sort(F.arrays_zip(F.col("begins").alias("begin"), F.col("ends").alias("end")))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["begin"], a["to"]), F.lit(0))).alias("n"),
            F.greatest(a["to"], s["end"]).alias("to"),
        ),
        lambda a: a["n"],
    )
    marked = (
        spans.withColumn("spans", pairs)
        .withColumn("n_hit", covered)
        .select(
            F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key"), "spans", "n_hit"
        )
    )
    same_ids = F.col("s_id").eqNullSafe(F.col("i_id")) & (F.col("s_key") == F.col("i_key"))
    marked = marked.join(ids, same_ids, "left").drop("i_id", "i_key")
    same = F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key"))
    return scanned.select("doc_id", "text_key", "n_words").join(marked, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<begin:int,end:int>>")).alias("spans"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with a benchmark item, all columns unchanged.

    Documents whose fingerprints all fail the filter pass at once; only the rest, mostly
    real hits, is compared with the spans found. Other columns may have any names.
    """
    matcher = Matcher(benchmark)
    hit_id, hit_key, suspect, key = free_names(
        documents, "hit_id", "hit_key", "__suspect", "__text_key"
    )
    hit = matcher.spans(cut(matcher.scan(documents))).select(
        F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key)
    )
    flagged = documents.withColumn(suspect, matcher.suspect()(F.col("text").cast("string")))
    same = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.col(key) == F.col(hit_key))
    kept = (
        flagged.where(F.col(suspect))
        .withColumn(key, F.xxhash64(F.lit(0), "doc_id", "text"))
        .join(cut(hit), same, "left_anti")
        .drop(key)
    )
    return flagged.where(~F.col(suspect)).union(kept).drop(suspect)
