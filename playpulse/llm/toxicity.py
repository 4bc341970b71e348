"""Toxicity by nearest labelled examples: exact TF-IDF cosine over an index with score bounds.

1. A bounded sample of labelled rows (MOST_EXAMPLES of each class, by a hash of doc_id) is
   the set of examples; their documents come by a broadcast join of that size.
2. Terms are words and the first 4 and 5 bytes of longer words. The vocabulary is every
   term of the examples; none is chosen or dropped. Document frequencies are counted over
   all documents.
3. A term weighs (1 + ln tf) * idf * tell. What a term tells is the log of its odds between
   the classes less SURE standard errors, squeezed into LEAST_TELL to 1: common words, and
   rare ones that prove nothing, weigh little but count, so that a copy of an example has
   cosine 1 whatever its words are. Vectors are scaled to length 1.
4. Examples of equal vectors are one entry with its numbers of toxic and clean examples.
   Entries are ordered by their heaviest term. Rarer terms have postings; terms that many
   entries hold have a column of weights, the heaviest columns first. Every entry has the norm
   of its weights in each of GROUPS groups of columns but the ALONE first ones.
5. A query first adds up the postings of its rarer terms. The bound of an entry is its sum so
   far plus that over the first columns plus, for each group, the product of the query's and
   the entry's norms (no inner product is larger). The FIRST entries of best bound are finished
   first, then those whose bound reaches the K-th best sum: by themselves where they are FEW,
   else with every block of BLOCK entries that holds some. What is skipped cannot be among the
   K. The best are worked out again in double precision, in a fixed order, so results do not
   depend on which texts are scored together.
6. Votes are weighted by similarity over distance and by what an example of its class stands
   for, and are turned into probabilities by a logistic curve fitted to leave-one-out votes.

The index is bounded by the sample, whatever the corpus; it is broadcast, and workers keep
it between tasks. The driver holds the examples' terms, never other documents'. Texts are
read for the frequencies and again for the scores; nothing of them is stored. Labels,
language, source and doc_id are no inputs of a score.

Defined cases: documents without a term of the examples (null and empty texts too) get the
share of toxic labels among examples without terms; where examples of one class are missing,
every score is the share of toxic labels (0 without labels). Several labels of one doc_id
count as toxic if any is; null labels are left out. Of rows that repeat a labelled doc_id
each is an example. Repeated rows have equal scores. An empty table gives an empty result.
Columns beside doc_id and text are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from playpulse.llm import bytewords
from playpulse.llm.scratch import cut

MOST_EXAMPLES = 6000
STEMS = (4, 5)
SURE = 3.0
LEAST_TELL = 0.02
ALONE = 192
GROUPS = 192
BLOCK = 64
FIRST = 24
FEW = 32
K = 16
NEAR = 0.02
_SMOOTH = 0.05
_TOGETHER = 512
_COMMON = 20
_MOST_CELLS = 1 << 25
_LEAST = np.finfo(np.float32).tiny
_POSTING = np.dtype([("weight", "<f4"), ("entry", "<i4")])
_SLACK = 2e-5
_LEAD = 20


def held_out(doc_id: Column) -> Column:
    """The fifth of documents whose labels are not learned."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _terms(words: bytewords.Words) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of the terms of a slice, as they occur."""
    rows, hashes = [words.rows], [words.hashes]
    for size in STEMS:
        longer = np.flatnonzero(words.ends - words.starts > size)
        starts = words.starts[longer]
        stem = np.zeros(len(longer), dtype=np.uint64)
        for j in range(size):
            value = bytewords.BYTE_VALUE[words.data[starts + j]]
            stem = stem * np.uint64(0xD1342543DE82EF95) + value
        rows.append(words.rows[longer])
        hashes.append(bytewords.mix(stem + np.uint64(size)))
    return np.concatenate(rows), np.concatenate(hashes)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch (term, toxic texts, clean texts) with the term."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
        for words in bytewords.words(batch.column("text")):
            rows, hashes = _terms(words)
            key = bytewords.mix(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, first = np.unique(key, return_index=True)
            terms, which = np.unique(hashes[first], return_inverse=True)
            bad = toxic[words.first_row + rows[first]]
            yield pa.record_batch(
                {
                    "term": terms.view(np.int64),
                    "toxic": np.bincount(which, bad, len(terms)).astype(np.int64),
                    "clean": np.bincount(which, ~bad, len(terms)).astype(np.int64),
                }
            )


def _tell(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """What each term tells of the class, LEAST_TELL to 1, from the examples that hold it."""
    a, b = toxic + 0.5, clean + 0.5
    odds = np.abs(np.log(a / (n_toxic + 1.0)) - np.log(b / (n_clean + 1.0)))
    sure = np.tanh(np.maximum(odds - SURE * np.sqrt(1 / a + 1 / b), 0.0))
    return LEAST_TELL + (1 - LEAST_TELL) * sure


class _Lookup:
    """The places of terms in the vocabulary, found by the leading bits of their hashes."""

    def __init__(self, vocabulary: np.ndarray) -> None:
        self.vocabulary = vocabulary
        lead = (vocabulary >> np.uint64(64 - _LEAD)).astype(np.int64)
        self.first = np.append(0, np.cumsum(np.bincount(lead, minlength=1 << _LEAD)))
        self.first = self.first.astype(np.int32)  # half the memory to look up in
        self.width = max(len(vocabulary), 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        lead = (hashes >> np.uint64(64 - _LEAD)).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        found = np.full(len(hashes), -1, dtype=np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = at[open_]
            hit = self.vocabulary[here] == hashes[open_]
            found[open_[hit]] = here[hit]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return found


def _sparse(words: bytewords.Words, lookup: _Lookup) -> tuple[np.ndarray, ...]:
    """(bounds, terms, counts): the vocabulary terms of each text of a slice, ascending."""
    rows, hashes = _terms(words)
    at, width = lookup.find(hashes), lookup.width
    keep = at >= 0
    keys, counts = np.unique(rows[keep] * width + at[keep], return_counts=True)
    bounds = np.searchsorted(keys, np.arange(words.n_texts + 1) * width)
    return bounds.astype(np.int32), (keys % width).astype(np.int32), counts.astype(np.int32)


def _frequencies(shared: Broadcast):
    """One row for each partition and term: the documents that hold it; term -1: all of them."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        df, n = np.zeros(len(shared.value), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for words in bytewords.words(batch.column("text")):
                df += np.bincount(_sparse(words, lookup)[1], minlength=len(df))
        held = np.flatnonzero(df)
        yield pa.record_batch({"term": np.append(held, -1), "n": np.append(df[held], n)})

    return frequencies


def _vectors(shared: Broadcast, id_type: pa.DataType):
    """(doc_id, toxic, terms, counts) of examples."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        for batch in batches:
            for words in bytewords.words(batch.column("text")):
                bounds, terms, counts = _sparse(words, lookup)
                own = slice(words.first_row, words.first_row + words.n_texts)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").cast(id_type)[own],
                        "toxic": batch.column("toxic")[own],
                        "terms": pa.ListArray.from_arrays(bounds, pa.array(terms)),
                        "counts": pa.ListArray.from_arrays(bounds, pa.array(counts)),
                    }
                )

    return vectors


@dataclass
class Index:
    """Entries (distinct example vectors); those of entry i are first[i] to first[i + 1]."""

    scale: np.ndarray
    ids: list
    toxic: np.ndarray
    clean: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.scale[terms]
        return weights / np.sqrt((weights**2).sum())

    def vote(self, entries: np.ndarray, similarity: np.ndarray, prior: float) -> float:
        """Share of toxic among the neighbours, weighted by similarity over distance."""
        near = similarity / (np.maximum(1 - similarity, 0.0) + NEAR)
        bad = float((near * self.toxic[entries]).sum())
        good = float((near * self.clean[entries]).sum())
        return (bad + _SMOOTH * prior) / (bad + good + _SMOOTH)


class Search:
    """The index over the entries with their bounds, as workers build it."""

    def __init__(self, index: Index) -> None:
        self.index = index
        n, n_terms = len(index.ids), len(index.scale)
        entries = np.repeat(np.arange(n, dtype=np.int32), np.diff(index.first))
        df = np.bincount(index.terms, minlength=n_terms)
        often = np.argsort(-df, kind="stable")[: _MOST_CELLS // n]
        often = often[df[often] * _COMMON >= n]
        mass = np.bincount(index.terms, index.weights**2, n_terms)[often]
        heaviest = np.argsort(-mass, kind="stable")
        often, mass = often[heaviest], mass[heaviest]
        self.column = np.full(n_terms, -1, dtype=np.int32)
        self.column[often] = np.arange(len(often))
        column = self.column[index.terms]
        common = column >= 0
        self.dense = np.zeros((n, len(often)), dtype=np.float32)
        self.dense[entries[common], column[common]] = index.weights[common]
        # Columns of like weight share a group, few where they are heavy, so bounds are tight.
        self.alone = min(ALONE, len(often))
        reached = np.append(0, np.cumsum(np.sqrt(mass[self.alone :])))
        shares = np.linspace(0, reached[-1], GROUPS + 1)[1:-1]
        inner = self.alone + np.searchsorted(reached, shares)
        self.cuts = np.unique(np.concatenate(([self.alone], inner, [len(often)])))
        self.norms = self._norms(self.dense)
        terms = index.terms[~common]
        order = np.argsort(terms, kind="stable")
        postings = np.empty(len(order), dtype=_POSTING)
        postings["entry"] = entries[~common][order]
        postings["weight"] = index.weights[~common][order]
        self.postings = postings.view("<i8")  # so that both are fetched at once
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.room = np.zeros(n_terms)

    def _norms(self, rows: np.ndarray) -> np.ndarray:
        """The weights of each row in the first columns and its norm in each group of others."""
        norms = np.empty((len(rows), self.alone + len(self.cuts) - 1), dtype=np.float32)
        norms[:, : self.alone] = rows[:, : self.alone]
        for g, (at, end) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True), self.alone):
            norms[:, g] = np.sqrt(np.einsum("ij,ij->i", rows[:, at:end], rows[:, at:end]))
        return norms

    def _exact(self, terms: np.ndarray, query: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Cosines in double precision, each summed in the order of the entry's terms."""
        index = self.index
        if not len(entries):
            return np.empty(0)
        starts, ends = index.first[entries], index.first[entries + 1]
        spans = [slice(at, end) for at, end in zip(starts.tolist(), ends.tolist(), strict=True)]
        self.room[terms] = query
        parts = self.room.take(np.concatenate([index.terms[s] for s in spans]), mode="clip")
        parts *= np.concatenate([index.weights[s] for s in spans])
        self.room[terms] = 0
        lengths = ends - starts
        return np.add.reduceat(parts, np.cumsum(lengths) - lengths)

    def nearest(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = K
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each (terms, counts) the k nearest entries and cosines, best first, ties by entry."""
        queries = [self.index.weigh(*v) for v in vectors]
        n = len(self.dense)
        sums = np.zeros((len(vectors), n), dtype=np.float32)
        often = np.zeros((len(vectors), self.dense.shape[1]), dtype=np.float32)
        for i, ((terms, _), query) in enumerate(zip(vectors, queries, strict=True)):
            column = self.column[terms]
            common = column >= 0
            often[i, column[common]] = query[common]
            starts, ends = self.first[terms[~common]], self.first[terms[~common] + 1]
            held = self.postings.take(_spans(starts, ends - starts), mode="clip")
            parts = np.repeat(query[~common].astype(np.float32), ends - starts)
            parts *= held.view(_POSTING)["weight"]
            held >>= 32  # the entries
            sums[i] = np.bincount(held, parts, n)
        bound = self._norms(often) @ self.norms.T
        bound += sums
        bound += _SLACK
        worst = np.empty(len(vectors), dtype=np.float32)
        for i in range(len(vectors)):
            some = np.argpartition(bound[i], max(n - FIRST, 0))[max(n - FIRST, 0) :]
            worst[i] = _kth(sums[i, some] + self.dense[some] @ often[i], k)
        reach = bound >= worst[:, None]
        many = np.count_nonzero(reach, axis=1) > FEW
        near = reach & many[:, None]
        for at in range(0, n, BLOCK) if many.any() else ():
            rows, span = np.flatnonzero(near[:, at : at + BLOCK].any(axis=1)), slice(at, at + BLOCK)
            sums[rows, span] += often[rows] @ self.dense[span].T
        found = []
        for i, ((terms, _), query) in enumerate(zip(vectors, queries, strict=True)):
            entries = np.flatnonzero(reach[i])
            reached = sums[i, entries]
            if not many[i]:
                reached += self.dense[entries] @ often[i]
            keep = reached >= max(worst[i] - _SLACK, _LEAST)
            entries, reached = entries[keep], reached[keep]
            if len(entries) > k:
                entries = entries[reached >= np.partition(reached, -k)[-k] - _SLACK]
            scores = self._exact(terms, query, entries)
            order = np.argsort(-scores, kind="stable")[:k]
            found.append((entries[order], np.minimum(scores[order], 1.0)))
        return found


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of each span, one span after the other."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - ends + lengths, lengths)
    at += np.arange(len(at))
    return at


def _kth(sums: np.ndarray, k: int) -> float:
    """The k-th largest, or 0."""
    return np.partition(sums, -k)[-k] if len(sums) > k else 0.0


def _log_odds(p: float) -> float:
    return float(np.log(p / (1 - p)))


def build_index(
    examples: pa.Table, scale: np.ndarray, toxic_weight: float, clean_weight: float
) -> Index:
    """examples: (doc_id, toxic, terms, counts); those without terms are no entries."""
    ids, bad = examples["doc_id"].to_pylist(), examples["toxic"].to_pylist()
    lists = [pa.concat_arrays(examples[c].chunks) for c in ("terms", "counts")]
    bounds = np.append(0, np.cumsum(lists[0].value_lengths()))
    all_terms, all_counts = (held.flatten().to_numpy() for held in lists)
    index = Index(scale, [], *(np.empty(0) for _ in range(5)))
    merged: dict[bytes, list] = {}
    for i in pc.sort_indices(examples["doc_id"]).to_pylist():
        own = slice(bounds[i], bounds[i + 1])
        if own.start == own.stop:
            continue
        digest = hashlib.blake2b(all_terms[own].tobytes(), digest_size=32)
        digest.update(all_counts[own].tobytes())
        held = merged.setdefault(digest.digest(), [ids[i], 0.0, 0.0, own])
        held[1 if bad[i] else 2] += toxic_weight if bad[i] else clean_weight
    df = np.bincount(all_terms, minlength=len(scale))
    often = df * _COMMON >= len(ids)
    vectors = []
    for key, held in merged.items():
        terms = all_terms[held[3]]
        weights = index.weigh(terms, all_counts[held[3]]).astype(np.float32)
        heaviest = int(terms[(weights * (1e-6 + often[terms])).argmax()])
        vectors.append((heaviest, terms, weights, held, key))
    # Entries with the same heaviest common term share blocks, so bounds are tight.
    vectors.sort(key=lambda v: (v[0], v[4]))
    index.ids = [v[3][0] for v in vectors]
    index.toxic = np.array([v[3][1] for v in vectors])
    index.clean = np.array([v[3][2] for v in vectors])
    index.first = np.append(0, np.cumsum([len(v[1]) for v in vectors]))
    index.terms = np.concatenate([v[1] for v in vectors])
    index.weights = np.concatenate([v[2] for v in vectors])
    return index


def _fit_curve(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a logistic curve through weighted votes, by damped Newton steps."""
    theta, z = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)])
    total = toxic + clean
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ z, -30, 30)))
        slope = z @ (toxic - total * p) - 1e-3 * (theta - [1.0, 0.0])
        bend = (z * (total * p * (1 - p))) @ z.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta + step / max(1.0, np.abs(step).max())
    return float(max(theta[0], 0.05)), float(theta[1])


@dataclass
class Model:
    """What scores a vector: the index, the curve, and the score without neighbours."""

    vocabulary: np.ndarray
    index: Index | None
    prior: float
    alone: float
    toxic_weight: float = 1.0
    clean_weight: float = 1.0
    slope: float = 1.0
    offset: float = 0.0

    def score(self, vote: float) -> float:
        x = np.clip(self.slope * _log_odds(vote) + self.offset, -30, 30)
        return float(1 / (1 + np.exp(-x)))

    def vote_without(
        self, entries: np.ndarray, similarity: np.ndarray, toxic: bool
    ) -> float:
        """The vote for an example of the index without itself."""
        side, weight = (
            (self.index.toxic, self.toxic_weight) if toxic else (self.index.clean, self.clean_weight)
        )
        own = entries[np.argmax(similarity)]
        held = side[own]
        side[own] = max(held - weight, 0.0)
        vote = self.index.vote(entries, similarity, self.prior)
        side[own] = held
        return vote


def fit(
    examples: pa.Table, vocabulary: np.ndarray, scale: np.ndarray, n_toxic: int, n_clean: int
) -> Model:
    """examples: (doc_id, toxic, terms, counts); n_toxic, n_clean: labels learned from."""
    total = n_toxic + n_clean
    prior = (n_toxic + 0.5) / (total + 1) if total else 0.0
    toxic = examples["toxic"].to_numpy().astype(bool)
    bad, good = int(toxic.sum()), int((~toxic).sum())
    if not bad or not good:
        return Model(vocabulary, None, prior, n_toxic / total if total else 0.0)
    # An example stands for this many labels of its class, as a share of all examples.
    rate = len(toxic) / total
    toxic_weight, clean_weight = n_toxic / bad * rate, n_clean / good * rate
    told = pc.list_value_length(examples["terms"]).to_numpy() > 0
    blank_bad = (toxic & ~told).sum() * toxic_weight
    blank_all = blank_bad + (~toxic & ~told).sum() * clean_weight
    alone = float((blank_bad + prior) / (blank_all + 1))
    model = Model(vocabulary, None, prior, alone, toxic_weight, clean_weight)
    if told.any():
        model.index = build_index(examples, scale, toxic_weight, clean_weight)
    return model


_SEARCH: dict[str, tuple[Model, Search]] = {}


def _ready(name: str, shared: Broadcast) -> tuple[Model, Search]:
    """The model and its search, kept by the worker between tasks."""
    if name not in _SEARCH:
        _SEARCH.clear()
        model = shared.value
        _SEARCH[name] = model, Search(model.index)
    return _SEARCH[name]


def _left_out(name: str, shared: Broadcast):
    """(x, toxic): log odds of each example's vote without itself."""

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, search = _ready(name, shared)
            toxic, x = batch.column("toxic").to_pylist(), []
            pairs = [(t.values.to_numpy(), c.values.to_numpy()) for t, c in zip(
                batch.column("terms"), batch.column("counts"), strict=True
            )]
            for at in range(0, len(pairs), _TOGETHER):
                found = search.nearest(pairs[at : at + _TOGETHER])
                for i, (entries, similarity) in enumerate(found, at):
                    x.append(_log_odds(model.vote_without(entries, similarity, toxic[i])))
            yield pa.record_batch({"x": pa.array(x, pa.float64()), "toxic": batch.column("toxic")})

    return left_out


def _scored(
    name: str, shared: Broadcast, slope: float, offset: float, id_type: pa.DataType
):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, search = _ready(name, shared)
        model.slope, model.offset = slope, offset
        lookup = _Lookup(model.vocabulary)
        for batch in batches:
            ids = batch.column("doc_id").cast(id_type)
            for words in bytewords.words(batch.column("text")):
                bounds, terms, counts = _sparse(words, lookup)
                scores = np.full(words.n_texts, model.alone)
                nearest, similar = [[]] * words.n_texts, [[]] * words.n_texts
                told = np.flatnonzero(np.diff(bounds))
                for at in range(0, len(told), _TOGETHER):
                    some = told[at : at + _TOGETHER]
                    spans = [slice(bounds[i], bounds[i + 1]) for i in some]
                    found = search.nearest([(terms[s], counts[s]) for s in spans])
                    for i, (entries, similarity) in zip(some, found, strict=True):
                        scores[i] = model.score(
                            model.index.vote(entries, similarity, model.prior)
                        )
                        nearest[i] = [model.index.ids[e] for e in entries]
                        similar[i] = similarity.tolist()
                yield pa.record_batch(
                    {
                        "doc_id": ids.slice(words.first_row, words.n_texts),
                        "score": scores,
                        "nearest": pa.array(nearest, pa.list_(id_type)),
                        "similarity": pa.array(similar, pa.list_(pa.float64())),
                    }
                )

    return scored


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, nearest, similarity) for every row of documents.

    labels: (doc_id, toxic 0/1), all of which may be learned from. nearest: doc_ids of the
    examples that voted, best first, one for each distinct vector; similarity: their cosines.
    """
    field = documents.schema["doc_id"]
    id_name, id_type = field.dataType.simpleString(), to_arrow_type(field.dataType)
    context = documents.sparkSession.sparkContext
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    n_toxic, n_clean = known.agg(
        F.count_if(F.col("toxic")), F.count_if(~F.col("toxic"))
    ).first()
    # Bounded by MOST_EXAMPLES for each class, so it may be sent to every executor.
    order = F.xxhash64("doc_id", F.lit(17))
    sample = cut(
        known.where("toxic").orderBy(order).limit(MOST_EXAMPLES).union(
            known.where("not toxic").orderBy(order).limit(MOST_EXAMPLES)
        )
    )
    examples = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
    counts = (
        examples.mapInArrow(_term_counts, "term long, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toArrow()
    )
    hashes = counts["term"].to_numpy().view(np.uint64)
    ascending = np.argsort(hashes)
    vocabulary = hashes[ascending]
    words = context.broadcast(vocabulary)
    vectors = cut(
        examples.mapInArrow(
            _vectors(words, id_type),
            f"doc_id {id_name}, toxic boolean, terms array<int>, counts array<int>",
        )
    )
    held = vectors.toArrow()
    bad, n_held = int(np.sum(held["toxic"].to_numpy())), len(held)
    found = (
        texts.select("text")
        .mapInArrow(_frequencies(words), "term long, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    terms, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(vocabulary))
    df[terms[terms >= 0]] = n[terms >= 0]
    idf = np.log((1 + n[terms < 0].sum()) / (1 + df)) + 1
    toxic, clean = (counts[c].to_numpy()[ascending] for c in ("toxic", "clean"))
    scale = idf * _tell(toxic, clean, bad, n_held - bad)
    del counts, found, terms, n, df, toxic, clean, hashes, ascending
    model = fit(held, vocabulary, scale, n_toxic, n_clean)
    del held
    columns = f"doc_id {id_name}, score double, nearest array<{id_name}>, similarity array<double>"
    if model.index is None:
        return texts.select(
            "doc_id",
            F.lit(model.alone).alias("score"),
            F.array().cast(f"array<{id_name}>").alias("nearest"),
            F.array().cast("array<double>").alias("similarity"),
        )
    name, shared = uuid.uuid4().hex, context.broadcast(model)
    votes = (
        vectors.where("size(terms) > 0")
        .mapInArrow(_left_out(name, shared), "x double, toxic boolean")
        .toArrow()
        .sort_by([("x", "ascending"), ("toxic", "ascending")])
    )
    mine = votes["toxic"].to_numpy()
    slope, offset = _fit_curve(
        votes["x"].to_numpy(), mine * model.toxic_weight, ~mine * model.clean_weight
    )
    return texts.mapInArrow(_scored(name, shared, slope, offset, id_type), columns)
