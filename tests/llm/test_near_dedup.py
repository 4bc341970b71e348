"""Near duplicates against all pairs, and classes that must not cost all pairs."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from playpulse.llm import bytewords, near_dedup
from playpulse.llm.components import components
from playpulse.llm.scratch import FILE_CLEANUP

from .conftest import words_of


def similarity(a, b):
    total = 0.0
    both = set(a) | set(b)
    for d in set(a) & set(b):
        total += 1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in both)
    return total


def shingles_of(text):
    words = words_of(text)
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes_of(rows):
    """doc_id -> least doc_id of its class, by comparing all pairs."""
    sets = [shingles_of(t) for _, t in rows]
    least = {i: i for i in range(len(rows))}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, (_, text) in enumerate(rows):
        for j in range(i):
            other = rows[j][1]
            if text is None or other is None:
                continue
            if not sets[i] or not sets[j]:
                alike = text == other
            else:
                alike = similarity(sets[i], sets[j]) >= near_dedup.THRESHOLD
            if alike:
                a, b = root(i), root(j)
                least[max(a, b)] = min(a, b)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest.setdefault(root(i), []).append(doc_id)
    return {doc_id: min(smallest[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def made_rows(seed):
    """Texts, with exact and near copies at every distance, chains and repeated lines."""
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, texts = [], []
    for _ in range(14):
        base = rng.choices(vocabulary, k=rng.randint(3, 90))
        if rng.random() < 0.3:
            base = base * 2
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper() + rng.choice(["", ".", "!"]))
            if rng.random() < 0.4:
                base = copy  # a copy of a copy
    texts += ["", "!!!", "!!!", None, None]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_are_those_of_all_pairs(docs_of, seed):
    rows = made_rows(seed)
    found = near_dedup.near_duplicates(docs_of(rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == classes_of(rows)
    kept = near_dedup.dedup(docs_of(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes_of(rows).values()))
    assert kept.columns == docs_of(rows).columns


def test_registers_agree_as_often_as_texts_are_similar():
    rng = random.Random(7)
    tokens = [rng.getrandbits(63) for _ in range(60)]
    errors = []
    for k in (10, 25, 40):
        a = Counter(dict.fromkeys(tokens[:45], 1) | {tokens[0]: 4, tokens[44]: 2})
        b = Counter(dict.fromkeys(tokens[45 - k :], 1) | {tokens[44]: 3})
        agree = []
        for salt in range(12):
            rows, hashes, weights = [], [], []
            for n, bag in enumerate((a, b)):
                for d, w in bag.items():
                    rows.append(n)
                    hashes.append((d * 1_000_003 + salt) % (1 << 64))
                    weights.append(w)
            signed = near_dedup.signatures(
                np.array(rows), np.array(hashes, dtype=np.uint64), np.array(weights), 2
            )
            agree.append((signed[0] == signed[1]).mean())
        errors.append(abs(np.mean(agree) - similarity(a, b)))
    assert max(errors) < 0.04


def test_probability_jaccard_is_the_definition():
    a = np.array([1, 1, 1, 2, 3, 4], dtype=np.uint64)
    b = np.array([1, 2, 2, 3, 5], dtype=np.uint64)
    want = similarity(Counter(a.tolist()), Counter(b.tolist()))
    assert near_dedup.probability_jaccard(a, b) == pytest.approx(want)


def test_bound_on_pairs_holds():
    """No pair above the threshold is left out by the bound on unshared weight."""
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randint(3, 30)
        a = Counter(rng.choices(range(n), k=rng.randint(1, 40)))
        b = Counter(rng.choices(range(n), k=rng.randint(1, 40)))
        u = sum(w for d, w in a.items() if d not in b) / sum(a.values())
        v = sum(w for d, w in b.items() if d not in a) / sum(b.values())
        if u < 1 and v < 1:
            assert similarity(a, b) <= (1 - u) * (1 - v) / (1 - u * v) + 1e-12


def test_awkward_rows(awkward, no_rows):
    found = near_dedup.near_duplicates(awkward).collect()
    assert len(found) == 11
    by_id = {r.doc_id: (r.class_id, r.class_size) for r in found}
    assert by_id[5] == (5, 2) and by_id[7] == (6, 2) and by_id[1] == (1, 1)
    kept = [r.doc_id for r in near_dedup.dedup(awkward).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 6, None, 8, 9], key=str)
    assert near_dedup.near_duplicates(no_rows).count() == 0
    assert near_dedup.dedup(no_rows).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (9, 8), (8, 7), (20, 20)] + [(30, n) for n in range(31, 90)]
    df = spark.createDataFrame([(str(a).zfill(3), str(b).zfill(3)) for a, b in edges], "a string, b string")
    got = {r.node: r.label for r in components(df).collect()}
    assert {got[str(n).zfill(3)] for n in range(1, 7)} == {"001"}
    assert {got[str(n).zfill(3)] for n in (7, 8, 9)} == {"007"}
    assert len({got[str(n).zfill(3)] for n in range(30, 90)}) == 1
    assert components(df.limit(0)).count() == 0


def test_pairs_of_large_groups_are_rows_only_where_they_may_be_similar(spark, docs_of, monkeypatch):
    """Variations of one text: classes as by all pairs, however blocks are dealt; rows are few."""
    rng = random.Random(11)
    base = [f"word{i}" for i in range(40)]
    rows = []
    for i in range(120):
        copy = list(base) if i % 40 else [f"other{i}x{j}" for j in range(30)] * 2
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(12)}"
        rows.append((i, " ".join(copy)))
    sets = [shingles_of(t) for _, t in rows]
    close = sum(similarity(a, b) >= 0.6 for i, a in enumerate(sets) for b in sets[:i])
    emitted = []
    links = near_dedup._links

    def counted(pairs, texts, threshold):
        emitted.append(pairs.count())
        return links(pairs, texts, threshold)

    monkeypatch.setattr(near_dedup, "_links", counted)
    for block, named in ((256, 16), (7, 1)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "NAMED", named)
        emitted.clear()
        found = near_dedup.near_duplicates(docs_of(rows)).collect()
        assert {r.doc_id: r.class_id for r in found} == classes_of(rows)
        assert sum(emitted) < close


def test_sketches_exclude_no_similar_pair():
    """Repeats, and cells that are full on one side or on both."""
    rng = random.Random(12)
    texts = []
    for n in (6, 12, 40, 200, 40_000, 40_000):
        words = [f"w{rng.randrange(n * 2)}" for _ in range(n)]
        for lost in (0, 1, 2, n // 40, n // 10):
            copy = list(words) + (words[: n // 8] if lost == 2 else [])
            for _ in range(lost):
                copy[rng.randrange(len(copy))] = "x" + str(rng.random())
            texts.append(" ".join(copy))
    batch = pa.record_batch(
        {"node": [hashlib.md5(t.encode()).digest() for t in texts], "text": texts}
    )
    sketched = pa.Table.from_batches(list(near_dedup._sketch([batch])))
    # one block, each text in a class of its own, without names: all that may be similar
    rows = [{**r, "label": r["node"], "named": [], "used": 0.0} for r in sketched.to_pylist()]
    m = pa.array(
        [rows],
        pa.list_(
            pa.struct(
                {
                    "node": pa.binary(),
                    "label": pa.binary(),
                    "named": pa.list_(pa.int64()),
                    "used": pa.float64(),
                    "total": pa.int64(),
                    "distinct": pa.int64(),
                    "sketch": pa.binary(),
                }
            )
        ),
    )
    block = pa.record_batch({"bucket": pa.array([5], pa.int64()), "m": m})
    met = pa.Table.from_batches(list(near_dedup._meet(0.8)([block])))
    pairs = {frozenset(p.values()) for p in met.to_pylist()}
    hashes = list(near_dedup._each_shingles(pa.array(texts)))
    nodes = batch.column("node").to_pylist()
    n_similar = 0
    for i, a in enumerate(hashes):
        for j in range(i):
            if nodes[i] != nodes[j] and near_dedup.probability_jaccard(a, hashes[j]) >= 0.8:
                n_similar += 1
                assert frozenset((nodes[i], nodes[j])) in pairs
    assert n_similar > 4
    assert len(pairs) < 300


def test_dedup_needs_one_worker_a_task(docs_of):
    """A filter of what the function tells must not make a stage run it a second time."""
    kept = near_dedup.dedup(docs_of([(i, f"some words of text {i % 5} and more") for i in range(9)]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    branches = plan.count("LogicalRDD") or plan.count("Scan ExistingRDD[doc_id")
    assert plan.count("ArrowEvalPython") == branches == 3
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_shuffle_files_go_when_their_rows_are_kept(spark, docs_of):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {b for b in found.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}

    before = shuffled()
    body = " ".join(f"w{i}" for i in range(60))
    documents = docs_of([(i, f"{body} x{i % 4}") for i in range(20)] + [(99, "no other text")])
    rows = near_dedup.near_duplicates(documents)
    for _ in range(50):  # Spark deletes them beside the next job
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(FILE_CLEANUP, None) is None
    for _ in range(2):  # what is kept can be read again and again
        assert {r.doc_id: r.class_id for r in rows.collect()} == {i: 0 for i in range(20)} | {99: 99}
