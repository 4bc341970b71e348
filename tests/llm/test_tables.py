"""Sharding, token files, mixing, toxicity and the pipeline against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from playpulse.llm import (
    huffman,
    mixing,
    queries,
    sharding,
    splitters,
    token_output,
    token_pieces,
    toxicity,
)
from playpulse.llm.scratch import new_folder, ship

import corpus_pipeline

from .conftest import words_of
from .test_near_dedup import classes_of
from .test_winnowing import brute

SF_DIR = "/root/testdata/sf0.001"


# Sharding.


def check_shards(rows, documents, n, slack):
    assert len(rows) == documents.count()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    for held in by_shard.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    sizes = [sum(r.size for r in held) for held in by_shard.values()]
    fair = sum(r.size for r in rows) / n
    largest = max(r.size for r in rows)
    assert set(by_shard) <= set(range(n))
    assert max(sizes) <= fair + largest + slack * fair
    if len(rows) > 20 * n:
        assert len(by_shard) == n and min(sizes) >= fair - largest - slack * fair


def test_shards_are_even_and_keep_equal_texts_together(docs_of):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 900)) for i in range(3000)]
    rows += [(3000 + i, f"text {i % 50} " * 10) for i in range(400)]
    rows += [(4000 + i, "a hot text " * 30) for i in range(1500)]  # a third of all bytes
    documents = docs_of(rows)
    got = sharding.shards(documents, 12).collect()
    check_shards(got, documents, 12, 2 * sharding.GROUP_SHARE)
    homes = {}
    for r in got:
        homes.setdefault(r.text_hash, set()).add(r.shard)
    split = sum(len(s) > 1 for s in homes.values())
    assert split <= 12  # the hot text, and a larger group on a boundary now and then
    again = {(r.doc_id, r.size): r.shard for r in sharding.shards(documents, 12).collect()}
    assert again == {(r.doc_id, r.size): r.shard for r in got}


def test_overfull_ranges_are_subdivided(docs_of, monkeypatch):
    monkeypatch.setattr(splitters, "SAMPLES_PER_RANGE", 1)
    documents = docs_of([(i, "y" * (i % 700)) for i in range(4000)])
    check_shards(sharding.shards(documents, 8).collect(), documents, 8, 2 * sharding.GROUP_SHARE)


def test_sharding_awkward_rows(awkward, no_rows, docs_of):
    got = sharding.shards(awkward, 4).collect()
    assert len(got) == 11
    assert sorted(r.size for r in got if r.doc_id in (1, 2)) == [16, 16]
    assert {r.text_crc32 for r in got if r.doc_id == 4} == {zlib.crc32(b"one")}
    assert sharding.shards(no_rows, 4).count() == 0
    one = sharding.shards(docs_of([(1, "a")] * 30), 4).collect()
    check_shards(one, docs_of([(1, "a")] * 30), 4, 0)


# Token files.


def optimal_cost(counts, limit):
    """Cost of the best code with this limit, by trying all length sets that fill the code."""
    from functools import cache

    counts = sorted(counts, reverse=True)

    @cache
    def best(i, free, depth):
        if i == len(counts):
            return 0
        if depth > limit or free <= 0:
            return float("inf")
        out = float("inf")
        for n in range(min(free, len(counts) - i) + 1):
            rest = best(i + n, (free - n) * 2, depth + 1)
            out = min(out, sum(counts[i : i + n]) * depth + rest)
        return out

    return best(0, 2, 1)


@pytest.mark.parametrize("limit", [3, 4, 6])
def test_code_lengths_are_optimal(limit):
    rng = random.Random(limit)
    for _ in range(15):
        counts = [rng.choice([1, 2, 5, 40, 1000]) for _ in range(rng.randint(2, 8))]
        lengths = huffman.code_lengths(np.array(counts), limit)
        assert lengths.max() <= limit and sum(2.0 ** -int(k) for k in lengths) <= 1
        assert (lengths * counts).sum() == optimal_cost(counts, limit)
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


def test_coding_round_trip():
    rng = np.random.default_rng(1)
    for symbols in (1, 2, 700):
        ids = (rng.zipf(1.3, 5000) % symbols).astype(np.uint32)
        counts = np.bincount(ids)
        used = np.flatnonzero(counts)
        code = huffman.Code(used, huffman.code_lengths(counts[used], 18))
        bounds = np.array([0, 0, 1, 127, 255, 256, 3000, 5000])
        data, at, bits, _ = huffman.encode(ids, bounds, *code.encoder())
        back = huffman.decode(data, at[:-1], np.diff(bounds), bits, *code.decoder())
        assert (back == ids).all()
        # Any text alone, from its own bytes and steps.
        steps = -(-np.diff(bounds) // huffman.STEP)
        first = np.cumsum(steps) - steps
        for i in range(len(bounds) - 1):
            own = huffman.decode(
                data[at[i] : at[i + 1]],
                np.array([0]),
                np.diff(bounds)[i : i + 1],
                bits[first[i] : first[i] + steps[i]],
                *code.decoder(),
            )
            assert (own == ids[bounds[i] : bounds[i + 1]]).all()


def plain_tokens(rows):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    plain = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    return [(d, plain.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows]


def test_token_files_are_read_back(spark, docs_of, awkward, no_rows, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_BYTES", 200)
    public = pytest.importorskip("public_tokenizers")
    for documents in (awkward, docs_of([(i * 7 % 100, f"Doc {i} says hello, {i}!") for i in range(100)])):
        folder = new_folder(spark, "t")
        token_output.write_tokens(documents, folder, public.path("word_bpe_49k.json"), 1)
        got = token_output.read_tokens(spark, folder).collect()
        rows = [(r.doc_id, r.text) for r in documents.collect()]
        assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter(
            (d, tuple(ids)) for d, ids in plain_tokens(rows)
        )
        got.sort(key=lambda r: r.start)
        assert [r.doc_id or -1 for r in got] == sorted(r.doc_id or -1 for r in got)
        at = 0
        for r in got:
            assert (r.start, r.n_tokens) == (at, len(r.ids))
            at += r.n_tokens
    folder = new_folder(spark, "t")
    token_output.write_tokens(no_rows, folder, public.path("word_bpe_49k.json"), 1)
    assert token_output.read_tokens(spark, folder).count() == 0


def test_token_table_needs_one_worker_a_task(spark, docs_of, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = queries.token_table(awkward)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    want = Counter(
        (d, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for d, ids in plain_tokens(rows)
    )
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found.collect()) == want
    assert token_pieces._LOADED == {}
    token_pieces.tokens(open(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")).read())
    token_pieces.forget()
    assert token_pieces._LOADED == {}


# Mixing.


def domain_rows(seed, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        domain = rng.choice(["a", "a", "a", "b"])
        words = [f"common{rng.randrange(200)}" for _ in range(rng.randint(60, 120))]
        words += [f"{domain}word{rng.randrange(5)}" for _ in range(6)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, domain))
    return rows, labels


def test_token_files_start_no_workers_for_rows(spark, docs_of, monkeypatch):
    """Rows of a Python list would be written by workers of another kind, which stay idle."""
    documents = docs_of([(1, "some text"), (2, "more text")])

    def no_rows(*_):
        raise AssertionError("rows of a Python list")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", no_rows)
    assert {r.doc_id: r.start for r in queries.token_table(documents).collect()}[1] == 0


def test_rates_meet_targets_and_are_least_squares(spark, docs_of):
    rows, labels = domain_rows(3)
    documents = docs_of(rows)
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    targets = {"a": 0.5, "b": 0.5}
    got = mixing.rates(documents, known, targets).collect()
    p = np.array([r.p for r in got])
    tokens = np.array([r.n_tokens for r in got], dtype=float)
    rate = np.array([r.rate for r in got])
    reached = (rate * tokens) @ p
    assert reached == pytest.approx([tokens.sum() / 2] * 2, rel=0.01)
    # The same problem solved to the end, without Spark.
    m, shares = tokens / tokens.sum(), tokens @ p / tokens.sum()
    best = np.ones(len(m))
    for _ in range(4000):
        pull = ((best * m) @ p - 0.5) / shares
        best = np.maximum(0, best - (p @ pull + mixing.RIDGE * (best - 1)) / (1 + mixing.RIDGE))
    assert rate == pytest.approx(best, abs=0.02)
    assert all(abs(r.copies - r.rate) < 1 for r in got)
    # Labels not used for fitting are told too.
    truth = {i: ("a" if "aword" in t else "b") for i, t in rows}
    right = sum((r.p[0] > 0.5) == (truth[r.doc_id] == "a") for r in got)
    assert right >= 0.97 * len(got)


def test_missed_targets_are_reported(spark, docs_of):
    import warnings

    rows, labels = domain_rows(3)
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        met, _ = mixing.fit(docs_of(rows), known, {"a": 0.5, "b": 0.5})
    assert met.missed() < mixing.MISSED
    with pytest.warns(UserWarning, match="targets not met"):  # nothing tells documents apart
        off, _ = mixing.fit(docs_of(rows), known.limit(0), {"a": 0.9, "b": 0.1})
    assert off.missed() > mixing.MISSED


def test_words_are_told_in_any_case_and_beside_signs(spark, docs_of):
    rows, labels = domain_rows(7)
    own = " ".join(f"common{i}" for i in range(60))
    forms = ["bword1 bword2 bword3", "Bword1 BWORD2 bWord3", "bword1, (bword2) bword3.", "bword1\tbword2\tbword3"]
    rows += [(1000 + i, f"{own} {form}") for i, form in enumerate(forms)]
    rows += [(2000, f"{own} {forms[0]}".replace(" ", "\t"))]
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    got = {r.doc_id: r for r in mixing.rates(docs_of(rows), known, {"a": 0.5, "b": 0.5}).collect()}
    plain = got[1000]
    assert plain.p[1] > 0.9 and plain.n_tokens == 63
    for i in (1001, 1002, 1003, 2000):
        assert (got[i].p, got[i].rate, got[i].n_tokens) == (plain.p, plain.rate, 63)


def test_kept_domain_is_not_reduced(spark, docs_of):
    rows, labels = domain_rows(5)
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    got = mixing.rates(docs_of(rows), known, {"a": 0.95, "b": 0.05}, keep="a").collect()
    assert np.mean([r.rate for r in got if r.p[0] > 0.99]) == pytest.approx(1, abs=0.02)
    assert np.mean([r.rate for r in got if r.p[1] > 0.99]) < 0.5
    taken = mixing.mix(docs_of(rows), known, {"a": 0.95, "b": 0.05}, keep="a")
    assert taken.columns == docs_of(rows).columns
    want = Counter({r.doc_id: r.copies for r in got if r.copies})
    assert Counter(r.doc_id for r in taken.collect()) == want


def test_mixing_awkward_rows(spark, awkward, no_rows):
    none = spark.createDataFrame([], "doc_id long, domain string")
    known = spark.createDataFrame([(6, "a"), (5, "b"), (5, None), (None, "a")], "doc_id long, domain string")
    for labels in (none, known):
        got = mixing.rates(awkward, labels, {"a": 0.6, "b": 0.4}).collect()
        assert len(got) == 11 and all(r.rate >= 0 for r in got)
        assert mixing.rates(no_rows, labels, {"a": 0.6, "b": 0.4}).count() == 0
        assert mixing.mix(no_rows, labels, {"a": 0.6, "b": 0.4}).count() == 0


# Toxicity.


def test_nearest_is_exact(monkeypatch):
    rng = np.random.default_rng(5)
    scale = rng.uniform(0.02, 4, 60)
    rows = []
    for i in range(900):
        terms = sorted(rng.choice(60, size=rng.integers(1, 7), replace=False).tolist())
        rows.append((i, bool(rng.random() < 0.3), terms, rng.integers(1, 5, len(terms)).tolist()))
    ids, toxic, terms, counts = zip(*rows, strict=True)
    examples = pa.table(
        {
            "doc_id": ids,
            "toxic": toxic,
            "terms": pa.array(terms, pa.list_(pa.int32())),
            "counts": pa.array(counts, pa.list_(pa.int32())),
        }
    )
    index = toxicity.build_index(examples, scale, 1.0, 1.0)
    assert index.toxic.sum() == sum(toxic) and index.toxic.sum() + index.clean.sum() == 900
    dense = np.zeros((len(index.ids), 60))
    for e in range(len(index.ids)):
        span = slice(index.first[e], index.first[e + 1])
        dense[e, index.terms[span]] = index.weights[span]
    assert np.allclose((dense**2).sum(axis=1), 1)
    queries_ = []
    for _ in range(200):
        some = np.sort(rng.choice(60, size=rng.integers(1, 8), replace=False))
        queries_.append((some, rng.integers(1, 4, len(some))))
    # Every share of terms with columns: none, some by two rules, and all.
    for common, cells in ((32, 1 << 25), (8, 1 << 25), (1 << 30, 15_000), (1, 1 << 25)):
        monkeypatch.setattr(toxicity, "_COMMON", common)
        monkeypatch.setattr(toxicity, "_MOST_CELLS", cells)
        search = toxicity.Search(index)
        for (some, n), (got, similarity) in zip(queries_, search.nearest(queries_), strict=True):
            query = np.zeros(60)
            query[some] = index.weigh(some, n)
            scores = dense @ query
            best = np.argsort(-np.round(scores, 12), kind="stable")[: toxicity.K]
            best = best[scores[best] > 0]
            assert similarity == pytest.approx(np.minimum(scores[best], 1))
            assert scores[got] == pytest.approx(scores[best])
            (alone,) = search.nearest([(some, n)])
            assert (alone[0] == got).all() and (alone[1] == similarity).all()


def test_bounds_are_tight_and_hold():
    """No cosine is above its bound; bounds are below those of a block's largest weights."""
    rng = np.random.default_rng(9)
    n, n_terms = 400, 300
    weights = rng.random((n, n_terms)) ** 4 * rng.uniform(0.02, 1, n_terms)
    weights = (weights / np.linalg.norm(weights, axis=1)[:, None]).astype(np.float32)
    first = np.arange(n + 1) * n_terms
    terms = np.tile(np.arange(n_terms, dtype=np.int32), n)
    scale, ones = np.ones(n_terms), np.ones(n)
    search = toxicity.Search(
        toxicity.Index(scale, list(range(n)), ones, ones, first, terms, weights.ravel())
    )
    cosines = search.dense @ search.dense.T
    bounds = search._norms(search.dense) @ search.norms.T
    assert (bounds >= cosines - toxicity._SLACK).all()
    blocks = (n // 50, 50, -1)
    largest = search.dense @ search.dense.reshape(blocks).max(axis=1).T
    assert bounds.reshape(n, *blocks[:2]).max(axis=2).mean() < largest.mean()


def test_heavy_columns_leave_few_entries_to_finish(monkeypatch):
    """Where few terms weigh most, the bounds exclude nearly all that is not among the nearest."""
    rng = np.random.default_rng(4)
    n, n_terms = 2000, 600
    scale = np.where(rng.random(n_terms) < 0.2, rng.uniform(1, 4, n_terms), 0.05)
    held = [np.flatnonzero(rng.random(n_terms) < 0.12).astype(np.int32) for _ in range(n + 50)]
    first = np.append(0, np.cumsum([len(h) for h in held[:n]]))
    ones = np.ones(n)
    index = toxicity.Index(scale, list(range(n)), ones, ones, first, *(np.empty(0),) * 2)
    weighed = [index.weigh(h, np.ones(len(h))) for h in held]
    index.terms, index.weights = np.concatenate(held[:n]), np.concatenate(weighed[:n]).astype(np.float32)
    search = toxicity.Search(index)
    full = np.zeros((n + 50, n_terms))
    for row, at, weights in zip(full, held, weighed, strict=True):
        row[at] = weights
    cosines = full[n:] @ full[:n].T
    queries_ = full[n:, np.argsort(search.column)].astype(np.float32)  # all terms have columns
    bounds = search._norms(queries_) @ search.norms.T
    assert (bounds >= cosines - toxicity._SLACK).all()
    worst = np.sort(cosines, axis=1)[:, -toxicity.K]
    assert (bounds >= worst[:, None]).mean() < 0.02
    for few in (0, toxicity.FEW, n):  # finished by blocks, either way, by themselves
        monkeypatch.setattr(toxicity, "FEW", few)
        found = search.nearest([(h, np.ones(len(h), dtype=int)) for h in held[n:]])
        for (got, similarity), own in zip(found, cosines, strict=True):
            assert own[got] == pytest.approx(np.sort(own)[::-1][: toxicity.K], abs=1e-6)
            assert similarity == pytest.approx(own[got], abs=1e-6)


def terms_of(text):
    words = [w.encode() for w in words_of(text)]
    return Counter(words + [(n, w[:n]) for w in words for n in (4, 5) if len(w) > n])


def test_cosines_of_whole_texts(spark):
    """Every similarity of the query against plain vectors over all terms of the examples."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    ship(spark)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    vectors = {r.doc_id: terms_of(r.text) for r in docs.collect()}
    bad, good = Counter(), Counter()
    known = [d for d in vectors if truth.get(d) is not None]
    n_bad = sum(truth[d] for d in known)
    for d in known:
        (bad if truth[d] else good).update(vectors[d].keys())
    df = Counter(t for v in vectors.values() for t in v)

    def weight(t):
        a, b = bad[t] + 0.5, good[t] + 0.5
        odds = abs(np.log(a / (n_bad + 1)) - np.log(b / (len(known) - n_bad + 1)))
        tell = np.tanh(max(odds - toxicity.SURE * np.sqrt(1 / a + 1 / b), 0))
        idf = np.log((1 + len(vectors)) / (1 + df[t])) + 1
        return idf * (toxicity.LEAST_TELL + (1 - toxicity.LEAST_TELL) * tell)

    weights = {t: weight(t) for t in {*bad, *good}}
    unit = {}
    for d, v in vectors.items():
        w = {t: (1 + np.log(n)) * weights[t] for t, n in v.items() if t in weights}
        norm = np.sqrt(sum(x * x for x in w.values()))
        unit[d] = {t: x / norm for t, x in w.items()}
    entries = {}
    for d in sorted(known):
        if unit[d]:
            entries.setdefault(tuple(sorted(vectors[d].items(), key=repr)), d)
    assert any(len(r.nearest) == toxicity.K for r in got.values())
    for d, v in unit.items():
        cosines = {e: sum(x * unit[e].get(t, 0) for t, x in v.items()) for e in entries.values()}
        best = sorted((c for c in cosines.values() if c > 0), reverse=True)[: toxicity.K]
        assert got[d].similarity == pytest.approx(best, abs=1e-5)
        assert [cosines[e] for e in got[d].nearest] == pytest.approx(best, abs=1e-5)


def test_a_copy_of_a_toxic_example_with_rare_words_is_found(docs_of, spark):
    rng = random.Random(3)
    common = [f"word{i}" for i in range(300)]
    clean = [(i, " ".join(rng.choices(common, k=60))) for i in range(60)]
    toxic = [(100 + i, " ".join(rng.choices(common, k=40)) + " vile foul slur") for i in range(15)]
    rare = " ".join(rng.choices(common, k=40)) + " unheard insulting expressions only here"
    docs = docs_of([*clean, *toxic, (200, rare), (300, rare), (301, clean[0][1])])
    labels = spark.createDataFrame(
        [(d, 0) for d, _ in clean] + [(d, 1) for d, _ in [*toxic, (200, rare)]],
        "doc_id long, toxic int",
    )
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert got[300].nearest[0] == 200 and got[300].similarity[0] == pytest.approx(1, abs=1e-6)
    assert got[300].score >= 0.5 > got[301].score
    assert all(got[d].score >= 0.5 for d, _ in toxic) and all(got[d].score < 0.5 for d, _ in clean)
    assert all(len(r.nearest) for r in got.values())


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op4_nearest_examples"](spark, sf_dir).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [(r.score, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    good = [s for s, t in held if t]
    bad = [s for s, t in held if not t]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.97
    assert all(r.nearest_id is not None for r in found)


def test_toxicity_awkward_rows(spark, awkward, no_rows):
    some = spark.createDataFrame([(6, 1), (5, 0), (5, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    for labels in (some, some.limit(0), some.where("toxic = 1")):
        got = toxicity.toxicity(awkward, labels).collect()
        assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
        assert toxicity.toxicity(no_rows, labels).count() == 0


# The pipeline.


def test_pipeline_against_a_plain_version(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, docs
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF_DIR).persist()
        steps.append(kept)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == columns, name
    import duckdb
    from playpulse.llm import line_quality

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({line_quality.ORACLE_SQL}) WHERE kept").fetchall()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in steps[0].collect()) == sorted(good)
    first = sorted(set(classes_of([(d, texts[d]) for d in sorted(good)]).values()))
    assert sorted(r.doc_id for r in steps[1].collect()) == first
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = [d for d, _, n, _ in brute([(d, texts[d]) for d in first], items) if not n]
    assert sorted(r.doc_id for r in steps[2].collect()) == clean
    mixed = [(r.doc_id, r.text) for r in steps[3].collect()]
    assert set(d for d, _ in mixed) <= set(clean)
    labels = queries.domain_labels(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rates = mixing.rates(steps[2], labels, queries.TARGETS, keep="clean").collect()
    assert Counter(d for d, _ in mixed) == Counter({r.doc_id: r.copies for r in rates if r.copies})
    at, want = 0, []
    for d, ids in sorted(plain_tokens(mixed), key=lambda x: x[0]):
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in steps[4].collect()]
    assert sorted(got) == sorted(want)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in whole) == sorted(want)


def test_stages_take_awkward_and_empty_tables(spark, awkward, no_rows):
    plain = [c for c in awkward.columns if c not in ("node", "hash")]
    for docs in (awkward, no_rows.select(*plain)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        assert docs.count() <= 11


def test_queries_are_registered():
    numbers = {n.split("_")[0] for n in queries.QUERIES if n.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)} and "pipeline" in queries.QUERIES
