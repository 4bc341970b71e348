"""Decontamination against every window of every item."""

import random

import pytest
from playpulse.llm import winnowing

from .conftest import words_of


def brute(docs, items, window=10):
    wanted = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            wanted.setdefault(tuple(words[k : k + size]), set()).add(item_id)
    sizes = {len(w) for w in wanted}
    out = []
    for doc_id, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                found = wanted.get(tuple(words[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    ids |= found
        out.append((doc_id, len(words), len(hit), sorted(str(i) for i in ids if i is not None)))
    return out


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(30)]
    items += [(0, items[0][1]), (3, "another text of item three " * 3), (None, "x y z"), (50, None), (51, "v1")]
    docs = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            span = words_of(rng.choice(items)[1])
            at = rng.randint(0, len(words))
            cut = rng.randint(0, max(0, len(span) - 9))
            words[at:at] = span[cut : cut + rng.randint(5, 20)]
        docs.append((i, ", ".join(words).upper() if i % 3 else ". ".join(words)))
    docs += [(100, "v1 v2 " * 40), (101, items[5][1]), (101, items[5][1]), (102, None)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_shared_windows_are_found(spark, docs_of, seed):
    docs, items = made(seed)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = winnowing.contamination(docs_of(docs), benchmark).collect()
    rows = sorted((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in got)
    assert rows == sorted(brute(docs, items))
    clean = [r.doc_id for r in winnowing.decontaminate(docs_of(docs), benchmark).collect()]
    assert sorted(clean) == sorted(d for d, _, n, _ in brute(docs, items) if not n)


def test_awkward_rows(spark, awkward, no_rows, docs_of):
    items = spark.createDataFrame([(1, "twice over with more words than five")], "item_id long, text string")
    got = {r.doc_id: r.n_hit for r in winnowing.contamination(awkward, items).collect()}
    assert got[6] == got[7] == 7 and got[1] == got[2] == got[5] == 0
    assert winnowing.decontaminate(awkward, items).count() == 9
    assert winnowing.contamination(no_rows, items).count() == 0
    assert winnowing.decontaminate(no_rows, items).count() == 0
    none = winnowing.contamination(awkward, items.limit(0))
    assert none.count() == 11 and none.where("n_hit > 0").count() == 0
    assert winnowing.decontaminate(awkward, items.limit(0)).columns == awkward.columns
