"""Repeated word sequences against a count of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from playpulse.llm import bitfilter, substring_dedup

K = substring_dedup.K


def plain(rows, k=K):
    """{(doc_id, text): (words, removed, words left)} by a dictionary of all windows."""

    def order(row):
        return (row[0] is None, row[0] or 0)

    docs = {}
    for doc_id, text in sorted(rows, key=order):
        docs[(doc_id, text)] = (text or "").encode().split()
    seen, out = set(), {}
    for key, words in docs.items():
        gone = np.zeros(len(words), dtype=bool)
        for i in range(len(words) - k + 1):
            window = tuple(words[i : i + k])
            if window in seen:
                gone[i : i + k] = True
            seen.add(window)
        left = [w for w, g in zip(words, gone) if not g]
        out[key] = (len(words), int(gone.sum()), hashlib.sha256(b" ".join(left)).hexdigest())
    return out


def some_texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ä", "naïve", "W1", "a" * 30, "\x00", " ", "x y"]
    passages = [" ".join(rng.choices(words, k=rng.randint(15, 60))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            own = rng.choice([" ", "\n", " \t ", "\x0b"]).join(rng.choices(words, k=rng.randint(1, 40)))
            parts += [own, rng.choice(passages)]
        texts.append(rng.choice([" ", "\r\n"]).join(parts))
    texts += ["same words " * 40, "same words " * 41, texts[0], " ".join(["a"] * 100)]
    return texts


def check(df, rows, k=K):
    want = plain(rows, k)
    found = substring_dedup.digests(df).collect()
    assert len(found) == len(rows)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(want[(doc_id, text)])
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot", [False, True])
def test_all_repeated_windows_go(spark, docs_of, monkeypatch, seed, hot):
    if hot:  # every minimiser is hot, so every window travels by itself
        survey = substring_dedup.survey

        def all_hot(*args):
            filled, codes = survey(*args)
            return np.full_like(filled, 0xFFFFFFFF), codes

        monkeypatch.setattr(substring_dedup, "survey", all_hot)
    rows = list(enumerate(some_texts(seed)))
    check(substring_dedup.dedup_substrings(docs_of(rows).repartition(3)), rows)


def test_other_lengths(spark, docs_of):
    rows = list(enumerate(some_texts(11, 30)))
    check(substring_dedup.dedup_substrings(docs_of(rows), k=7, m=3), rows, 7)


def test_hot_minimisers_are_found(spark, docs_of):
    """A passage in most documents is hot; its windows still go everywhere but once."""
    passage = " ".join(f"common{i}" for i in range(30))
    rows = [(i, f"own {i} {passage} tail {i}") for i in range(700)]
    docs = docs_of(rows).repartition(4)
    filled, _ = substring_dedup.survey(docs)
    assert filled.any()
    check(substring_dedup.dedup_substrings(docs), rows)


def test_packed_words_are_told_apart():
    texts = pa.array(["ab abc  abcdefghijklmnopq ab\x00 é ab", "", "longer-than-sixteen-bytes x"])
    codes = substring_dedup.Codes([b"ab", b"abc", b"\xc3\xa9", *[b"v%d" % i for i in range(2500)], b"x"])
    for words in substring_dedup.words_of(texts):
        packed = substring_dedup.Packed(words, codes)
        strings = packed.strings(words.bounds[[0, 2]], np.diff(words.bounds)[[0, 2]])
        again = substring_dedup.Unpacked(strings)
        assert np.diff(again.bounds).tolist() == [6, 2]
        spelled = [again.data[a:b].tobytes() for a, b in zip(again.starts, again.ends)]
        assert spelled[0] == spelled[5] and len(spelled[0]) == 2
        assert len(set(spelled)) == 7
        assert spelled[2] == b"abcdefghijklmnopq " and spelled[3] == b"ab\x00 "
        assert len(spelled[7]) == 3  # a code of three bytes


def test_awkward_rows(awkward, no_rows, docs_of):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    out = substring_dedup.dedup_substrings(awkward)
    check(out, rows)
    assert out.select("node", "hash", "lang").distinct().count() == 1
    assert substring_dedup.dedup_substrings(no_rows).collect() == []
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[2] == "" and texts[3] == " \n\t "


def test_long_texts_and_ties(docs_of):
    """Texts over several slices, equal ids with different texts, equal rows."""
    long = " ".join(f"w{i % 50021}" for i in range(400_000))  # 2.6 MB, repeats after 50,021 words
    rows = [(1, long), (1, long), (2, "x " + long[:200]), (None, long[:300]), (None, long[:300])]
    assert len(long) > 2 * bytes_per_slice()
    check(substring_dedup.dedup_substrings(docs_of(rows)), rows)


def bytes_per_slice():
    from playpulse.llm import bytewords

    return bytewords.SLICE_BYTES


def test_clashing_names(spark):
    names = ["row", "id", "m_id", "m_hash", "marks", "text_hash", "doubt", "kept", "n_words", "start"]
    rows = [(i, t) for i, t in enumerate(some_texts(4, 20))]
    full = [(*r, *["x"] * len(names)) for r in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = substring_dedup.dedup_substrings(docs)
    check(out, rows)
    assert set(out.columns) == {"doc_id", "text", "n_removed", *names}
    assert {r.marks for r in out.collect()} == {"x"}


def test_filter_bits_decide_nothing():
    some = np.zeros((1 << bitfilter.BITS) // 32, dtype=np.uint32)
    assert not bitfilter.passing(some, np.arange(10)).any()
