"""Words and token pieces against the plain way of finding them."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from playpulse.llm import bytewords, token_pieces, toxicity

from .conftest import words_of

TEXTS = st.lists(st.none() | st.text(alphabet="aAzZ09é日\n \t.,'!<|>́", max_size=40), max_size=12)


def found(column):
    out = {}
    for words in bytewords.words(column):
        for i in range(words.n_texts):
            span = range(words.bounds[i], words.bounds[i + 1])
            out[words.first_row + i] = [
                (words.word(j).decode(), int(words.hashes[j])) for j in span
            ]
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    got = found(pa.array(texts, pa.string()))
    known = {}
    for i, text in enumerate(texts):
        assert [w for w, _ in got[i]] == words_of(text)
        for word, value in got[i]:
            assert known.setdefault(value, word) == word


def test_slices_do_not_change_hashes(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(90)) for _ in range(9)]
    texts.append("x" * 5000 + " y " + "z" * 700)
    whole = found(pa.array(texts))
    monkeypatch.setattr(bytewords, "SLICE_BYTES", 1000)
    cut = found(pa.array(["dropped", *texts]).slice(1))
    for i in range(len(texts)):
        assert [w for w, _ in whole[i]] == [w for w, _ in cut[i]]
        short = [(a, b) for (a, b) in whole[i] if len(a) < 1000]
        assert short == [(a, b) for (a, b) in cut[i] if len(a) < 1000]


def test_expand():
    got = bytewords.expand(np.array([5, 2, 9]), np.array([2, 0, 3]))
    assert got.tolist() == [5, 6, 9, 10, 11]


def test_token_pieces_are_the_tokenizers_ids():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    plain = tokenizers.Tokenizer.from_str(definition)
    rng = random.Random(5)
    parts = [*"aAzZ09 \n\t'.,!<>|=~-", "é", "é", "≮", "ß", "Σ", "İ", "日本", "\x1c", "\x85"]
    parts += ["½", "'s", "'re", "<|endoftext|>", "<|startoftext|>", "̸", "x" * 60, "don't", "THE&&&"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)] + [None, ""]
    for first, ids, bounds in token_pieces.encoded(definition, pa.array(texts), 1):
        for i in range(len(bounds) - 1):
            want = plain.encode(texts[first + i] or "", add_special_tokens=False).ids + [1]
            assert ids[bounds[i] : bounds[i + 1]].tolist() == want


def test_new_pieces_are_tokenized_together(monkeypatch):
    """Letters in few calls, whatever case; ids are the tokenizer's where marks or lower-casing
    split a word of letters, where a capital composes, and where the table is emptied."""
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    plain = tokenizers.Tokenizer.from_str(definition)
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghiJKL", k=9)) for _ in range(4000)]
    coder = token_pieces.Tokens(definition)
    asked = []

    def counted(texts):
        asked.extend(texts)
        return [np.array(plain.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]

    monkeypatch.setattr(coder, "_encoded", counted)
    monkeypatch.setitem(token_pieces._LOADED, definition, coder)
    odd = ["H\u0331a h\u0331a", "İstanbul", "\u0958\u0915", "E\u0301 e\u0301 É", "K\u212a k", "ΣΑΣ σασ"]
    odd += ["A <|endoftext|> a <|ENDOFTEXT|>", "ab AB aB 1a 1A", "don't DON'T"]
    for most in (1 << 20, 1500):
        monkeypatch.setattr(token_pieces, "_MOST_ENTRIES", most)
        for texts in ([" ".join(words), *odd], [" ".join(words).swapcase(), *odd]):
            for first, ids, bounds in token_pieces.encoded(definition, pa.array(texts), 1):
                for i in range(len(bounds) - 1):
                    want = plain.encode(texts[first + i], add_special_tokens=False).ids + [1]
                    assert ids[bounds[i] : bounds[i + 1]].tolist() == want
            if most > 1500:
                assert len(asked) < 200


def test_terms_are_found_by_their_leading_bits():
    """Terms that share their leading bits, the least and the largest; none in an empty one."""
    rng = np.random.default_rng(4)
    near = np.arange(50, dtype=np.uint64) + np.uint64(7 << 50)
    known = np.unique(np.concatenate([rng.integers(0, 1 << 64, 3000, np.uint64), near]))
    known = np.unique(np.append(known, np.array([0, (1 << 64) - 1], dtype=np.uint64)))
    asked = np.concatenate([known, rng.integers(0, 1 << 64, 3000, np.uint64), near + np.uint64(99)])
    places = {int(h): i for i, h in enumerate(known)}
    found = toxicity._Lookup(known).find(asked)
    assert found.tolist() == [places.get(int(h), -1) for h in asked]
    assert (toxicity._Lookup(known[:0]).find(asked) == -1).all()
