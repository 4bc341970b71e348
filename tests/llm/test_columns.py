"""Extra columns of any name, very long texts and empty tables, through operators and stages."""

import random
from collections import Counter

import pytest
from playpulse.llm import (
    license_scan,
    line_chunks,
    line_quality,
    mixing,
    near_dedup,
    prefix_trie,
    queries,
    sharding,
    substring_dedup,
    token_output,
    toxicity,
    turn_repair,
    url_filter,
    winnowing,
)
from playpulse.llm.names import free_names
from playpulse.llm.scratch import new_folder
from pyspark.sql import functions as F

from .test_tables import plain_tokens

SF_DIR = "/root/testdata/sf0.001"

#: Every name an operator gives to a column of its own beside the columns of documents, a
#: second form of some, and names that are common inside.
NAMES = """
    j_id j_node once __node __doubt __told places __l_id __l_hash __places __lines __kept __at
    __cell __bits __again __copy hit_id hit_key __suspect __text_key r_doc_id r_source
    r_text_hash h_source f_source f_line __doubt_ __copy_ node hash bucket label class_id
    text_hash text_key words lines line place n range row weight first second group middle shard
    slot terms counts p rate copies start ids part own held g s host path rule by_rule kept found
    begins ends items item id key said row_key base n_words n_hit spans size score toxic domain
""".split()


def with_extras(table):
    """The table with all NAMES it does not have yet, filled from its first column."""
    first = F.col(table.columns[0])
    extra = [F.concat_ws(":", F.lit(c), first).alias(c) for c in NAMES if c not in table.columns]
    return table.select("*", *extra)


def rows_of(table, columns=None):
    table = table.select(*(columns or sorted(table.columns)))
    return Counter(str(tuple(r)) for r in table.collect())


@pytest.fixture()
def documents(spark, docs_of):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    page = " ".join(rng.choice(words) for _ in range(90))
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").limit(3).collect()]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80))) for i in range(12)]
    rows += [(20, page), (21, page + " end"), (21, page + " end"), (22, page)]
    rows += [(30 + i, f"{rows[i][1]} {t} {rows[i + 1][1]}") for i, t in enumerate(items)]
    rows += [(40 + i, f"{rows[i][1]}\n{page}\n{rows[i + 4][1]}") for i in range(2)]
    rows += [(50, None), (51, ""), (None, page)]
    return docs_of(rows).drop("node", "hash")


def test_free_names(spark):
    rows = spark.range(1).select(F.lit(1).alias("a"), F.lit(1).alias("A_"), F.lit(1).alias("c"))
    assert free_names(rows, "a", "a", "b", "c") == ["a__", "a___", "b", "c_"]


def test_stages_keep_columns_of_any_name(spark, documents):
    extended = with_extras(documents)
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    labels = documents.where("doc_id is not null").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("domain")
    )
    stages = [
        line_quality.keep_good,
        near_dedup.dedup,
        lambda d: winnowing.decontaminate(d, with_extras(benchmark)),
        lambda d: mixing.mix(d, with_extras(labels), {"a": 0.7, "b": 0.3}),
        lambda d: line_chunks.dedup_lines(d),
    ]
    for stage in stages:
        plain, got = stage(documents), stage(extended)
        assert got.columns[: len(extended.columns)] == extended.columns
        assert rows_of(got, sorted(plain.columns)) == rows_of(plain)
        assert 0 < plain.count()
        # What was put beside a document is still beside it.
        off = [F.col(c) != F.concat_ws(":", F.lit(c), "doc_id") for c in NAMES]
        assert got.where(F.greatest(*off)).count() == 0


def test_operators_ignore_columns_of_any_name(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    labels = documents.where("doc_id < 30").select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    conversations = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    for operator, table in [
        (near_dedup.near_duplicates, documents),
        (lambda d: license_scan.summary(license_scan.licenses(d)), documents),
        (lambda d: toxicity.toxicity(d, with_extras(labels)), documents),
        (line_quality.judge, documents),
        (lambda d: sharding.shards(d, 3), documents),
        (lambda d: winnowing.contamination(d, with_extras(benchmark)), documents),
        (lambda d: substring_dedup.digests(substring_dedup.dedup_substrings(d)), documents),
        (queries.token_table, documents),
        (url_filter.verdicts, pages),
        (turn_repair.damaged_report, conversations),
        (lambda c: prefix_trie.trie(prefix_trie.rebuilt(c)), conversations),
    ]:
        plain, got = operator(table), operator(with_extras(table))
        columns = sorted(c for c in plain.columns if c != "slot")  # ties take slots in any order
        assert sorted(got.columns) == sorted(plain.columns)
        assert rows_of(got, columns) == rows_of(plain, columns)


def test_texts_longer_than_a_slice(spark, docs_of):
    """Two texts of 3 MB that differ in a few words, with lines, and a short one."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(60_000)}" for _ in range(470_000)]
    text = " ".join(w if i % 400 else f"{w}\n{i}" for i, w in enumerate(words))
    other = text[: len(text) // 2] + " a few other words " + text[len(text) // 2 :]
    assert len(text) > 3_000_000
    short = " ".join(words[1000:1030])
    rows = [(1, text), (2, other), (3, short)]
    docs = docs_of(rows)
    classes = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert classes == {1: 1, 2: 1, 3: 3}
    assert sorted(r.doc_id for r in near_dedup.dedup(docs).collect()) == [1, 3]
    folder = new_folder(spark, "long")
    public = pytest.importorskip("public_tokenizers")
    token_output.write_tokens(docs, folder, public.path("word_bpe_49k.json"), 1)
    got = {r.doc_id: list(r.ids) for r in token_output.read_tokens(spark, folder).collect()}
    assert got == dict(plain_tokens(rows))
    items = spark.createDataFrame([("i", short)], "item_id string, text string")
    hits = {r.doc_id: (r.n_words, r.n_hit) for r in winnowing.contamination(docs, items).collect()}
    assert hits[3] == (30, 30) and hits[1][1] == hits[2][1] == 30
    assert [r.doc_id for r in winnowing.decontaminate(docs, items).collect()] == []
    removed = {
        r.doc_id: (r.n_words, r.n_removed)
        for r in substring_dedup.digests(substring_dedup.dedup_substrings(docs)).collect()
    }
    assert removed[1] == (len(text.split()), 0) and removed[3] == (30, 30)
    assert 0 < removed[2][0] - removed[2][1] < 60
    lines = {r.doc_id: r for r in line_chunks.dedup_lines(docs).collect()}
    assert lines[1].text == text and lines[1].n_removed == 0
    assert lines[2].n_removed > 0.95 * lines[2].n_lines and lines[3].text == short
    figures = {r.doc_id: r for r in line_quality.judge(docs).collect()}
    assert figures[1].n_words == len(text.split()) and figures[1].kept
    assert sum(r.size for r in sharding.shards(docs, 2).collect()) == sum(len(t) + 16 for _, t in rows)
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels).count() == 3
    known = labels.select("doc_id", F.col("toxic").cast("string").alias("domain"))
    assert mixing.rates(docs, known, {"0": 0.5, "1": 0.5}).count() == 3
    assert license_scan.summary(license_scan.licenses(docs)).count() == 3
