import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that clash with those of joins and of the operators' own columns.
        T.StructField("node", T.StringType()),
        T.StructField("hash", T.LongType()),
    ]
)


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    from playpulse.llm.scratch import ship

    ship(spark)

    def make(rows):
        full = []
        for doc_id, text, *rest in rows:
            source = rest[0] if rest else "web"
            full.append((doc_id, text, "en", source, len(text or ""), "x", 1))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture()
def awkward(docs_of):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 7919}" for i in range(150_000))
    return docs_of(
        [
            (1, None),
            (2, ""),
            (3, " \n\t "),
            (4, "one"),
            (5, long),
            (5, long),
            (6, "The same text, twice over, with more words than five.", None),
            (7, "The same text, twice over, with more words than five."),
            (None, "no id here but words enough for a shingle"),
            (8, "!!! ???"),
            (9, "é" * 3000),
        ]
    )


@pytest.fixture()
def no_rows(docs_of):
    return docs_of([])
