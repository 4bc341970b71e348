"""Quality rules from lines that many documents of a host repeat. DataFrame functions only.

Normalised lines (trimmed, blanks folded, lower-cased) are hashed; per host the documents
that hold a line are counted. Lines in more than LINE_SHARE of a host's documents, and in
more than LEAST_DOCS of them, are taken out of its documents, and a document that keeps
less than KEPT_SHARE of its words, or fewer than LEAST_WORDS, is rejected as depleted.
judge() gives the verdicts, keep_good() the documents that stay, without those lines.

Documents are counted by their whole text, for a line and for its host alike: exact copies
of one page count once on both sides, so a page is not boilerplate for being mirrored, and
mirrored pages do not raise the limit for the lines of others. Texts that differ at all are
different documents.

Two passes: one over the texts for the figures of each document, one that makes a short
row of numbers for each line (host, hash, text hash, document), kept for both its uses.
Rows of a line and a text are folded first and then counted with a map-side combine, so a
line of a third of all documents is a few rows. Lines over the limit are joined back by
(host, hash); Spark broadcasts them if they are measured small enough, and shuffles by the
key if not.

Defined cases: a null text has no words and no lines, and fails the base rules. A null host
is a host. Rows of equal doc_id and text have equal verdicts. Figures and base rules are of
the text as it was given. An empty table gives none. Other columns stay as they are, also
those that describe the text, and may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.names import free_names
from playpulse.llm.scratch import cut

LINE_SHARE = 0.05
LEAST_DOCS = 50
KEPT_SHARE = 0.5
LEAST_WORDS = 30

BASE_LEAST_WORDS = 50
BASE_MOST_REPEATED = 50

#: White space of the word rule: blank, tab, line feed, vertical tab, form feed, return.
_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"
#: The same but for the line feed.
_BLANKS = r"[\x20\x09\x0B-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _split_words(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, _SPACES)
    )


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that are found at least twice."""
    n = F.size(words) - 2
    windows = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(hashes: Column) -> Column:
        # Sorted by hash, equal windows are neighbours; the positions of those are kept.
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(sorted_: Column) -> Column:
            kept = F.filter(
                sorted_,
                lambda x, j: F.coalesce(x["h"] == F.get(sorted_, j - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(sorted_, j + 1)["h"], F.lit(False)),
            )
            spots = F.transform(kept, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
            return F.size(F.array_distinct(F.flatten(spots)))

        return let(placed, twice)

    def counted(hashes: Column) -> Column:
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0)).otherwise(covered(hashes))

    return F.when(n < 2, F.lit(0)).otherwise(let(windows, counted))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def figures(documents: DataFrame) -> DataFrame:
    """documents' doc_id and source with the figures of the base rules."""
    text = _text()
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(_SPACE)) != "")
    rows = documents.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_hash"),
        text.alias("text"),
        _split_words(text).alias("words"),
        lines.alias("lines"),
        F.regexp_count(text, F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
    )
    return rows.select(
        "doc_id",
        "source",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def line_hash(line: Column) -> Column:
    """60 bits of a line's MD5, a number that SQL engines agree on."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def _line_rows(documents: DataFrame) -> DataFrame:
    """(source, doc_id, text_hash, place, line, n_words) for every line with words.

    place: the line's number among all lines of the text, from 0.
    """
    folded = F.regexp_replace(F.lower(_text()), _BLANKS, " ")
    normal = F.transform(
        F.split(folded, "\n"), lambda x, i: F.struct(F.trim(x).alias("x"), i.alias("place"))
    )
    hashed = F.transform(
        F.filter(normal, lambda line: line["x"] != ""),
        lambda line: F.struct(
            line["place"].alias("place"),
            line_hash(line["x"]).alias("line"),
            (
                F.length(line["x"]) - F.length(F.replace(line["x"], F.lit(" "), F.lit(""))) + 1
            ).alias("n_words"),
        ),
    )
    return documents.select(
        "source",
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.explode(hashed).alias("x"),
    ).select(
        "source",
        "doc_id",
        "text_hash",
        F.col("x.place").alias("place"),
        F.col("x.line").alias("line"),
        F.col("x.n_words").alias("n_words"),
    )


def _frequent(documents: DataFrame, lines: DataFrame, share: float, least: int) -> DataFrame:
    """(f_source, f_line) of the lines above the limits."""
    hosts = (
        documents.select(F.col("source").alias("h_source"), F.xxhash64("text"))
        .distinct()
        .groupBy("h_source")
        .agg(F.count("*").alias("n_docs"))
    )
    return (
        lines.select("source", "line", "text_hash")
        .distinct()
        .groupBy("source", "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > least)
        .join(hosts, F.col("source").eqNullSafe(F.col("h_source")))
        .where(F.col("n") > share * F.col("n_docs"))
        .select(F.col("source").alias("f_source"), F.col("line").alias("f_line"))
    )


def _judged(
    documents: DataFrame, line_share: float, least_docs: int, kept_share: float, least_words: int
) -> DataFrame:
    """What judge() gives, with places: the numbers of the lines to take out, or null."""
    lines = cut(_line_rows(documents))
    frequent = cut(_frequent(documents, lines, line_share, least_docs))
    key = ["doc_id", "source", "text_hash"]
    removed = (
        lines.join(
            frequent,
            (F.col("line") == F.col("f_line")) & F.col("source").eqNullSafe(F.col("f_source")),
        )
        .groupBy(*key, "place")  # repeated rows have the same lines: count them once
        .agg(F.first("n_words").alias("n"))
        .groupBy(*(F.col(c).alias(f"r_{c}") for c in key))
        .agg(F.sum("n").alias("words_removed"), F.collect_list("place").alias("places"))
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("r_doc_id"))
        & F.col("source").eqNullSafe(F.col("r_source"))
        & (F.col("text_hash") == F.col("r_text_hash"))
    )
    n, gone = F.col("n_words"), F.col("words_removed")
    failed = (n < BASE_LEAST_WORDS) | (100 * F.col("n_repeat_words") > BASE_MOST_REPEATED * n)
    depleted = (gone > 0) & ((n - gone < kept_share * n) | (n - gone < least_words))
    return (
        figures(documents)
        .join(removed, same, "left")
        .withColumn("words_removed", F.coalesce(gone, F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop(*(f"r_{c}" for c in key))
    )


def judge(
    documents: DataFrame,
    line_share: float = LINE_SHARE,
    least_docs: int = LEAST_DOCS,
    kept_share: float = KEPT_SHARE,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The figures of each row of documents with text_hash, words_removed, base_failed, kept."""
    return _judged(documents, line_share, least_docs, kept_share, least_words).drop("places")


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that pass, without the lines above the limits; other columns unchanged.

    Only what is rejected or loses lines is joined: a flag and the places of these lines.
    """
    verdicts = _judged(documents, LINE_SHARE, LEAST_DOCS, KEPT_SHARE, LEAST_WORDS)
    r_id, r_source, r_hash, kept, places, lines = free_names(
        documents, "r_doc_id", "r_source", "r_text_hash", "__kept", "__places", "__lines"
    )
    changed = cut(
        verdicts.where(~F.col("kept") | F.col("places").isNotNull())
        .groupBy(
            F.col("doc_id").alias(r_id),
            F.col("source").alias(r_source),
            F.col("text_hash").alias(r_hash),
        )
        .agg(F.first("kept").alias(kept), F.first("places").alias(places))
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col(r_id))
        & F.col("source").eqNullSafe(F.col(r_source))
        & (F.xxhash64("text") == F.col(r_hash))
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
    shorter = F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n")
    return (
        documents.join(changed, same, "left")
        .where(F.coalesce(F.col(kept), F.lit(True)))
        .withColumn(
            lines, F.when(F.col(places).isNotNull(), F.split(F.col("text").cast("string"), "\n"))
        )
        .withColumn("text", F.when(F.col(places).isNull(), F.col("text")).otherwise(shorter))
        .drop(r_id, r_source, r_hash, kept, places, lines)
    )


#: The same rules as direct SQL.
ORACLE_SQL = rf"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), repeated AS (
    SELECT doc_id, count(DISTINCT i + j) AS n
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS times FROM windows),
         (SELECT unnest([0, 1, 2]) AS j)
    WHERE times > 1 GROUP BY doc_id
), word_lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs
), dup_lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM word_lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), lines AS (
    SELECT source, doc_id, text, ('0x' || substr(md5(x), 1, 15))::BIGINT AS line,
           len(string_split(x, ' ')) AS n_words
    FROM (
        SELECT source, doc_id, text, trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g')) AS x
        FROM (
            SELECT source, doc_id, text, unnest(string_split(lower(text), chr(10))) AS x FROM docs
        )
    ) WHERE x <> ''
), hosts AS (
    SELECT source, count(DISTINCT coalesce('=' || text, '')) AS n_docs
    FROM documents GROUP BY source
), held AS (
    SELECT source, line, count(DISTINCT text) AS n FROM lines GROUP BY source, line
), frequent AS (
    SELECT held.source, line FROM held
    JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
    WHERE n > {LEAST_DOCS} AND n > {LINE_SHARE} * n_docs
), removed AS (
    SELECT doc_id, sum(n_words) AS n FROM lines JOIN frequent
    ON lines.line = frequent.line AND lines.source IS NOT DISTINCT FROM frequent.source
    GROUP BY doc_id
), figures AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT
               AS n_symbols,
           coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
           coalesce(x.n, 0)::BIGINT AS words_removed
    FROM docs LEFT JOIN dup_lines d USING (doc_id) LEFT JOIN repeated r USING (doc_id)
         LEFT JOIN removed x USING (doc_id)
)
SELECT *, n_words < {BASE_LEAST_WORDS} OR 100 * n_repeat_words > {BASE_MOST_REPEATED} * n_words
           AS base_failed,
       NOT (n_words < {BASE_LEAST_WORDS}
            OR 100 * n_repeat_words > {BASE_MOST_REPEATED} * n_words)
       AND NOT (words_removed > 0
                AND (n_words - words_removed < {KEPT_SHARE} * n_words
                     OR n_words - words_removed < {LEAST_WORDS})) AS kept
FROM figures
"""
