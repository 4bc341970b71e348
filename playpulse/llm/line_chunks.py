"""Removal of repeated passages by content-defined chunks of lines. DataFrame functions only.

A text's lines are hashed, and a hash that rolls over two line hashes chooses where chunks
end: after a line where it is 0 modulo ONE_IN, so the same run of lines is cut at the same
places wherever it stands. A line of LONG_WORDS words or more is a chunk of its own.
Chunks of several lines and LEAST_WORDS words, and those long lines, that occur more than
once in the corpus are removed, but for the first place (by doc_id, text, place) of each.

1. Lines are hashed and their words counted once; the rest works on these numbers. Chunks
   (document, place, hash of their line hashes) are counted by hash, with a map-side combine.
2. The texts of those documents only that hold a chunk whose hash occurs again leave the
   scan: a filter of fixed size first, then a join by document.
3. Their repeated chunks are grouped by hash and text; so bytes are compared, and equal hashes
   of different texts do no harm. A text in a third of all documents is a few rows after the
   combine.
4. Passages that chunks miss, in whole or at their ends: of the lines that occur again,
   those that follow one another in a document are runs (lines without words are passed
   over). From each line of a run ahead, and from each line back, the shortest span of
   LONG_WORDS words is hashed. The texts of documents that hold a span whose hash occurs
   again leave the scan, as in 2; spans are grouped by hash and text (the lines with words),
   so bytes are compared here too, and all but the first place of each are removed. Every line of a repeated run of LONG_WORDS words or more is in such a span, so whole
   passages go, however long their lines are and wherever chunks end. Spans of one document
   that overlap the first place of their own text stay.
5. Places other than the first are collected by document, and only documents that lose
   something meet them; the others pass without a shuffle.

A line is only removed for an equal one earlier in the order of (doc_id, text, line), so one
copy of each always stays.

Defined cases: a null text stays null and has no lines. Lines without words are never
removed but inside a repeated chunk or span. Rows of equal doc_id and text are one document
and change alike. An empty table gives none. Other columns stay and may have any names, but
n_lines and n_removed are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playpulse.llm import bitfilter
from playpulse.llm.line_quality import let, line_hash
from playpulse.llm.names import free_names
from playpulse.llm.scratch import cut

ONE_IN = 3
LONG_WORDS = 50
LEAST_WORDS = 10

#: White space of the word rule: blank, tab, line feed, vertical tab, form feed, return.
_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"
#: The rolling hash: (first mod _PRIME) * _FACTOR + (second mod _PRIME), modulo ONE_IN.
_PRIME = 1_000_003
_FACTOR = 31


def _word_count(line: Column) -> Column:
    bare = F.trim(F.regexp_replace(line, _SPACES, " "))
    gaps = F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit("")))
    return F.when(bare == "", F.lit(0)).otherwise(gaps + 1)


def _numbered(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, h, n): hashes and word counts of the lines of texts that are not null."""

    def facts(lines: Column) -> Column:
        return F.struct(
            F.transform(lines, line_hash).alias("h"), F.transform(lines, _word_count).alias("n")
        )

    return (
        documents.where(F.col("text").isNotNull())
        .select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            let(F.split(F.col("text").cast("string"), "\n"), facts).alias("x"),
        )
        .select("doc_id", "text_hash", "x.h", "x.n")
    )


def _chunks(h: Column, n: Column) -> Column:
    """The chunks (start, end, n_words, hash) of a text, in order."""

    def ends_here(i: Column) -> Column:
        rolled = (F.get(h, i - 1) % _PRIME * _FACTOR + F.get(h, i) % _PRIME) % ONE_IN == 0
        return (
            F.get(n, i + 1).isNull()
            | (F.get(n, i) >= LONG_WORDS)
            | (F.get(n, i + 1) >= LONG_WORDS)
            | F.coalesce(rolled, F.lit(False))
        )

    def chunk(ends: Column, end: Column, k: Column) -> Column:
        start = F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
        own = [F.slice(x, start + 1, end - start + 1) for x in (h, n)]
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            F.aggregate(own[1], F.lit(0), lambda sum_, x: sum_ + x).alias("n_words"),
            F.xxhash64(own[0]).alias("hash"),
        )

    ends = F.filter(F.sequence(F.lit(0), F.size(h) - 1), ends_here)
    return let(ends, lambda ends: F.transform(ends, lambda e, k: chunk(ends, e, k)))


def _removable(chunk: Column) -> Column:
    n, several = chunk["n_words"], chunk["end"] > chunk["start"]
    return (several & (n >= LEAST_WORDS)) | (n >= LONG_WORDS)


def _has_words(line: Column) -> Column:
    return F.trim(line, F.lit(_SPACE)) != ""


def _with_text(documents: DataFrame, wanted: DataFrame, of_words: bool = False) -> DataFrame:
    """(doc_id, text_hash, place, start, end, hash, chunk) of the wanted chunks.

    wanted: (doc_id, text_hash, chunks). Only the texts of these documents leave the scan.
    of_words: lines without words are no part of the chunk's text.
    """
    wanted = wanted.select(
        F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash"), "chunks"
    )
    table = cut(bitfilter.cells(wanted.select(F.xxhash64("w_id", "w_hash").alias("hash"))))
    texts = documents.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text")
    )
    told = bitfilter.passes(texts, table, F.xxhash64("doc_id", "text_hash"), "again")
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))

    def of_lines(lines: Column) -> Column:
        def filled(x: Column) -> Column:
            own = F.slice(lines, x["start"] + 1, x["end"] - x["start"] + 1)
            own = F.filter(own, _has_words) if of_words else own
            return x.withField("chunk", F.array_join(own, "\n"))

        return F.transform("chunks", filled)

    found = told.where("again").join(wanted, same)
    return found.select(
        "doc_id", "text_hash", F.inline(let(F.split("text", "\n"), of_lines))
    )


def _repeated_chunks(documents: DataFrame, numbered: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end) of the repeated chunks, without their first places."""
    chunks = F.posexplode(_chunks(F.col("h"), F.col("n"))).alias("place", "x")
    rows = cut(
        numbered.select("doc_id", "text_hash", chunks)
        .where(_removable(F.col("x")))
        .select("doc_id", "text_hash", "place", "x.start", "x.end", "x.hash")
    )
    repeated = cut(
        rows.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash")
    )
    told = bitfilter.passes(rows, cut(bitfilter.cells(repeated)), F.col("hash"), "again")
    wanted = cut(
        told.where("again")
        .join(repeated, "hash", "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("place", "start", "end", "hash")).alias("chunks"))
    )
    again = _with_text(documents, wanted)
    place = F.struct("doc_id", "text_hash", "place")
    first = again.groupBy("hash", "chunk").agg(F.min(place).alias("first"))
    others = again.join(first, ["hash", "chunk"]).where(~place.eqNullSafe(F.col("first")))
    return others.select("doc_id", "text_hash", "start", "end")


def _lines(numbered: DataFrame) -> DataFrame:
    """(doc_id, text_hash, k, at, line, n): the k-th line with words, at its place in the text."""
    placed = F.transform(
        "h", lambda h, i: F.struct(h.alias("line"), F.get("n", i).alias("n"), i.alias("at"))
    )
    return numbered.select(
        "doc_id", "text_hash", F.posexplode(F.filter(placed, lambda x: x["n"] > 0)).alias("k", "x")
    ).select("doc_id", "text_hash", "k", "x.at", "x.line", "x.n")


def _spans(lines: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end, hash): shortest spans of LONG_WORDS words in runs."""
    document = ["doc_id", "text_hash"]
    runs = lines.repartition(*document).dropDuplicates([*document, "k"])
    by_document = Window.partitionBy(*document).orderBy("k")
    runs = runs.withColumn("run", F.col("k") - F.row_number().over(by_document))
    in_run = Window.partitionBy(*document, "run")
    runs = runs.withColumn("upto", F.sum("n").over(in_run.orderBy("k")))
    runs = runs.withColumn("before", F.col("upto") - F.col("n"))

    def span(frame) -> Column:
        return F.struct(
            F.min("at").over(frame).alias("start"),
            F.max("at").over(frame).alias("end"),
            F.count("*").over(frame).alias("n_lines"),
            F.sum("n").over(frame).alias("n_words"),
            F.xxhash64(F.collect_list("line").over(frame)).alias("hash"),
        )

    ahead = span(in_run.orderBy("before").rangeBetween(0, LONG_WORDS - 1))
    back = span(in_run.orderBy("upto").rangeBetween(1 - LONG_WORDS, 0))
    return (
        runs.select(*document, ahead.alias("ahead"), back.alias("back"))
        .select(*document, F.explode(F.array("ahead", "back")).alias("x"))
        .where((F.col("x.n_words") >= LONG_WORDS) & (F.col("x.n_lines") > 1))
        .select(*document, "x.start", "x.end", "x.hash")
        .distinct()
    )


def _repeated_spans(documents: DataFrame, numbered: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end) of the repeated spans, without their first places."""
    lines = _lines(numbered)
    common = cut(
        lines.groupBy("line").agg(F.count("*").alias("times")).where("times > 1").select("line")
    )
    table = cut(bitfilter.cells(common.select(F.col("line").alias("hash"))))
    told = bitfilter.passes(lines, table, F.col("line"), "__again").where("__again")
    spans = cut(_spans(told.drop("__again").join(common, "line", "left_semi")))
    repeated = (
        spans.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash")
    )
    wanted = cut(
        spans.join(repeated, "hash", "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "end", "hash")).alias("chunks"))
    )
    again = _with_text(documents, wanted, of_words=True)
    first = again.groupBy("hash", "chunk").agg(
        F.min(F.struct("doc_id", "text_hash", "start", "end")).alias("first")
    )
    overlaps = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("text_hash") == F.col("first.text_hash"))
        & (F.col("start") <= F.col("first.end"))
    )
    others = again.join(first, ["hash", "chunk"]).where(~overlaps)
    return others.select("doc_id", "text_hash", "start", "end")


def repeated_places(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, places): spans of lines to remove from each document that has some."""
    numbered = cut(_numbered(documents))
    found = _repeated_chunks(documents, numbered).unionByName(
        _repeated_spans(documents, numbered)
    )
    return found.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "end")).alias("places")
    )


def dedup_lines(documents: DataFrame) -> DataFrame:
    """All rows of documents, text without repeated passages, with n_lines and n_removed (lines)."""
    key = F.xxhash64(F.col("doc_id"), F.xxhash64("text"))
    l_id, l_hash, places, doubt, lines, kept = free_names(
        documents, "__l_id", "__l_hash", "__places", "__doubt", "__lines", "__kept"
    )
    lost = cut(
        repeated_places(documents).select(
            F.col("doc_id").alias(l_id),
            F.col("text_hash").alias(l_hash),
            F.col("places").alias(places),
        )
    )
    table = cut(bitfilter.cells(lost.select(F.xxhash64(l_id, l_hash).alias("hash"))))
    marked = bitfilter.passes(documents, table, key, doubt)
    same = F.col("doc_id").eqNullSafe(F.col(l_id)) & (F.xxhash64("text") == F.col(l_hash))
    doubted = marked.where(F.col(doubt)).join(lost, same, "left")
    touched = doubted.where(F.col(places).isNotNull())
    untouched = marked.where(~F.col(doubt)).unionByName(
        doubted.where(F.col(places).isNull()).drop(l_id, l_hash, places)
    ).drop(doubt)
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    untouched = untouched.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(n_lines))
    untouched = untouched.withColumn("n_removed", F.lit(0).cast("long"))
    gone = F.flatten(F.transform(places, lambda x: F.sequence(x["start"], x["end"])))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    changed = (
        touched.withColumn(lines, F.split(F.col("text").cast("string"), "\n"))
        .withColumn(kept, stay)
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_removed", F.col("n_lines") - F.size(kept))
        .withColumn(
            "text", F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
        )
        .drop(doubt, l_id, l_hash, places, lines, kept)
    )
    return untouched.unionByName(changed)


#: The query as direct SQL.
ORACLE_SQL = rf"""
WITH lines AS (
    SELECT doc_id, i, line, ('0x' || substr(md5(line), 1, 15))::BIGINT AS h,
           CASE WHEN bare = '' THEN 0 ELSE len(string_split(bare, ' ')) END AS n
    FROM (
        SELECT doc_id, i, line, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS bare
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i
              FROM documents)
    )
), cuts AS (
    SELECT *, coalesce(lag(n) OVER d >= {LONG_WORDS} OR n >= {LONG_WORDS}
               OR (lag(h, 2) OVER d % {_PRIME} * {_FACTOR} + lag(h) OVER d % {_PRIME})
                  % {ONE_IN} = 0, false) AS begins
    FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
    SELECT *, sum(begins::INT) OVER (PARTITION BY doc_id ORDER BY i) AS place FROM cuts
), chunks AS (
    SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n_lines,
           (count(*) > 1 AND sum(n) >= {LEAST_WORDS}) OR sum(n) >= {LONG_WORDS} AS removable
    FROM numbered GROUP BY doc_id, place
), judged AS (
    SELECT *, removable AND row_number() OVER (
        PARTITION BY removable, chunk ORDER BY doc_id, place) > 1 AS gone
    FROM chunks
), word_lines AS (
    SELECT doc_id, i, h, n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
           count(*) OVER (PARTITION BY h) AS times
    FROM lines WHERE n > 0
), in_runs AS (
    SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run
    FROM word_lines WHERE times > 1
), counted AS (
    SELECT *, (sum(n) OVER (PARTITION BY doc_id, run ORDER BY k))::BIGINT AS upto FROM in_runs
), measured AS (
    SELECT *, upto - n AS before FROM counted
), spans AS (
    SELECT DISTINCT doc_id, s, e, hs
    FROM (
        SELECT doc_id, min(i) OVER a AS s, max(i) OVER a AS e, sum(n) OVER a AS n_words,
               list(h) OVER a AS hs
        FROM measured WINDOW a AS (PARTITION BY doc_id, run ORDER BY before
                                   RANGE BETWEEN CURRENT ROW AND {LONG_WORDS - 1} FOLLOWING)
        UNION ALL
        SELECT doc_id, min(i) OVER b, max(i) OVER b, sum(n) OVER b, list(h) OVER b
        FROM measured WINDOW b AS (PARTITION BY doc_id, run ORDER BY upto
                                   RANGE BETWEEN {LONG_WORDS - 1} PRECEDING AND CURRENT ROW)
    ) WHERE n_words >= {LONG_WORDS} AND e > s
), firsts AS (
    SELECT hs, min(struct_pack(doc_id := doc_id, s := s, e := e)) AS f
    FROM spans GROUP BY hs HAVING count(*) > 1
), gone_lines AS (
    SELECT doc_id, i FROM numbered JOIN judged USING (doc_id, place) WHERE gone
    UNION
    SELECT l.doc_id, l.i FROM lines l
    JOIN (SELECT doc_id, s, e FROM spans JOIN firsts USING (hs)
          WHERE NOT (doc_id = f.doc_id AND s <= f.e)) x
    ON l.doc_id = x.doc_id AND l.i BETWEEN x.s AND x.e
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_md5
FROM (SELECT *, (doc_id, i) IN (SELECT (doc_id, i) FROM gone_lines) AS gone FROM lines)
GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
