"""The registered queries of the subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.llm import (
    conversation_sql,
    license_scan,
    line_chunks,
    line_quality,
    mixing,
    near_dedup,
    prefix_trie,
    sharding,
    substring_dedup,
    token_output,
    toxicity,
    turn_repair,
    url_filter,
    winnowing,
)
from playpulse.llm.scratch import new_folder, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_template_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.licenses(_table(spark, sf_dir, "documents")))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5")
    )


def op4_nearest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    found = toxicity.toxicity(_table(spark, sf_dir, "documents"), labels)
    return found.select(
        "doc_id",
        F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.get("nearest", F.lit(0)).alias("nearest_id"),
        F.get("similarity", F.lit(0)).alias("nearest_similarity"),
    )


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "words_removed",
        "base_failed",
        "kept",
    )


def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(_table(spark, sf_dir, "documents"), n_shards=40)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(_table(spark, sf_dir, "pages")).drop("score")


TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def token_table(documents: DataFrame) -> DataFrame:
    """Writes the documents' token files, reads them back and sums up what was read."""
    import public_tokenizers

    spark = documents.sparkSession
    folder = new_folder(spark, "tokens")
    token_output.write_tokens(documents, folder, public_tokenizers.path(TOKENIZER), END_ID)

    read = token_output.read_tokens(spark, folder, packed=True)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(_table(spark, sf_dir, "documents"))


#: Share of tokens by domain; documents of the first keep their number of tokens.
TARGETS = {"clean": 0.94, "poor": 0.04, "toxic": 0.02}


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    domain = F.when(toxic, "toxic").when(good, "clean").otherwise("poor")
    return labels.select("doc_id", domain.alias("domain"))


def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.rates(
        _table(spark, sf_dir, "documents"),
        domain_labels(_table(spark, sf_dir, "labels")),
        TARGETS,
        keep="clean",
    )
    chances = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(TARGETS)]
    return found.select("doc_id", "n_tokens", *chances, "rate", "copies")


def op11_rank_convergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.damaged_report(_table(spark, sf_dir, "conversations"))


def op12_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return substring_dedup.digests(substring_dedup.dedup_substrings(documents))


def op13_ternary_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module for its last stages

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_probminhash": op1_probminhash,
    "op2_template_markup": op2_template_markup,
    "op3_line_chunks": op3_line_chunks,
    "op4_nearest_examples": op4_nearest_examples,
    "op5_line_frequency": op5_line_frequency,
    "op6_sampled_splitters": op6_sampled_splitters,
    "op7_winnowing": op7_winnowing,
    "op8_url_models": op8_url_models,
    "op9_huffman_tokens": op9_huffman_tokens,
    "op10_soft_mixing": op10_soft_mixing,
    "op11_rank_convergence": op11_rank_convergence,
    "op12_super_kmers": op12_super_kmers,
    "op13_ternary_trie": op13_ternary_trie,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op2_template_markup": license_scan.oracle_sql(),
    "op3_line_chunks": line_chunks.ORACLE_SQL,
    "op5_line_frequency": line_quality.ORACLE_SQL,
    "op11_rank_convergence": conversation_sql.REPAIR,
    "op12_super_kmers": substring_dedup.ORACLE_SQL,
    "op13_ternary_trie": conversation_sql.TRIE,
}
