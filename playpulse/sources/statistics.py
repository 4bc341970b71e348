"""Additive statistics of stored tables, one row for each table and date, and their freshness.

They are taken from the files when a table is written. A row also has a fingerprint of the
date's files (number, bytes, a hash of names and sizes); comparing it with a listing tells
whether files came, went or changed in size since, without opening any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playpulse.functions.numbers import sum_parts
from playpulse.schema import DATE_COLUMNS, TABLE_NAMES, Tables

#: The column of each table whose sum is kept.
VALUES = {"sessions": "duration_minutes", "purchases": "price_usd"}
FINGERPRINT = ("n_files", "n_bytes", "names")


def _content(df: DataFrame) -> Column:
    """A number that any change of the rows changes, whatever their order."""
    row = F.xxhash64(*[F.col(c) for c in df.columns if c != "loaded_at"])
    return F.sum(row.cast("decimal(20,0)")).cast("string").alias("content")


def _counts(name: str, df: DataFrame) -> DataFrame:
    day = F.col(DATE_COLUMNS[name]) if name in DATE_COLUMNS else F.lit(None).cast("date")
    value = F.col(VALUES[name]) if name in VALUES else F.lit(None).cast("double")
    rows = df.withColumns({"__day": day, "__value": value.cast("double")})
    return (
        rows.groupBy(F.col("__day").alias("day"))
        .agg(
            F.count("*").alias("n_rows"),
            F.count("__value").alias("n_values"),
            *sum_parts(rows, "__value", "value"),
            _content(df),
        )
        .select(F.lit(name).alias("table_name"), "*")
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of the files in a warehouse folder by table and date; none is opened."""
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
        .load(folder)
        .select("path", "length")
    )
    table = F.when(F.lit(False), "")
    for name, stored_as in TABLE_NAMES.items():
        table = table.when(F.col("path").contains(f"/{stored_as}/"), name)
    day = F.regexp_extract("path", "/(?:session|purchase)_date=([^/]+)/[^/]*$", 1)
    file = F.xxhash64(F.substring_index("path", "/", -1), F.col("length"))
    return (
        files.withColumns({"table_name": table, "day": day.try_cast("date")})
        .where(F.col("table_name").isNotNull())
        .groupBy("table_name", "day")
        .agg(
            F.count("*").alias("n_files"),
            F.sum("length").alias("n_bytes"),
            F.bit_xor(file).alias("names"),
        )
    )


def gather(spark: SparkSession, tables: Tables, folder: str) -> DataFrame:
    """Statistics of tables that were just written to ``folder``."""
    counts = None
    for name, df in tables.named().items():
        one = _counts(name, df)
        counts = one if counts is None else counts.unionByName(one)
    files = listing(spark, folder).withColumnsRenamed({"table_name": "in_table", "day": "of_day"})
    same = (F.col("table_name") == F.col("in_table")) & F.col("day").eqNullSafe(F.col("of_day"))
    return counts.join(files, same, "left").drop("in_table", "of_day")


def stale(spark: SparkSession, kept: DataFrame, folder: str) -> DataFrame:
    """(table_name, day) of which the files are not those that were counted."""
    now = listing(spark, folder).withColumnsRenamed({c: f"{c}_now" for c in FINGERPRINT})
    then = kept.where(F.col("n_files").isNotNull()).select("table_name", "day", *FINGERPRINT)
    then = then.withColumnsRenamed({"table_name": "in_table", "day": "of_day"})
    same = (F.col("table_name") == F.col("in_table")) & F.col("day").eqNullSafe(F.col("of_day"))
    differs = F.lit(False)
    for c in FINGERPRINT:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"{c}_now"))
    # A player table without rows has a file but no row of statistics.
    none = F.col("in_table").isNull() & (F.col("table_name") == "players")
    return (
        now.join(then, same, "full")
        .where(differs & ~F.coalesce(none, F.lit(False)))
        .select(
            F.coalesce("table_name", "in_table").alias("table_name"),
            F.coalesce("day", "of_day").alias("day"),
        )
    )
