"""The test tables (customer, nation, events) seen as raw game tables.

``k`` is the integer in ``events.props``; ten players share one ``user_id`` and
``k % 10`` tells them apart, which makes the player keys match the customers.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from playpulse.schema import Tables
from playpulse.sources.retention_state import RetentionState, refresh
from playpulse.sources.warehouse import build_tables, read_warehouse, write_warehouse

# Item types in the order of floor(k / 10) % 4.
ITEM_TYPES = ("currency", "powerup", "cosmetic", "bundle")


# Given rather than inferred: opening a table then reads no file footers.
_CUSTOMER = "c_custkey bigint, c_nationkey int, c_mktsegment string"
_NATION = "n_nationkey int, n_name string"
_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def _choice(number: Column, *values: str) -> Column:
    """One of the values by a number's remainder."""
    at = (number % len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), at)


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    customer = spark.read.schema(_CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.schema(_NATION).parquet(f"{sf_dir}/nation.parquet")
    events = (
        spark.read.schema(_EVENTS)
        .parquet(f"{sf_dir}/events.parquet")
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    )

    key, k = F.col("c_custkey"), F.col("k")
    # Dates, times and counters are text, as CSV files have them: the build casts them.
    players = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("player_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (key % 365).cast("int"))
        .cast("string")
        .alias("registration_date"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("platform"),
        _choice(key, "organic", "ad", "referral").alias("install_source"),
        _choice(key, "phone", "tablet").alias("device_type"),
        (key % 50 + 1).cast("string").alias("player_level"),
    )
    player_id = (F.col("user_id") * 10 + k % 10).alias("player_id")
    end = F.expr("timestampadd(MICROSECOND, cast(round(value * 60000000) as bigint), ts)")
    sessions = events.select(
        F.col("event_id").alias("session_id"),
        player_id,
        F.col("ts").cast("string").alias("session_start"),
        end.cast("string").alias("session_end"),
        F.col("value").alias("duration_minutes"),
        (k % 10).cast("string").alias("levels_completed"),
        (k % 7).cast("string").alias("deaths"),
        (k % 20).cast("string").alias("items_collected"),
        (k * 10).cast("string").alias("score"),
    )
    item = _choice(F.floor(k / 10), *ITEM_TYPES)
    purchases = events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"),
        player_id,
        F.col("event_id").alias("session_id"),
        F.col("ts").cast("string").alias("purchase_time"),
        item.alias("item_type"),
        F.concat_ws(" ", item, k % 10).alias("item_name"),
        F.col("value").alias("price_usd"),
        _choice(k, "USD", "EUR").alias("currency"),
        _choice(k, "iOS", "Android", "Web").alias("platform"),
    )
    return Tables(players=players, sessions=sessions, purchases=purchases)


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The test data taken through the same warehouse build as raw CSV files."""
    return build_tables(raw_tables(spark, sf_dir))


def _shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; on one machine, where that is unset, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="playpulse-")
    return f"{shared.rstrip('/')}/warehouse-{uuid.uuid4().hex}"


def stored_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The test data as a stored warehouse, written anew."""
    path = _shared_folder(spark)
    write_warehouse(load_tables(spark, sf_dir), path)
    return read_warehouse(spark, path)


def maintained_state(spark: SparkSession, sf_dir: str) -> RetentionState:
    """Retention state of the test data after two loads: all but every third day, then all.

    So the second refresh reads the missing days only, most of which come late.
    """
    path, tables = _shared_folder(spark), load_tables(spark, sf_dir)
    some = tables.sessions.where(F.dayofyear("session_date") % 3 != 0)
    for sessions in (some, tables.sessions):
        write_warehouse(Tables(tables.players, sessions, tables.purchases), f"{path}/tables")
        state = refresh(read_warehouse(spark, f"{path}/tables"), f"{path}/state")
    return state
