"""Which days a player was active, as bits: one BIGINT for each player and 64-day block.

A set of (player, day) pairs needs one row per pair in every shuffle. Packed 64 days to a
row it is one short row per player and block in which the player was active: Spark folds it
map-side with ``bit_or``, inside generated code. Blocks count from 1970-01-01, so any range
of dates takes the same path, and costs what its active blocks cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_DAYS = 64


def block_of(day: Column) -> Column:
    """Number of the block a date lies in; negative before 1970."""
    return F.floor(F.unix_date(day) / BLOCK_DAYS).cast("int")


def bit_of(day: Column) -> Column:
    """Place of a date in its block, 0 to 63."""
    return F.pmod(F.unix_date(day), F.lit(BLOCK_DAYS))


def active_bits(day: Column) -> Column:
    """Aggregate of a block: a bit for every day that occurs."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit_of(day)))


def unpack(df: DataFrame, block: str, bits: str, day: str) -> DataFrame:
    """One row per set bit, with its date in ``day``; nothing is shuffled."""
    places = F.sequence(F.lit(0), F.lit(BLOCK_DAYS - 1))
    set_places = F.filter(places, lambda i: F.getbit(bits, i) == 1)
    return df.select(block, F.explode(set_places).alias("place")).select(
        F.date_from_unix_date(F.col(block) * BLOCK_DAYS + F.col("place")).alias(day)
    )
