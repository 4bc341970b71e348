"""Cohorts by first session day and how many of them came back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter, date_literal
from playpulse.functions.day_bits import BLOCK_DAYS, active_bits, block_of
from playpulse.functions.numbers import percent
from playpulse.plans.rollups import KEY
from playpulse.schema import Tables
from playpulse.sources.retention_state import RetentionState, blocks_of

# The days after the first session at which a return counts.
RETENTION_DAYS = (1, 3, 7)


def player_first_day(tables: Tables | RetentionState) -> DataFrame:
    """First session day per player, over all sessions and whether or not the player is known."""
    if isinstance(tables, RetentionState):
        return tables.firsts().withColumnRenamed("first", "first_session_date")
    return tables.sessions.groupBy(KEY).agg(F.min("session_date").alias("first_session_date"))


def _returned(day: int) -> str:
    return f"returned_{day}"


def _flags(sessions: DataFrame, flt: PlayerFilter, days: Sequence[int]) -> DataFrame:
    """Per player: first day and return flags, from one pass over the sessions.

    Days are folded to bits of 64-day blocks, then a player's blocks meet in one row; there
    are no more of them than the range has. Days before the range only decide the first
    day, and make one row without a block.
    """
    day = F.col("session_date")
    block = F.when(day >= date_literal(flt.date_from), block_of(day)).alias("block")
    folded = sessions.groupBy(KEY, block).agg(
        F.min(day).alias("first"), active_bits(day).alias("bits")
    )
    first = F.col("first_session_date")
    per_player = (
        folded.groupBy(KEY)
        .agg(
            F.min("first").alias("first_session_date"),
            F.collect_list(F.struct("block", "bits")).alias("blocks"),
        )
        .filter(flt.in_range("first_session_date"))
    )

    def came_back(n: int) -> Column:
        # The day as a number, which may lie past the last date there is.
        at = F.unix_date(first) + n
        own, bit = F.floor(at / BLOCK_DAYS).cast("int"), F.pmod(at, F.lit(BLOCK_DAYS))
        return F.exists(
            "blocks", lambda b: F.coalesce(b["block"] == own, F.lit(False)) & (F.getbit(b["bits"], bit) == 1)
        )

    return per_player.select(
        KEY, "first_session_date", *[came_back(n).alias(_returned(n)) for n in days]
    )


def _counts_from_state(
    state: RetentionState, flt: PlayerFilter, days: Sequence[int]
) -> DataFrame:
    """The same from maintained state: a player has one row in each block, so each row tells
    for itself which returns lie in it, and nothing is moved by player."""
    first, block, bits = F.col("first"), F.col("block"), F.col("bits")
    rows = state.bits(*blocks_of(flt, days)).where(flt.in_range("first"))

    def there(n: int) -> Column:
        at = F.unix_date(first) + n
        bit = F.getbit(bits, F.pmod(at, F.lit(BLOCK_DAYS)))
        return (F.floor(at / BLOCK_DAYS) == block) & (bit == 1)

    known = F.col(KEY).isNotNull()
    return (
        rows.groupBy(first.alias("first_session_date"))
        .agg(
            F.count_if(known & there(0)).alias("cohort_size"),
            *[F.count_if(known & there(d)).alias(f"d{d}_retained") for d in days],
        )
        .orderBy(F.asc_nulls_last("first_session_date"))
    )


def retention_counts(
    tables: Tables | RetentionState, flt: PlayerFilter, days: Sequence[int] = RETENTION_DAYS
) -> DataFrame:
    """Cohort size and players back on exactly day N after their first one.

    Only the date range applies, and only to the first day: returns may lie
    past its end, platforms are not looked at, and a day that has not come yet
    counts 0. Sessions after the last possible return cannot change any cohort
    in range and are not read; earlier ones decide the first day and are, unless
    ``tables`` is maintained state: then only its blocks of the range are read.
    """
    if not days or any(day < 0 for day in days):
        raise ValueError("days must be one or more numbers from 0 up")
    if isinstance(tables, RetentionState):
        return _counts_from_state(tables, flt, days)
    last = date.fromordinal(min(flt.date_to.toordinal() + max(days), date.max.toordinal()))
    sessions = tables.sessions.filter(F.col("session_date") <= date_literal(last))
    flags = _flags(sessions, flt, days)
    # Sessions without a player make a cohort row, but no member of it.
    known = F.col(KEY).isNotNull()
    return (
        flags.groupBy("first_session_date")
        .agg(
            F.count(KEY).alias("cohort_size"),
            *[F.count_if(known & F.col(_returned(d))).alias(f"d{d}_retained") for d in days],
        )
        .orderBy(F.asc_nulls_last("first_session_date"))
    )


def retention(
    tables: Tables | RetentionState, flt: PlayerFilter, days: Sequence[int] = RETENTION_DAYS
) -> DataFrame:
    """The same as percentages of the cohort, two decimals; NULL for a cohort without members."""

    def rate(day: int) -> Column:
        share = percent(F.col(f"d{day}_retained"), F.col("cohort_size"))
        return F.round(share, 2).alias(f"d{day}_retention_pct")

    return retention_counts(tables, flt, days).select(
        "first_session_date", "cohort_size", *[rate(day) for day in days]
    )
