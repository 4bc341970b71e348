"""Headline numbers. Every function returns a lazy one-row frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.functions.numbers import ratio, sum_of_parts, zero_if_null
from playpulse.plans.rollups import (
    KEY,
    activity_rollup,
    joined_to,
    per_player,
    purchase_rollup,
    purchases_in_range,
    seen_by,
    sessions_in_range,
)
from playpulse.schema import Tables

# On per-player rows counting rows counts distinct players.
def _active() -> Column:
    return F.count_if(F.col("sessions") > 0)


def _paying() -> Column:
    return F.count_if(F.col("purchases") > 0)


def _conversion() -> Column:
    return ratio(_paying(), _active()) * F.lit(100.0)


def _revenue() -> Column:
    return zero_if_null(sum_of_parts("revenue"))


def _count(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def _purchases(tables: Tables, flt: PlayerFilter) -> DataFrame:
    return joined_to(purchase_rollup(tables, flt), tables, flt)


def _everyone(tables: Tables, flt: PlayerFilter) -> DataFrame:
    return per_player(activity_rollup(tables, flt), tables, flt)


def active_players(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Distinct players with a session anywhere in the range (not a per-day figure)."""
    players = sessions_in_range(tables, flt).select(KEY).distinct()
    return seen_by(players, tables, flt).agg(F.count("*").alias("active_players"))


def total_sessions(tables: Tables, flt: PlayerFilter) -> DataFrame:
    rollup = sessions_in_range(tables, flt).groupBy(KEY).agg(F.count("*").alias("sessions"))
    return joined_to(rollup, tables, flt).agg(_count("sessions").alias("total_sessions"))


def total_revenue(tables: Tables, flt: PlayerFilter) -> DataFrame:
    return _purchases(tables, flt).agg(_revenue().alias("total_revenue"))


def paying_users(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Distinct players with a purchase in the range."""
    players = purchases_in_range(tables, flt).select(KEY).distinct()
    return seen_by(players, tables, flt).agg(F.count("*").alias("paying_users"))


def arppu(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Average revenue per paying user, 0 without payers."""
    buyers = per_player(purchase_rollup(tables, flt), tables, flt)
    return buyers.agg(ratio(_revenue(), F.count("*")).alias("arppu"))


def total_purchases(tables: Tables, flt: PlayerFilter) -> DataFrame:
    return _purchases(tables, flt).agg(_count("purchases").alias("total_purchases"))


def avg_transaction(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Mean price of the purchases that have one, 0 without any."""
    mean = ratio(_revenue(), _count("priced"))
    return _purchases(tables, flt).agg(mean.alias("avg_transaction"))


def conversion_rate(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Paying users per 100 players active in the range, 0 without active players.

    Buyers need not be among the active, so the rate may pass 100.
    """
    return _everyone(tables, flt).agg(_conversion().alias("conversion_rate"))


def executive_kpis(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Active players, sessions, revenue and ARPPU from one scan of each fact."""
    return _everyone(tables, flt).agg(
        _active().alias("active_players"),
        _count("sessions").alias("total_sessions"),
        _revenue().alias("total_revenue"),
        ratio(_revenue(), _paying()).alias("arppu"),
    )


def monetization_kpis(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Purchases, conversion, mean transaction and revenue from one scan of each fact."""
    return _everyone(tables, flt).agg(
        _count("purchases").alias("total_purchases"),
        _conversion().alias("conversion_rate"),
        ratio(_revenue(), _count("priced")).alias("avg_transaction"),
        _revenue().alias("total_revenue"),
    )
