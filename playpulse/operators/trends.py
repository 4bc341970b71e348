"""Daily trends, the session-length distribution and top countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.functions.day_bits import active_bits, block_of, unpack
from playpulse.functions.numbers import exact_sum
from playpulse.plans.rollups import (
    KEY,
    joined_to,
    purchases_in_range,
    seen_by,
    sessions_in_range,
)
from playpulse.schema import Tables

# Upper bounds of the session-length buckets, in minutes.
DURATION_EDGES = (5, 15, 30, 60)


def dau_trend(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Distinct active players per day. Days without sessions have no row."""
    sessions = sessions_in_range(tables, flt)
    day = F.col("session_date")
    rollup = sessions.groupBy(KEY, block_of(day).alias("block")).agg(active_bits(day).alias("bits"))
    days = unpack(seen_by(rollup, tables, flt), "block", "bits", "session_date")
    return (
        days.groupBy("session_date")
        .agg(F.count("*").alias("dau"))
        .orderBy(F.asc_nulls_last("session_date"))
    )


def revenue_trend(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Revenue per day. Days without purchases have no row.

    Each purchase is shuffled once, by player, and folded by day map-side after the join:
    with about one purchase per player and day, folding before would move the same rows
    twice. Both join inputs come straight from their shuffle, so AQE can split a hot player.
    """
    bought = purchases_in_range(tables, flt).select(KEY, "purchase_date", "price_usd")
    return (
        joined_to(bought, tables, flt)
        .groupBy("purchase_date")
        .agg(exact_sum(bought, "price_usd").alias("revenue"))
        .orderBy(F.asc_nulls_last("purchase_date"))
    )


def bucket_labels(edges: Sequence[int]) -> list[str]:
    lows = [0, *edges]
    return [f"{lo}-{hi} min" for lo, hi in zip(lows, edges)] + [f"{edges[-1]}+ min"]


def _bucket_index(minutes: Column, edges: Sequence[int]) -> Column:
    """Number of the first bucket whose upper bound lies above; NULL goes to the last one."""
    index = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        index = F.when(minutes < edges[i], F.lit(i)).otherwise(index)
    return index


def duration_distribution(
    tables: Tables, flt: PlayerFilter, edges: Sequence[int] = DURATION_EDGES
) -> DataFrame:
    """Sessions per length bucket; empty buckets have no row.

    The buckets are counted side by side per player and turned into rows at the
    end, so the sessions are shuffled once, by player.
    """
    if not edges or list(edges) != sorted(set(edges)):
        raise ValueError("edges must be one or more ascending numbers")
    labels = bucket_labels(edges)
    numbered = sessions_in_range(tables, flt).select(
        KEY, _bucket_index(F.col("duration_minutes"), edges).alias("bucket")
    )
    rollup = numbered.groupBy(KEY).agg(
        *[F.count_if(F.col("bucket") == i).alias(label) for i, label in enumerate(labels)]
    )
    columns = [F.col(f"`{label}`") for label in labels]
    sums = joined_to(rollup, tables, flt).agg(
        *[F.sum(column).alias(label) for column, label in zip(columns, labels)]
    )
    rows = sums.unpivot([], columns, "duration_bucket", "sessions")
    return rows.filter(F.col("sessions") > 0)


def top_countries(tables: Tables, flt: PlayerFilter, n: int = 10) -> DataFrame:
    """Countries with the most distinct active players; ties go by name."""
    active = sessions_in_range(tables, flt).select(KEY).distinct()
    homes = tables.players.filter(flt.on_platform()).select(KEY, "country")
    return (
        homes.join(active, KEY, "left_semi")
        .groupBy("country")
        .agg(F.count_distinct(KEY).alias("players"))
        .orderBy(F.desc_nulls_last("players"), F.asc_nulls_last("country"))
        .limit(n)
    )
