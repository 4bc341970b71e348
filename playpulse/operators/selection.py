"""What the filter widgets offer, and the filtered facts row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.plans.rollups import KEY, purchases_in_range, sessions_in_range
from playpulse.schema import Tables


def date_bounds(tables: Tables) -> DataFrame:
    """First and last session day, the default date range.

    A stored warehouse has one row of statistics for each day: no session is read.
    """
    stats = tables.statistics()
    if stats is not None:
        days = stats.where((F.col("table_name") == "sessions") & (F.col("n_rows") > 0))
        return days.agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"))
    return tables.sessions.agg(
        F.min("session_date").alias("min_date"), F.max("session_date").alias("max_date")
    )


def platform_options(tables: Tables) -> DataFrame:
    return tables.players.select("platform").distinct().orderBy(F.asc_nulls_last("platform"))


def filtered_sessions(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Every session in range of a player on the chosen platforms, with country and platform.

    Both sides reach the join straight from their shuffle, which is the shape
    AQE can split when one player owns a large part of the rows.
    """
    players = tables.players.filter(flt.on_platform()).select(KEY, "country", "platform")
    return sessions_in_range(tables, flt).join(players, KEY)


def filtered_purchases(tables: Tables, flt: PlayerFilter) -> DataFrame:
    """Every purchase in range, likewise; the player's platform is ``player_platform``."""
    players = tables.players.filter(flt.on_platform()).select(
        KEY, "country", F.col("platform").alias("player_platform")
    )
    return purchases_in_range(tables, flt).join(players, KEY)
