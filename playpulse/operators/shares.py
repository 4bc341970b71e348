"""Each group's share of the total, as pie charts show it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.functions.numbers import exact_sum, ratio
from playpulse.operators.platforms import platform_figures
from playpulse.operators.trends import DURATION_EDGES, duration_distribution
from playpulse.schema import Tables


def _percentage(grouped: DataFrame, value: str) -> Column:
    whole = exact_sum(grouped, value, Window.partitionBy())
    return ratio(F.col(value) * F.lit(100.0), whole)


def _share_of_total(grouped: DataFrame, group: str, value: str) -> DataFrame:
    """Adds ``share_pct``. Only for finished reports: their few rows meet in one task,
    which also puts them in order."""
    shared = grouped.select(group, value, _percentage(grouped, value).alias("share_pct"))
    return shared.sortWithinPartitions(F.asc_nulls_last(group))


def duration_share(
    tables: Tables, flt: PlayerFilter, edges: Sequence[int] = DURATION_EDGES
) -> DataFrame:
    buckets = duration_distribution(tables, flt, edges)
    return _share_of_total(buckets, "duration_bucket", "sessions")


SHARED = ("players", "sessions", "revenue")


def platform_share(
    tables: Tables, flt: PlayerFilter, value: str = "players", *, unique_session_ids: bool = False
) -> DataFrame:
    """Share per platform of ``players``, ``sessions`` or ``revenue`` of ``platform_metrics``.

    Only what the value needs is computed: players read no fact, revenue no session ids.
    """
    if value not in SHARED:
        raise ValueError(f"no share of {value!r}: choose players, sessions or revenue")
    figures = platform_figures(tables, flt, [value], unique_session_ids=unique_session_ids)
    return _share_of_total(figures, "platform", value)


def platform_shares(
    tables: Tables, flt: PlayerFilter, *, unique_session_ids: bool = False
) -> DataFrame:
    """All three shares from one report: each value with its ``<value>_pct``."""
    report = platform_figures(tables, flt, SHARED, unique_session_ids=unique_session_ids)
    shares = [_percentage(report, value).alias(f"{value}_pct") for value in SHARED]
    return report.select("platform", *SHARED, *shares)
