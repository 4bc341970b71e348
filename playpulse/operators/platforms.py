"""Platform comparison, in the dashboard's own numbers and without their double counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.filters import PlayerFilter
from playpulse.functions.numbers import sum_of_parts, wide, zero_if_null
from playpulse.plans.rollups import KEY, REPEATED_ID, activity_rollup
from playpulse.schema import Tables


def _at_least_one(count: str) -> Column:
    """Rows a left join yields per player: as many as match, but never none."""
    return wide(F.greatest(F.coalesce(F.col(count), F.lit(0)), F.lit(1)))


FIGURES = ("players", "sessions", "avg_duration", "revenue")


def platform_figures(
    tables: Tables,
    flt: PlayerFilter,
    figures: Sequence[str] = FIGURES,
    *,
    fan_out: bool = True,
    unique_session_ids: bool = False,
) -> DataFrame:
    """The chosen columns of the platform comparison, unsorted; only what they need is read.

    The dimension is shuffled once, by player: the join's partitioning also serves the
    grouping by player and platform that follows. Session ids that occur once are folded to a
    count with the rest of the player's activity; those that may repeat, among its own rows or
    another player's, come as a row for each player and id, and are counted by platform. The
    sessions are read twice: for the ids that repeat, and for everything else.
    """
    players = tables.players.filter(flt.on_platform()).select(KEY, "platform")
    if set(figures) <= {"players"}:
        return players.groupBy("platform").agg(F.count_distinct(KEY).alias("players"))

    by_id = "sessions" in figures and not unique_session_ids
    keys = [KEY, REPEATED_ID] if by_id else [KEY]
    activity = activity_rollup(
        tables,
        flt,
        minutes="avg_duration" in figures,
        purchases=fan_out or "revenue" in figures,
        by_repeated_id=by_id,
    )
    sums = [c for c in activity.columns if c not in keys]
    per_player = (
        players.join(activity, KEY, "left")
        .groupBy("platform", *keys)
        .agg(F.count("*").alias("copies"), *[F.max(c).alias(c) for c in sums])
    )

    # Every purchase row meets every session row of its player, so each price
    # counts once per session and each duration once per purchase.
    copies = wide(F.col("copies"))
    # A row with an id stands beside its player's own one.
    found = {"players": F.count(F.when(F.col(REPEATED_ID).isNull(), F.col(KEY)) if by_id else KEY)}
    if "sessions" in figures:
        found["sessions"] = F.coalesce(F.sum("ids" if by_id else "sessions"), F.lit(0))
    if by_id:
        found["repeated"] = F.count_distinct(REPEATED_ID)
    if "avg_duration" in figures:
        per_minute = copies * _at_least_one("purchases") if fan_out else copies
        timed = F.sum(F.col("timed") * per_minute).cast("double")
        found["avg_duration"] = F.try_divide(sum_of_parts("minutes", per_minute), timed)
    if "revenue" in figures:
        per_price = copies * _at_least_one("sessions") if fan_out else copies
        found["revenue"] = zero_if_null(sum_of_parts("revenue", per_price))
    report = per_player.groupBy("platform").agg(*[c.alias(n) for n, c in found.items()])
    if by_id:
        report = report.withColumn("sessions", F.col("sessions") + F.col("repeated"))
    return report.select("platform", *figures)


def _platform_report(
    tables: Tables, flt: PlayerFilter, fan_out: bool, unique_session_ids: bool
) -> DataFrame:
    report = platform_figures(
        tables, flt, fan_out=fan_out, unique_session_ids=unique_session_ids
    )
    return report.orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("platform"))


def platform_metrics(
    tables: Tables, flt: PlayerFilter, *, unique_session_ids: bool = False
) -> DataFrame:
    """Players (active or not), sessions, mean duration and revenue per platform.

    These are the dashboard's figures: they come from joining sessions and
    purchases by player alone, which multiplies revenue by the player's session
    count and weights durations by the purchase count. The numbers are kept,
    the multiplied rows are never made. ``platform_metrics_dedup`` has the
    figures that agree with the other reports.

    ``unique_session_ids=True`` declares that no session id repeats; sessions
    are then counted from the per-player rows, without shuffling the ids.
    """
    return _platform_report(tables, flt, True, unique_session_ids)


def platform_metrics_dedup(
    tables: Tables, flt: PlayerFilter, *, unique_session_ids: bool = False
) -> DataFrame:
    """As ``platform_metrics``, with each session and each purchase counted once."""
    return _platform_report(tables, flt, False, unique_session_ids)
