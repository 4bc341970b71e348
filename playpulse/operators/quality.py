"""Figures printed after a load, over whole tables without any filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.functions.numbers import exact_sum, ratio, sum_of_parts, zero_if_null
from playpulse.schema import Tables


def _side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One-row frames with different columns put into a single row.

    Stacked and folded rather than cross-joined; each column has one value.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _rows(name: str) -> Column:
    return F.count("*").alias(name)


def _from_statistics(stats: DataFrame) -> DataFrame:
    """Row counts of the tables and sums of their values, from the few rows of statistics."""
    by_table = stats.groupBy("table_name").agg(
        F.sum("n_rows").alias("n"), F.sum("n_values").alias("values"), sum_of_parts("value").alias("total")
    )

    def of(table: str, column: str, name: str) -> Column:
        return F.max(F.when(F.col("table_name") == table, F.col(column))).alias(name)

    return by_table.agg(
        *[F.coalesce(of(t, "n", t), F.lit(0)).alias(t) for t in ("players", "sessions", "purchases")],
        of("sessions", "total", "minutes"),
        of("sessions", "values", "timed"),
        of("purchases", "total", "revenue"),
    )


def warehouse_summary(tables: Tables) -> DataFrame:
    """Row counts of the three tables, total revenue and mean session length (0 if none).

    A stored warehouse answers from its statistics; no table is read.
    """
    stats = tables.statistics()
    if stats is not None:
        merged = _from_statistics(stats)
    else:
        merged = _side_by_side(
            tables.players.agg(_rows("players")),
            tables.sessions.agg(
                _rows("sessions"),
                exact_sum(tables.sessions, "duration_minutes").alias("minutes"),
                F.count("duration_minutes").alias("timed"),
            ),
            tables.purchases.agg(
                _rows("purchases"), exact_sum(tables.purchases, "price_usd").alias("revenue")
            ),
        )
    return merged.select(
        "players",
        "sessions",
        "purchases",
        zero_if_null(F.col("revenue")).alias("total_revenue"),
        ratio(F.col("minutes"), F.col("timed")).alias("avg_session_minutes"),
    )


def raw_profile(tables: Tables) -> DataFrame:
    """Counts, revenue, payers, revenue per payer and payers as % of *all* players.

    Of a stored warehouse only the payers are read; the rest is in its statistics.
    """
    stats = tables.statistics()
    payers = F.count_distinct("player_id").alias("paying_users")
    if stats is not None:
        merged = _side_by_side(_from_statistics(stats), tables.purchases.agg(payers))
    else:
        merged = _side_by_side(
            tables.players.agg(_rows("players")),
            tables.sessions.agg(_rows("sessions")),
            tables.purchases.agg(
                _rows("purchases"), exact_sum(tables.purchases, "price_usd").alias("revenue"), payers
            ),
        )
    return merged.select(
        "players",
        "sessions",
        "purchases",
        zero_if_null(F.col("revenue")).alias("total_revenue"),
        "paying_users",
        ratio(zero_if_null(F.col("revenue")), F.col("paying_users")).alias("arppu"),
        (ratio(F.col("paying_users"), F.col("players")) * F.lit(100.0)).alias("paying_pct"),
    )


def empty_table_check(tables: Tables) -> DataFrame:
    """Row count of each fact table and whether it is empty; from statistics where kept."""
    stats = tables.statistics()
    counted = _from_statistics(stats) if stats is not None else None
    counts = [
        (df.agg(_rows("n_rows")) if counted is None else counted.select(F.col(name).alias("n_rows"))).select(
            F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") == 0).alias("is_empty")
        )
        for name, df in (("sessions", tables.sessions), ("purchases", tables.purchases))
    ]
    return reduce(DataFrame.unionByName, counts)
