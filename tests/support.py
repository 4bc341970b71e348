"""Small hand-made tables, in Spark and in DuckDB, and a comparison of the two."""

from __future__ import annotations

from datetime import date

import duckdb
from pyspark.sql import DataFrame, SparkSession

from playpulse.filters import PlayerFilter
from playpulse.operators import kpis, monetization, platforms, quality, retention, selection, shares, trends
from playpulse.schema import Tables

COLUMNS = {
    "players": "player_id string, country string, platform string",
    "sessions": "session_id string, player_id string, session_date date, duration_minutes double",
    "purchases": "purchase_id string, player_id string, purchase_date date, item_type string, price_usd double",
}


def day(n: int) -> date:
    return date(2024, 1, n)


def make_tables(spark: SparkSession, players=(), sessions=(), purchases=()) -> Tables:
    rows = {"players": players, "sessions": sessions, "purchases": purchases}
    return Tables(**{name: spark.createDataFrame(list(rows[name]), COLUMNS[name]) for name in rows})


def make_duckdb(players=(), sessions=(), purchases=()) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, rows in {"players": players, "sessions": sessions, "purchases": purchases}.items():
        con.execute(f"CREATE TABLE {name} ({COLUMNS[name].replace('string', 'varchar')})")
        if rows:
            marks = ", ".join("?" * len(rows[0]))
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", [list(row) for row in rows])
    return con


def reports(flt: PlayerFilter, cohorts: PlayerFilter) -> dict:
    """Every operator that has SQL in the oracle, for one filter setting."""
    return {
        "warehouse_summary": quality.warehouse_summary,
        "raw_profile": quality.raw_profile,
        "empty_table_check": quality.empty_table_check,
        "date_bounds": selection.date_bounds,
        "platform_options": selection.platform_options,
        "filtered_sessions": lambda t: selection.filtered_sessions(t, flt),
        "filtered_purchases": lambda t: selection.filtered_purchases(t, flt),
        "active_players": lambda t: kpis.active_players(t, flt),
        "total_sessions": lambda t: kpis.total_sessions(t, flt),
        "total_revenue": lambda t: kpis.total_revenue(t, flt),
        "paying_users": lambda t: kpis.paying_users(t, flt),
        "arppu": lambda t: kpis.arppu(t, flt),
        "executive_kpis": lambda t: kpis.executive_kpis(t, flt),
        "dau_trend": lambda t: trends.dau_trend(t, flt),
        "revenue_trend": lambda t: trends.revenue_trend(t, flt),
        "duration_distribution": lambda t: trends.duration_distribution(t, flt),
        "duration_share": lambda t: shares.duration_share(t, flt),
        "top_countries": lambda t: trends.top_countries(t, flt),
        "total_purchases": lambda t: kpis.total_purchases(t, flt),
        "conversion_rate": lambda t: kpis.conversion_rate(t, flt),
        "avg_transaction": lambda t: kpis.avg_transaction(t, flt),
        "monetization_kpis": lambda t: kpis.monetization_kpis(t, flt),
        "item_revenue": lambda t: monetization.item_revenue(t, flt),
        "top_spenders": lambda t: monetization.top_spenders(t, flt),
        "platform_metrics": lambda t: platforms.platform_metrics(t, flt),
        "platform_metrics_dedup": lambda t: platforms.platform_metrics_dedup(t, flt),
        "platform_share": lambda t: shares.platform_share(t, flt),
        "platform_share_sessions": lambda t: shares.platform_share(t, flt, "sessions"),
        "platform_share_revenue": lambda t: shares.platform_share(t, flt, "revenue"),
        "platform_shares": lambda t: shares.platform_shares(t, flt),
        "player_first_day": retention.player_first_day,
        "retention_counts": lambda t: retention.retention_counts(t, cohorts),
        "retention": lambda t: retention.retention(t, cohorts),
    }


ORDERED = {
    "platform_options", "dau_trend", "revenue_trend", "top_countries", "item_revenue",
    "top_spenders", "platform_metrics", "platform_metrics_dedup", "retention_counts", "retention",
}


def values(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def assert_matches(name: str, df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(df.columns), name
    want = [tuple(row[names.index(c)] for c in df.columns) for row in cursor.fetchall()]
    got = values(df)
    if name not in ORDERED:
        want, got = sorted(want, key=_sortable), sorted(got, key=_sortable)
    assert len(got) == len(want), name
    for left, right in zip(got, want):
        for a, b in zip(left, right):
            if isinstance(a, float) and isinstance(b, float):
                assert abs(a - b) <= 1e-9 * max(1.0, abs(b)), (name, left, right)
            else:
                assert a == b, (name, left, right)
