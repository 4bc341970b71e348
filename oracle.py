"""Every report as plain SQL for a second engine (DuckDB), to check the Spark plans against.

The SQL says directly what a report means: row-level joins, COUNT(DISTINCT),
the unreduced sessions x purchases join. It shares no code with the package.
The bodies read views ``players``, ``sessions`` and ``purchases``; ``MAPPING``
defines them over the test tables.
"""

from __future__ import annotations

MAPPING = """
WITH ev AS (
    SELECT event_id, ts, event_type, value, k, user_id * 10 + k % 10 AS pid
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
players AS (
    SELECT c_custkey AS player_id,
           CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS registration_date,
           n_name AS country, c_mktsegment AS platform,
           CASE c_custkey % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'ad' ELSE 'referral' END
               AS install_source,
           CASE c_custkey % 2 WHEN 0 THEN 'phone' ELSE 'tablet' END AS device_type,
           CAST(c_custkey % 50 + 1 AS BIGINT) AS player_level
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
sessions AS (
    SELECT event_id AS session_id, pid AS player_id, ts AS session_start,
           ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS session_end,
           value AS duration_minutes, CAST(k % 10 AS BIGINT) AS levels_completed,
           CAST(k % 7 AS BIGINT) AS deaths, CAST(k % 20 AS BIGINT) AS items_collected,
           CAST(k * 10 AS BIGINT) AS score, CAST(ts AS DATE) AS session_date
    FROM ev
),
purchases AS (
    SELECT event_id AS purchase_id, pid AS player_id, event_id AS session_id,
           ts AS purchase_time, item_type, item_type || ' ' || k % 10 AS item_name,
           value AS price_usd, CASE k % 2 WHEN 0 THEN 'USD' ELSE 'EUR' END AS currency,
           CASE k % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS platform,
           CAST(ts AS DATE) AS purchase_date
    FROM (SELECT *, CASE (k // 10) % 4 WHEN 0 THEN 'currency' WHEN 1 THEN 'powerup'
                                       WHEN 2 THEN 'cosmetic' ELSE 'bundle' END AS item_type
          FROM ev WHERE event_type = 'purchase')
)
"""

# Upper bounds of the session-length buckets, in minutes.
EDGES = (5, 15, 30, 60)
RETURN_DAYS = (1, 3, 7)


def exact(column: str) -> str:
    """SUM that does not depend on the order of the rows, as DOUBLE.

    Six decimals are summed as DECIMAL and what they leave as DOUBLE; so are values that are
    infinite, undefined or too large for that.
    """
    small = f"isfinite({column}) AND abs({column}) < 1e9"
    decimal = f"CAST({column} AS DECIMAL(18,6))"
    return (
        f"(CAST(COALESCE(SUM(CASE WHEN {small} THEN {decimal} END), 0) AS DOUBLE)"
        f" + SUM(CASE WHEN {small} THEN {column} - CAST({decimal} AS DOUBLE) ELSE {column} END))"
    )


def mean(column: str) -> str:
    return f"{exact(column)} / NULLIF(COUNT({column}), 0)"


def bucket(minutes: str) -> str:
    """The first bucket whose upper bound lies above; what no bound lies above goes to the last."""
    lows = (0, *EDGES)
    cases = " ".join(
        f"WHEN {minutes} < {high} THEN '{low}-{high} min'" for low, high in zip(lows, EDGES)
    )
    return f"CASE {cases} ELSE '{EDGES[-1]}+ min' END"


def bodies(lo: str, hi: str, platforms: list[str] | None, retention: tuple[str, str]) -> dict[str, str]:
    """Query name -> SELECT over players / sessions / purchases for one filter setting."""
    if platforms is None:
        chosen = "TRUE"
    elif not platforms:
        chosen = "FALSE"
    else:
        chosen = "platform IN ({})".format(", ".join(f"'{name}'" for name in platforms))
    span = f"BETWEEN DATE '{lo}' AND DATE '{hi}'"

    audience = f"(SELECT player_id, country, platform AS home FROM players WHERE {chosen})"
    in_range = f"(SELECT * FROM sessions WHERE session_date {span})"
    bought_in_range = f"(SELECT * FROM purchases WHERE purchase_date {span})"
    visits = f"(SELECT * FROM {in_range} JOIN {audience} USING (player_id))"
    buys = f"(SELECT * FROM {bought_in_range} JOIN {audience} USING (player_id))"

    def one(expression: str, source: str) -> str:
        return f"(SELECT {expression} FROM {source})"

    active = one("COUNT(DISTINCT player_id)", visits)
    n_sessions = one("COUNT(*)", visits)
    revenue = one(f"COALESCE({exact('price_usd')}, 0)", buys)
    payers = one("COUNT(DISTINCT player_id)", buys)
    n_purchases = one("COUNT(*)", buys)
    mean_price = one(f"COALESCE({mean('price_usd')}, 0)", buys)
    arppu = f"COALESCE({revenue} / NULLIF({payers}, 0), 0)"
    conversion = f"COALESCE(CAST({payers} AS DOUBLE) / NULLIF({active}, 0) * 100, 0)"

    durations = f"""
        SELECT {bucket("duration_minutes")} AS duration_bucket, COUNT(*) AS sessions
        FROM {visits} GROUP BY duration_bucket"""

    fanned = f"""
        SELECT home AS platform, COUNT(DISTINCT player_id) AS players,
               COUNT(DISTINCT s.session_id) AS sessions,
               {mean('s.duration_minutes')} AS avg_duration,
               COALESCE({exact('u.price_usd')}, 0) AS revenue
        FROM {audience}
        LEFT JOIN {in_range} s USING (player_id)
        LEFT JOIN {bought_in_range} u USING (player_id)
        GROUP BY home"""
    separate = f"""
        SELECT p.home AS platform, p.players, COALESCE(v.sessions, 0) AS sessions, v.avg_duration,
               COALESCE(b.revenue, 0) AS revenue
        FROM (SELECT home, COUNT(DISTINCT player_id) AS players FROM {audience} GROUP BY home) p
        LEFT JOIN (SELECT home, COUNT(DISTINCT session_id) AS sessions,
                          {mean('duration_minutes')} AS avg_duration FROM {visits} GROUP BY home) v
          ON p.home IS NOT DISTINCT FROM v.home
        LEFT JOIN (SELECT home, {exact('price_usd')} AS revenue FROM {buys} GROUP BY home) b
          ON p.home IS NOT DISTINCT FROM b.home"""

    def share(report: str, group: str, value: str, kind: str) -> str:
        whole = f"CAST(SUM(CAST({value} AS {kind})) OVER () AS DOUBLE)"
        if kind == "DOUBLE":
            whole = f"(SELECT {exact(value)} FROM ({report}))"
        return f"""SELECT {group}, {value},
            CASE WHEN {whole} > 0 THEN {value} * 100.0::DOUBLE / {whole} ELSE 0.0::DOUBLE END AS share_pct
            FROM ({report})"""

    first_days = "SELECT player_id, MIN(session_date) AS first_session_date FROM sessions GROUP BY player_id"
    from_day, to_day = retention
    came_back = ", ".join(
        f"""COUNT(DISTINCT CASE WHEN s.session_date = f.first_session_date + {n}
            THEN f.player_id END) AS d{n}_retained"""
        for n in RETURN_DAYS
    )
    cohorts = f"""
        SELECT f.first_session_date, COUNT(DISTINCT f.player_id) AS cohort_size, {came_back}
        FROM ({first_days}) f LEFT JOIN sessions s USING (player_id)
        WHERE f.first_session_date BETWEEN DATE '{from_day}' AND DATE '{to_day}'
        GROUP BY f.first_session_date"""
    rates = ", ".join(
        f"ROUND(d{n}_retained * 100.0::DOUBLE / NULLIF(cohort_size, 0), 2) AS d{n}_retention_pct"
        for n in RETURN_DAYS
    )

    counts = ", ".join(f"(SELECT COUNT(*) FROM {t}) AS {t}" for t in ("players", "sessions", "purchases"))
    all_revenue = one(f"COALESCE({exact('price_usd')}, 0)", "purchases")
    all_payers = one("COUNT(DISTINCT player_id)", "purchases")
    return {
        "dim_players": "SELECT * FROM players",
        "fact_sessions": "SELECT * FROM sessions",
        "fact_purchases": "SELECT * FROM purchases",
        "warehouse_summary": f"""SELECT {counts}, {all_revenue} AS total_revenue,
            {one(f"COALESCE({mean('duration_minutes')}, 0)", "sessions")} AS avg_session_minutes""",
        "raw_profile": f"""SELECT *, COALESCE(total_revenue / NULLIF(paying_users, 0), 0) AS arppu,
            COALESCE(CAST(paying_users AS DOUBLE) / NULLIF(players, 0) * 100, 0) AS paying_pct
            FROM (SELECT {counts}, {all_revenue} AS total_revenue, {all_payers} AS paying_users)""",
        "empty_table_check": """SELECT 'sessions' AS table_name, COUNT(*) AS n_rows, COUNT(*) = 0 AS is_empty FROM sessions
            UNION ALL SELECT 'purchases', COUNT(*), COUNT(*) = 0 FROM purchases""",
        "date_bounds": "SELECT MIN(session_date) AS min_date, MAX(session_date) AS max_date FROM sessions",
        "platform_options": "SELECT DISTINCT platform FROM players ORDER BY platform NULLS LAST",
        "filtered_sessions": f"""SELECT session_id, player_id, session_date, duration_minutes, country,
            home AS platform FROM {visits}""",
        "filtered_purchases": f"""SELECT purchase_id, player_id, purchase_date, item_type, price_usd, country,
            home AS player_platform FROM {buys}""",
        "active_players": f"SELECT {active} AS active_players",
        "total_sessions": f"SELECT {n_sessions} AS total_sessions",
        "total_revenue": f"SELECT {revenue} AS total_revenue",
        "paying_users": f"SELECT {payers} AS paying_users",
        "arppu": f"SELECT {arppu} AS arppu",
        "executive_kpis": f"""SELECT {active} AS active_players, {n_sessions} AS total_sessions,
            {revenue} AS total_revenue, {arppu} AS arppu""",
        "dau_trend": f"""SELECT session_date, COUNT(DISTINCT player_id) AS dau FROM {visits}
            GROUP BY session_date ORDER BY session_date""",
        "revenue_trend": f"""SELECT purchase_date, {exact('price_usd')} AS revenue FROM {buys}
            GROUP BY purchase_date ORDER BY purchase_date""",
        "duration_distribution": durations,
        "duration_share": share(durations, "duration_bucket", "sessions", "BIGINT"),
        "top_countries": f"""SELECT country, COUNT(DISTINCT player_id) AS players FROM {visits}
            GROUP BY country ORDER BY players DESC NULLS LAST, country NULLS LAST LIMIT 10""",
        "total_purchases": f"SELECT {n_purchases} AS total_purchases",
        "conversion_rate": f"SELECT {conversion} AS conversion_rate",
        "avg_transaction": f"SELECT {mean_price} AS avg_transaction",
        "monetization_kpis": f"""SELECT {n_purchases} AS total_purchases, {conversion} AS conversion_rate,
            {mean_price} AS avg_transaction, {revenue} AS total_revenue""",
        "item_revenue": f"""SELECT item_type, COUNT(*) AS purchases, {exact('price_usd')} AS revenue FROM {buys}
            GROUP BY item_type ORDER BY revenue DESC NULLS LAST, item_type NULLS LAST""",
        "top_spenders": f"""SELECT player_id, home AS platform, COUNT(purchase_id) AS purchases,
            {exact('price_usd')} AS total_spent FROM {buys} GROUP BY player_id, home
            ORDER BY total_spent DESC NULLS LAST, player_id NULLS LAST, platform NULLS LAST LIMIT 10""",
        "platform_metrics": fanned + " ORDER BY revenue DESC NULLS LAST, platform NULLS LAST",
        "platform_metrics_dedup": separate + " ORDER BY revenue DESC NULLS LAST, platform NULLS LAST",
        "platform_share": share(fanned, "platform", "players", "BIGINT"),
        "platform_share_sessions": share(fanned, "platform", "sessions", "BIGINT"),
        "platform_shares": f"""SELECT a.platform, players, a.share_pct AS players_pct, sessions,
            b.share_pct AS sessions_pct, revenue, c.share_pct AS revenue_pct
            FROM ({share(fanned, "platform", "players", "BIGINT")}) a
            JOIN ({share(fanned, "platform", "sessions", "BIGINT")}) b
              ON a.platform IS NOT DISTINCT FROM b.platform
            JOIN ({share(fanned, "platform", "revenue", "DOUBLE")}) c
              ON a.platform IS NOT DISTINCT FROM c.platform""",
        "platform_share_revenue": share(fanned, "platform", "revenue", "DOUBLE"),
        "player_first_day": first_days,
        "retention_counts": cohorts + " ORDER BY first_session_date",
        "retention": f"SELECT first_session_date, cohort_size, {rates} FROM ({cohorts}) ORDER BY first_session_date",
    }


def over_test_tables(lo: str, hi: str, platforms: list[str] | None, retention: tuple[str, str]) -> dict[str, str]:
    return {name: MAPPING + body for name, body in bodies(lo, hi, platforms, retention).items()}
