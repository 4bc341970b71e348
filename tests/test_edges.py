"""Hand-made edge rows with known answers."""

from datetime import date, datetime

import pytest
from playpulse.filters import PlayerFilter
from playpulse.operators import kpis, monetization, platforms, quality, retention, selection, shares, trends
from playpulse.schema import WAREHOUSE_SCHEMAS, empty_tables
from pyspark.sql import functions as F
from support import day, make_tables, values

WEEK = PlayerFilter("2024-01-05", "2024-01-11")
PLAYERS = [("a", "DE", "iOS"), ("b", "FR", "Web")]


def test_empty_facts(spark):
    t = make_tables(spark, players=PLAYERS)
    assert values(kpis.executive_kpis(t, WEEK)) == [(0, 0, 0.0, 0.0)]
    assert values(kpis.monetization_kpis(t, WEEK)) == [(0, 0.0, 0.0, 0.0)]
    assert values(trends.dau_trend(t, WEEK)) == []
    assert values(trends.duration_distribution(t, WEEK)) == []
    assert values(retention.retention(t, WEEK)) == []
    for report in (platforms.platform_metrics, platforms.platform_metrics_dedup):
        assert values(report(t, WEEK)) == [("Web", 1, 0, None, 0.0), ("iOS", 1, 0, None, 0.0)]
    assert values(shares.platform_share(t, WEEK, "revenue")) == [("Web", 0.0, 0.0), ("iOS", 0.0, 0.0)]


def test_typed_empty_tables(spark):
    t = empty_tables(spark)
    assert {name: df.schema for name, df in t.named().items()} == WAREHOUSE_SCHEMAS
    assert values(quality.warehouse_summary(t)) == [(0, 0, 0, 0.0, 0.0)]
    assert values(quality.raw_profile(t)) == [(0, 0, 0, 0.0, 0, 0.0, 0.0)]
    assert values(quality.empty_table_check(t)) == [("sessions", 0, True), ("purchases", 0, True)]
    assert values(monetization.top_spenders(t, WEEK)) == []
    assert values(selection.date_bounds(t)) == [(None, None)]


def test_orphans_and_missing_keys(spark):
    t = make_tables(
        spark,
        players=PLAYERS,
        sessions=[
            ("s1", "a", day(5), 1.0),
            ("s2", "ghost", day(5), 1.0),
            ("s3", None, day(5), 1.0),
            ("s4", None, day(9), 1.0),
            ("s5", None, day(3), 1.0),
        ],
    )
    assert values(kpis.executive_kpis(t, WEEK)) == [(1, 1, 0.0, 0.0)]
    assert values(trends.dau_trend(t, WEEK)) == [(day(5), 1)]
    month = PlayerFilter("2024-01-01", "2024-01-31", [])
    # The unknown player belongs to a cohort; keyless sessions make a cohort of nobody.
    assert values(retention.retention(t, month)) == [
        (day(3), 0, None, None, None),
        (day(5), 2, 0.0, 0.0, 0.0),
    ]


def test_duration_edges(spark):
    minutes = [4.99, 5.0, 14.0, 15.0, 29.0, 30.0, 59.0, 60.0, None]
    t = make_tables(
        spark, players=PLAYERS, sessions=[(f"s{i}", "a", day(6), m) for i, m in enumerate(minutes)]
    )
    assert dict(values(trends.duration_distribution(t, WEEK))) == {
        "0-5 min": 1,
        "5-15 min": 2,
        "15-30 min": 2,
        "30-60 min": 2,
        "60+ min": 2,
    }
    assert dict(values(trends.duration_distribution(t, WEEK, edges=[30]))) == {"0-30 min": 5, "30+ min": 4}
    with pytest.raises(ValueError):
        trends.duration_distribution(t, WEEK, edges=[30, 5])


def test_range_is_inclusive_and_sessions_count_on_their_start_day(spark):
    from playpulse.sources.warehouse import build_fact_sessions

    starts = ["2024-01-05 00:00:00", "2024-01-11 23:59:59", "2024-01-11 23:50:00", "2024-01-12 00:00:00"]
    raw = make_tables(spark, players=PLAYERS)
    sessions = spark.createDataFrame(
        [(f"s{i}", "a", s, "2024-01-12 00:10:00", 20, 0, 0, 0, 0) for i, s in enumerate(starts)],
        "session_id string, player_id string, session_start string, session_end string, duration_minutes long, "
        "levels_completed long, deaths long, items_collected long, score long",
    )
    built = build_fact_sessions(type(raw)(raw.players, sessions, raw.purchases))
    t = type(raw)(raw.players, built, raw.purchases)
    assert values(trends.dau_trend(t, WEEK)) == [(day(5), 1), (day(11), 1)]
    assert values(kpis.total_sessions(t, WEEK)) == [(3,)]


def test_ties_go_by_name(spark):
    names = [f"C{i:02d}" for i in range(12)]
    t = make_tables(
        spark,
        players=[(f"p{n}", n, "iOS") for n in reversed(names)],
        sessions=[(f"s{n}", f"p{n}", day(6), 1.0) for n in names],
        purchases=[(f"b{n}", f"p{n}", day(6), "bundle", 2.0) for n in names],
    )
    assert values(trends.top_countries(t, WEEK)) == [(n, 1) for n in names[:10]]
    assert values(trends.top_countries(t, WEEK, n=2)) == [(n, 1) for n in names[:2]]
    assert values(monetization.top_spenders(t, WEEK, n=3)) == [(f"p{n}", "iOS", 1, 2.0) for n in names[:3]]


def test_fan_out_numbers(spark):
    t = make_tables(
        spark,
        players=PLAYERS,
        sessions=[(f"s{i}", "a", day(6), float(i)) for i in (1, 2, 3)],
        purchases=[("b1", "a", day(6), "bundle", 5.0), ("b2", "a", day(7), "bundle", 5.0)],
    )
    ios = PlayerFilter("2024-01-05", "2024-01-11", ["iOS"])
    for unique in (False, True):
        assert values(platforms.platform_metrics(t, ios, unique_session_ids=unique)) == [("iOS", 1, 3, 2.0, 30.0)]
        assert values(platforms.platform_metrics_dedup(t, ios, unique_session_ids=unique)) == [
            ("iOS", 1, 3, 2.0, 10.0)
        ]
    assert values(kpis.total_revenue(t, ios)) == [(10.0,)]


def test_counts_too_large_for_a_bigint_product(spark):
    big = 4_000_000_000
    per_player = spark.range(1).select(
        F.lit(big).alias("sessions"), F.lit(big).alias("purchases"), F.lit(1).alias("copies")
    )
    from playpulse.operators.platforms import _at_least_one

    product = per_player.select((_at_least_one("sessions") * _at_least_one("purchases")).cast("double"))
    assert values(product) == [(float(big) ** 2,)]


def test_late_cohort_and_return_after_the_range(spark):
    t = make_tables(
        spark,
        sessions=[
            ("s1", "a", day(11), 1.0),
            ("s2", "a", day(12), 1.0),
            ("s3", "b", day(10), 1.0),
            ("s4", "b", day(13), 1.0),
            ("s5", "b", day(17), 1.0),
            ("s6", "late", day(31), 1.0),
        ],
    )
    assert values(retention.retention_counts(t, WEEK)) == [(day(10), 1, 0, 1, 1), (day(11), 1, 1, 0, 0)]
    last = PlayerFilter("2024-01-31", "2024-01-31")
    assert values(retention.retention(t, last)) == [(day(31), 1, 0.0, 0.0, 0.0)]
    assert retention.retention(t, WEEK, days=[0, 2]).columns[2:] == ["d0_retention_pct", "d2_retention_pct"]
    with pytest.raises(ValueError):
        retention.retention(t, WEEK, days=[])


def test_platform_comes_from_the_player(spark):
    t = make_tables(
        spark, players=PLAYERS, purchases=[("b1", "a", day(6), "bundle", 4.0), ("b2", "b", day(6), "bundle", 1.0)]
    )
    other = t.purchases.withColumn("platform", F.lit("Web"))
    t = type(t)(t.players, t.sessions, other)
    ios = PlayerFilter("2024-01-05", "2024-01-11", ["iOS"])
    assert values(kpis.total_revenue(t, ios)) == [(4.0,)]
    bought = selection.filtered_purchases(t, ios)
    assert values(bought.select("platform", "player_platform")) == [("Web", "iOS")]


def test_conversion_may_pass_one_hundred(spark):
    t = make_tables(
        spark,
        players=PLAYERS,
        sessions=[("s1", "a", day(6), 1.0), ("s2", "b", day(1), 1.0)],
        purchases=[("b1", "a", day(6), "bundle", 1.0), ("b2", "b", day(7), "bundle", 1.0)],
    )
    assert values(kpis.conversion_rate(t, WEEK)) == [(200.0,)]


def test_filter_arguments(spark):
    t = make_tables(spark, players=[*PLAYERS, ("c", "US", None)], sessions=[("s1", "c", day(6), 1.0)])
    assert values(kpis.total_sessions(t, WEEK)) == [(1,)]
    assert values(kpis.total_sessions(t, PlayerFilter(day(5), day(11), []))) == [(0,)]
    assert values(kpis.total_sessions(t, PlayerFilter(day(11), day(5)))) == [(0,)]
    assert PlayerFilter(datetime(2024, 1, 5, 7), date(2024, 1, 11)) == WEEK
    quoted = PlayerFilter(day(5), day(11), ["O'Brien') OR ('1'='1"])
    assert values(kpis.total_sessions(t, quoted)) == [(0,)]
    with pytest.raises(ValueError):
        PlayerFilter("2024-01-05", None)
    with pytest.raises(TypeError):
        PlayerFilter("2024-01-05", "2024-01-06", "iOS")
    with pytest.raises(ValueError):
        shares.platform_share(t, WEEK, "avg_duration")


def test_ranges_of_any_width_agree(spark):
    """Several blocks of days, the first and last bit of each, and every open-ended bound."""
    starts = [date(2023, 1, 1), date(2023, 3, 5), date(2023, 3, 6), date(2023, 12, 31), day(31)]
    rows = [
        (f"{i}-{n}", f"p{i}", date.fromordinal(first.toordinal() + n), 1.0)
        for i, first in enumerate(starts)
        for n in (0, 1, 3, 7)[: i + 1]
    ]
    t = make_tables(spark, players=[(f"p{i}", "DE", "iOS") for i in range(5)], sessions=rows)
    ranges = [("2023-01-01", "2024-02-20"), ("1900-01-01", "2100-01-01"), ("0001-01-01", "9999-12-31")]
    by_day = {}
    for _, player, on, _ in rows:
        by_day.setdefault(on, set()).add(player)
    expected_days = [(on, len(players)) for on, players in sorted(by_day.items())]
    cohorts = {}
    for i, first in enumerate(starts):
        size, *flags = cohorts.get(first, (0, 0, 0, 0))
        cohorts[first] = (size + 1, *[f + (i >= k) for k, f in enumerate(flags, start=1)])
    expected_cohorts = [(first, *counts) for first, counts in sorted(cohorts.items())]
    for flt in (PlayerFilter(*span) for span in ranges):
        assert values(trends.dau_trend(t, flt)) == expected_days
        assert values(retention.retention_counts(t, flt)) == expected_cohorts


def test_exact_sums(spark):
    """Cents add up exactly, and neither negative nor decimal nor integer columns go astray."""
    cents = [("b%d" % i, "a", day(6), "bundle", 0.1) for i in range(1000)]
    refund = [("r1", "a", day(6), "bundle", -0.35), ("r2", "a", day(6), "bundle", None)]
    t = make_tables(spark, players=PLAYERS, purchases=[*cents, *refund])
    assert values(kpis.total_revenue(t, WEEK)) == [(99.65,)]
    for kind, total in (("decimal(10,2)", 99.65), ("int", 0.0)):
        typed = type(t)(t.players, t.sessions, t.purchases.withColumn("price_usd", F.col("price_usd").cast(kind)))
        assert values(kpis.total_revenue(typed, WEEK)) == [(total,)]


def test_identities(spark):
    """Reports that slice one total add up to it."""
    import __spark_entry__ as registry
    from playpulse.sources.testdata import load_tables

    t = load_tables(spark, "/root/testdata/sf0.001")
    flt = registry.REPORT
    (revenue,), (sessions,) = values(kpis.total_revenue(t, flt))[0], values(kpis.total_sessions(t, flt))[0]
    total = pytest.approx(revenue, abs=1e-6)
    assert sum(row[1] for row in values(trends.revenue_trend(t, flt))) == total
    assert sum(row[2] for row in values(monetization.item_revenue(t, flt))) == total
    assert sum(row[4] for row in values(platforms.platform_metrics_dedup(t, flt))) == total
    assert sum(row[1] for row in values(trends.duration_distribution(t, flt))) == sessions
    assert sum(row[2] for row in values(shares.duration_share(t, flt))) == pytest.approx(100.0)
    cohorts = values(retention.retention(t, registry.COHORTS))
    assert sum(row[1] for row in cohorts) == t.sessions.select("player_id").distinct().count()
    assert all(0 <= pct <= 100 for row in cohorts for pct in row[2:])


SMALL_AND_ODD = [
    ([4e-7, 4e-7], 8e-7),
    ([1.5e-6], 1.5e-6),
    ([1e-9] * 3, 3e-9),
    ([1e-15], 1e-15),
    ([1e19, 1.0], 1e19 + 1.0),
    ([5.25, float("inf")], float("inf")),
    ([float("inf"), float("-inf")], float("nan")),
    ([float("nan"), 1.0], float("nan")),
]


@pytest.mark.parametrize(("prices", "total"), SMALL_AND_ODD)
def test_no_amount_is_rounded_away_and_none_raises(spark, prices, total):
    t = make_tables(
        spark,
        players=PLAYERS,
        purchases=[(f"b{i}", "a", day(6), "bundle", p) for i, p in enumerate(prices)],
    )
    want = pytest.approx(total, rel=1e-12, nan_ok=True)
    assert values(kpis.total_revenue(t, WEEK)) == [(want,)]
    assert values(kpis.avg_transaction(t, WEEK)) == [(pytest.approx(total / len(prices), nan_ok=True),)]
    assert values(trends.revenue_trend(t, WEEK)) == [(day(6), want)]
    assert values(monetization.item_revenue(t, WEEK)) == [("bundle", len(prices), want)]
    assert values(monetization.top_spenders(t, WEEK)) == [("a", "iOS", len(prices), want)]
    for report in (platforms.platform_metrics, platforms.platform_metrics_dedup):
        assert {row[0]: row[4] for row in values(report(t, WEEK))} == {"iOS": want, "Web": 0.0}
    assert values(quality.warehouse_summary(t))[0][3] == want


def test_open_ended_bounds_work_in_every_filtered_report(spark):
    from support import reports

    ever = PlayerFilter("0001-01-01", "9999-12-31")
    rows = [("s1", "a", day(5), 4.0), ("s2", "b", date(1969, 12, 31), 4.0), ("s3", "b", date(9999, 12, 31), 1.0)]
    t = make_tables(
        spark, players=PLAYERS, sessions=rows, purchases=[("b1", "a", day(6), "bundle", 2.0)]
    )
    found = {name: values(report(t)) for name, report in reports(ever, ever).items()}
    assert found["total_sessions"] == [(3,)]
    assert found["dau_trend"] == [(date(1969, 12, 31), 1), (day(5), 1), (date(9999, 12, 31), 1)]
    assert found["retention_counts"] == [(date(1969, 12, 31), 1, 0, 0, 0), (day(5), 1, 0, 0, 0)]


def test_session_ids_shared_by_players_count_once_per_platform(spark):
    t = make_tables(
        spark,
        players=[*PLAYERS, ("c", "US", "iOS")],
        sessions=[
            ("s1", "a", day(6), 1.0),
            ("s1", "c", day(6), 1.0),
            ("s1", "b", day(6), 1.0),
            ("s2", "a", day(6), 1.0),
            ("s2", "a", day(7), 1.0),
            (None, "a", day(6), 1.0),
        ],
    )
    counts = {row[0]: row[1:3] for row in values(platforms.platform_metrics(t, WEEK))}
    assert counts == {"iOS": (2, 2), "Web": (1, 1)}
    shares_ = {row[0]: row[1:6] for row in values(shares.platform_shares(t, WEEK))}
    assert shares_["iOS"] == (2, 2, 0.0, pytest.approx(200 / 3), pytest.approx(200 / 3))


def test_odd_values_in_both_engines(spark):
    """Durations and prices that are tiny, infinite or undefined mean the same in the SQL."""
    import oracle
    from support import assert_matches, make_duckdb, reports

    odd = [4e-7, 70.0, float("inf"), float("nan"), 5.0]
    rows = {
        "players": PLAYERS,
        "sessions": [(f"s{i}", "a", day(6), v) for i, v in enumerate(odd)],
        "purchases": [(f"b{i}", "b", day(6), f"item{i}", v) for i, v in enumerate(odd)],
    }
    t, con = make_tables(spark, **rows), make_duckdb(**rows)
    sql = oracle.bodies("2024-01-05", "2024-01-11", None, ("2024-01-05", "2024-01-11"))
    for name in ("duration_distribution", "dau_trend"):
        assert_matches(name, reports(WEEK, WEEK)[name](t), con, sql[name])
    got = {row[0]: row[2] for row in values(monetization.item_revenue(t, WEEK))}
    want = {row[0]: row[2] for row in con.execute(sql["item_revenue"]).fetchall()}
    assert got == pytest.approx(want, nan_ok=True)


def _bits(value: float) -> str:
    return value.hex()


LARGE_AND_LONG = {
    "from a billion up": [1e9, 1e15 + 0.3, 123456789012.34, 2.0**60, -(2.0**60) + 256, 0.1, 3e19, -3e19],
    "more than twelve decimals": [1 / 3, 2 / 7, 1e-13, 1.7e-14, -1e-13, 0.1, 5.0, 0.7 / 9],
    "both": [1e17, 1.0, 1e-9, -1e17, 1 / 3, 1e-14, 9.99, 2.0**-90],
}


@pytest.mark.parametrize("amounts", LARGE_AND_LONG.values(), ids=LARGE_AND_LONG)
def test_sums_do_not_depend_on_the_shuffle(spark, amounts):
    """Equal bits under twenty partitionings of the rows, and the sum itself to the last places."""
    import math
    import random

    from playpulse.functions.numbers import exact_sum, sum_of_parts, sum_parts

    rng = random.Random(5)
    prices = [a * f for a in amounts for f in (1, 1, 3, 7, 0.5, 1.1)]
    want, found = math.fsum(prices), set()
    for n in range(20):
        rng.shuffle(prices)
        df = spark.createDataFrame([(i % 7, p) for i, p in enumerate(prices)], "k int, price double")
        df = df.repartition(1 + n % 6, "k" if n % 2 else "price")
        parts = df.groupBy("k").agg(*sum_parts(df, "price", "x"))
        folded = parts.groupBy((F.col("k") % 2).alias("k"))
        folded = folded.agg(*[F.sum(c).alias(c) for c in parts.columns if c != "k"])
        found.add(_bits(df.agg(exact_sum(df, "price").alias("s")).first().s))
        found.add(_bits(folded.agg(sum_of_parts("x").alias("s")).first().s))
        found.add(_bits(parts.agg(sum_of_parts("x", F.lit(1).cast("decimal(20,0)")).alias("s")).first().s))
    assert len(found) == 1
    scale = sum(map(abs, prices))
    assert abs(float.fromhex(found.pop()) - want) <= 4e-16 * scale


def test_ids_that_repeat_within_a_player_and_between_players(spark):
    """Distinct ids by platform, with a filter that lets everything through and as it is."""
    import random

    from playpulse.functions import id_filter

    rng = random.Random(3)
    players = [(f"P{i}", "DE", rng.choice(["iOS", "Web", None])) for i in range(30)]
    players += [("P0", "FR", "Web"), ("P1", "DE", "iOS"), (None, "DE", "iOS")]
    sessions = [
        (rng.choice([f"S{i}", f"S{i}", "unknown", f"S{rng.randint(0, 30)}", None]),
         rng.choice(["P0", f"P{rng.randint(0, 32)}", None]), day(6), 1.0)
        for i in range(400)
    ]
    t = make_tables(spark, players, sessions)
    home = {}
    for key, _, platform in players:
        home.setdefault(key, set()).add(platform)
    want = {}
    for session_id, player, _, _ in sessions:
        for platform in home.get(player, ()) if player and session_id else ():
            want.setdefault(platform, set()).add(session_id)
    cells = id_filter.CELLS
    try:
        for n in (cells, 1):  # with one cell of 64 bits nearly all ids pass
            id_filter.CELLS = n
            for report in (platforms.platform_metrics, platforms.platform_metrics_dedup):
                got = {row[0]: row[2] for row in values(report(t, WEEK))}
                assert got == {p: len(ids) for p, ids in want.items()}
    finally:
        id_filter.CELLS = cells
