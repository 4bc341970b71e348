"""What the plans must and must not contain, and how they behave under skew."""

import re

import pytest
from playpulse.filters import PlayerFilter
from playpulse.operators import kpis, monetization, platforms, retention, selection, shares, trends
from playpulse.sources.warehouse import load_warehouse, read_warehouse, save_warehouse, write_warehouse
from support import values
from test_warehouse import RANGE, many_sessions

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse"))
    write_warehouse(many_sessions(spark), path)
    return read_warehouse(spark, path)


@pytest.fixture()
def no_broadcast(spark):
    """Dimensions too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_no_query_leaves_the_engine_or_multiplies_rows(spark, capsys):
    for name in registry.REPORTS:
        plan = plan_of(registry.queries()[name](spark, SF_DIR), capsys)
        nodes = ["Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"]
        # Bucket counts are turned from one row of columns into rows at the very end.
        if not name.startswith("duration_"):
            nodes.append("Expand")
        for node in nodes:
            assert not re.search(rf"\b\w*{node}\w*\b", plan), (name, node)


def test_date_filter_prunes_directories_and_columns(stored, capsys):
    flt = PlayerFilter("2024-01-02", "2024-01-03", ["iOS"])
    plan = plan_of(kpis.total_sessions(stored, flt), capsys)
    facts = re.search(r"PartitionFilters: \[(.*?)\]\n", plan)
    assert ">= 2024-01-02" in facts[1] and "<= 2024-01-03" in facts[1]
    assert "ReadSchema: struct<player_id:string>" in plan
    assert "PushedFilters: [In(platform, [iOS])" in plan or "EqualTo(platform,iOS)" in plan


def test_retention_reads_facts_once_and_only_as_far_as_needed(stored, capsys):
    plan = plan_of(retention.retention(stored, PlayerFilter("2024-01-01", "2024-01-02")), capsys)
    assert plan.count("(1) Scan parquet") == 1 and plan.count("Location:") == 1
    assert "<= 2024-01-09" in plan
    # By player and block of days, by player, by cohort, and the final sort.
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 4


def test_kpi_rows_scan_each_table_once(stored, capsys):
    for report in (kpis.executive_kpis, kpis.monetization_kpis):
        assert plan_of(report(stored, RANGE), capsys).count("Location:") == 3


def test_top_k_keeps_only_k_rows_per_task(stored, capsys):
    assert "TakeOrderedAndProject" in plan_of(trends.top_countries(stored, RANGE), capsys)


def test_facts_are_folded_before_they_meet_the_players(stored, no_broadcast, capsys):
    """The hot player reaches the join as one row, however many sessions it has."""
    for report in (kpis.total_sessions, kpis.executive_kpis, trends.dau_trend, trends.duration_distribution):
        plan = plan_of(report(stored, RANGE), capsys)
        tree = plan.split("\n\n")[0]
        join, scan = tree.index("SortMergeJoin"), tree.index("Scan parquet")
        between = tree[join:scan]
        # Active days are folded by player and block first, so short rows move on to the join.
        moves = 2 if report is trends.dau_trend else 1
        assert between.count("HashAggregate") == 2 and between.count("Exchange") == moves


def _moves(plan: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.M))


def test_platform_report_moves_each_thing_once(stored, no_broadcast, capsys):
    plan = plan_of(platforms.platform_metrics(stored, RANGE), capsys)
    # Sessions: once for the ids that repeat, once for everything else.
    assert len(re.findall(r"Location:.*fact_sessions", plan)) == 2
    # Ids, the cells of their filter; activity by player and id, then by player; the dimension;
    # the result by platform and id, by platform, and the sort.
    assert _moves(plan) == 8
    assert len(re.findall(r"Location:.*fact_purchases", plan)) == 1
    unique = plan_of(platforms.platform_metrics(stored, RANGE, unique_session_ids=True), capsys)
    # Both facts once, the dimension once; then activity and dimension by player, the
    # result by platform, and the sort.
    assert unique.count("Location:") == 3 and _moves(unique) == 4


def test_shares_read_what_they_show(stored, no_broadcast, capsys):
    players = plan_of(shares.platform_share(stored, RANGE), capsys)
    assert "fact_" not in players and "rangepartitioning" not in players
    revenue = plan_of(shares.platform_share(stored, RANGE, "revenue"), capsys)
    assert "session_id" not in revenue and "duration_minutes" not in revenue


def test_revenue_slices_move_each_purchase_once(stored, no_broadcast, capsys):
    for report in (trends.revenue_trend, monetization.item_revenue):
        plan = plan_of(report(stored, RANGE), capsys)
        # Purchases and players to the join, the few groups, and the sort.
        assert plan.count("Location:") == 2 and _moves(plan) == 4


def test_row_level_join_splits_the_hot_player(spark, stored, no_broadcast):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = selection.filtered_sessions(stored, RANGE)
        assert len(df.collect()) == 12_000
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        counts = {row[0]: row[1:3] for row in values(platforms.platform_metrics(stored, RANGE))}
        assert counts == {"iOS": (251, 8000), "Web": (250, 4000)}
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_bucketed_players_are_not_shuffled(spark, no_broadcast, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    save_warehouse(many_sessions(spark), "bucketed", player_buckets=4)
    report = kpis.total_sessions(load_warehouse(spark, "bucketed"), RANGE)
    plan = plan_of(report, capsys)
    # Only the folded sessions and the one-row result move.
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 2
    assert values(report) == [(12_000,)]
