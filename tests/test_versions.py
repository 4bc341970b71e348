"""Rebuilds that fail or overlap, statistics instead of scans, and lookups of one player."""

import json
from datetime import date
from pathlib import Path

import pytest
from playpulse.operators import quality, selection
from playpulse.schema import Tables, empty_tables
from playpulse.sources.versions import Versions
from playpulse.sources.warehouse import current_folder, load_warehouse, read_warehouse, save_warehouse, write_warehouse
from pyspark.sql import functions as F
from support import day, make_tables, values
from test_warehouse import JOB_FAILURE, many_sessions, rows

PLAYERS = [("a", "DE", "iOS"), ("b", "FR", "Web")]
SESSIONS = [("s1", "a", day(5), 4.0), ("s2", "b", day(6), None), ("s3", None, None, 6.0)]
PURCHASES = [("b1", "a", day(6), "bundle", 0.1), ("b2", "a", day(6), "bundle", 0.2)]


@pytest.fixture()
def tables(spark):
    return make_tables(spark, PLAYERS, SESSIONS, PURCHASES)


def fails(df):
    """The same rows, but computing them raises."""
    return df.withColumn("player_id", F.raise_error(F.lit("disk full")).cast("string"))


def test_a_failed_write_leaves_the_old_tables(spark, tables, tmp_path):
    path = str(tmp_path)
    write_warehouse(tables, path)
    opened, before = read_warehouse(spark, path), current_folder(spark, path)
    for broken in (
        Tables(tables.players.limit(1), tables.sessions, fails(tables.purchases)),
        Tables(tables.players.limit(1), fails(tables.sessions), tables.purchases),
    ):
        with pytest.raises(JOB_FAILURE):
            write_warehouse(broken, path)
    assert current_folder(spark, path) == before
    for t in (opened, read_warehouse(spark, path)):
        assert {n: df.count() for n, df in t.named().items()} == {"players": 2, "sessions": 3, "purchases": 2}
    assert [d.name for d in tmp_path.glob("v*")] == [Path(before).name]  # nothing half-written stays


def test_a_reader_keeps_its_version_and_old_ones_go(spark, tables, tmp_path):
    path = str(tmp_path)
    write_warehouse(tables, path)
    reader = read_warehouse(spark, path)
    write_warehouse(Tables(tables.players, tables.sessions.limit(0), tables.purchases), path)
    assert reader.sessions.count() == 3  # still there while a new version is current
    assert read_warehouse(spark, path).sessions.count() == 0
    write_warehouse(tables, path)
    write_warehouse(tables, path)
    assert len(list(tmp_path.glob("v*"))) == 2
    assert Versions(spark, path).numbers() == [3, 4]
    assert read_warehouse(spark, path).sessions.count() == 3


def test_of_two_loads_at_a_time_one_raises(spark, tables, tmp_path):
    versions = Versions(spark, str(tmp_path))
    number, folder = versions.new_folder()
    write_warehouse(tables, str(tmp_path))
    with pytest.raises(RuntimeError, match="taken"):
        versions.commit(number, {"folders": [folder]}, 2)
    assert current_folder(spark, str(tmp_path)) is not None
    assert read_warehouse(spark, str(tmp_path)).sessions.count() == 3


def test_readers_ignore_a_commit_that_is_not_in_place(spark, tables, tmp_path):
    path = str(tmp_path)
    write_warehouse(tables, path)
    (tmp_path / "_commits" / ".half.tmp").write_text('{"folders": ["v2-')
    (tmp_path / "v2-00000000").mkdir()
    assert read_warehouse(spark, path).sessions.count() == 3
    commit = json.loads((tmp_path / "_commits" / f"{1:020d}.json").read_text())
    assert commit["version"] == 1 and len(commit["folders"]) == 1


def test_catalog_rebuild_shows_old_tables_until_the_views_turn(spark, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions")
    save_warehouse(tables, "versions")
    with pytest.raises(JOB_FAILURE):
        save_warehouse(Tables(tables.players, tables.sessions.limit(1), fails(tables.purchases)), "versions")
    assert spark.table("versions.fact_sessions").count() == 3
    reader = spark.table("versions.fact_sessions")
    save_warehouse(Tables(tables.players, tables.sessions.limit(1), tables.purchases), "versions")
    assert spark.table("versions.fact_sessions").count() == 1 and reader.count() == 3
    for _ in range(3):
        save_warehouse(tables, "versions")
    assert len(spark.catalog.listTables("versions", "fact_sessions__*")) <= 2
    assert spark.table("versions.fact_sessions").count() == 3


def spoil(folder, names=("dim_players", "fact_sessions", "fact_purchases")):
    """Data files that nobody can read, with the names and sizes they had."""
    for name in names:
        for file in Path(folder, name).rglob("*.parquet"):
            file.write_bytes(b"x" * file.stat().st_size)


REPORTS = (quality.warehouse_summary, quality.empty_table_check, selection.date_bounds)


def test_statistics_answer_without_opening_a_data_file(spark, tables, tmp_path):
    path = str(tmp_path)
    write_warehouse(tables, path)
    opened = read_warehouse(spark, path)
    spoil(current_folder(spark, path))
    want = [
        [(2, 3, 2, 0.3, 5.0)],
        [("sessions", 3, False), ("purchases", 2, False)],
        [(date(2024, 1, 5), date(2024, 1, 6))],
    ]
    assert [values(report(opened)) for report in REPORTS] == want
    with pytest.raises(JOB_FAILURE):
        opened.sessions.collect()
    assert [values(report(tables)) for report in REPORTS] == want


def test_profile_of_a_stored_warehouse_reads_payers_only(spark, tables, tmp_path):
    path = str(tmp_path)
    write_warehouse(tables, path)
    opened = read_warehouse(spark, path)
    want = values(quality.raw_profile(tables))
    spoil(current_folder(spark, path), ["dim_players", "fact_sessions"])
    assert values(quality.raw_profile(opened)) == want


@pytest.mark.parametrize("sessions", [[], [("s1", "a", None, 1.0)]])
def test_bounds_without_a_day(spark, tmp_path, sessions):
    write_warehouse(make_tables(spark, PLAYERS, sessions), str(tmp_path))
    opened = read_warehouse(spark, str(tmp_path))
    assert opened.statistics() is not None
    assert values(selection.date_bounds(opened)) == [(None, None)]
    assert values(quality.empty_table_check(opened))[0] == ("sessions", len(sessions), not sessions)


def test_statistics_of_no_rows_at_all(spark, tmp_path):
    write_warehouse(empty_tables(spark), str(tmp_path))
    opened = read_warehouse(spark, str(tmp_path))
    assert opened.statistics() is not None
    assert values(quality.warehouse_summary(opened)) == [(0, 0, 0, 0.0, 0.0)]


def test_stale_statistics_are_noticed(spark, tables, tmp_path):
    path = str(tmp_path)
    write_warehouse(tables, path)
    opened, folder = read_warehouse(spark, path), Path(current_folder(spark, path))
    assert opened.statistics() is not None
    file = next((folder / "fact_sessions" / "session_date=2024-01-05").glob("*.parquet"))
    late = folder / "fact_sessions" / "session_date=2024-02-01"
    late.mkdir()
    (late / "part-late.parquet").write_bytes(file.read_bytes())
    again = read_warehouse(spark, path)
    assert values(again.stale()) == [("sessions", date(2024, 2, 1))]
    assert again.statistics() is None
    assert values(selection.date_bounds(again)) == [(date(2024, 1, 5), date(2024, 2, 1))]
    assert values(quality.warehouse_summary(again))[0][1] == 4
    file.unlink()
    assert len(values(again.stale())) == 2


def test_any_change_of_a_day_changes_its_content(spark, tables, tmp_path):
    def contents(t, name):
        write_warehouse(t, str(tmp_path / name))
        kept = read_warehouse(spark, str(tmp_path / name)).statistics()
        return {(r.table_name, r.day): r.content for r in kept.collect()}

    one = contents(tables, "one")
    shuffled = Tables(*[df.repartition(3) for df in tables.named().values()])
    assert contents(shuffled, "same") == one
    twice = tables.sessions.where("session_id = 's1'")
    two = contents(Tables(tables.players, tables.sessions.unionAll(twice).unionAll(twice), tables.purchases), "two")
    assert {k for k in one if one[k] != two[k]} == {("sessions", day(5))}


def test_a_players_lookup_skips_the_days_without_it(spark, tmp_path):
    """Sixty days of players whose keys interleave; one player was there on three of them."""
    n_days, n_players = 60, 400
    sessions = spark.range(n_days * n_players).selectExpr(
        "concat('s', id) session_id",
        f"concat('p', lpad(id % {n_players} * 2, 5, '0')) player_id",
        f"date_add(date'2024-01-01', cast(id div {n_players} as int)) session_date",
        "cast(id % 90 as double) duration_minutes",
    )
    rare = spark.createDataFrame(
        [(f"r{i}", "p00401", date(2024, 1, 1 + i), 1.0) for i in (3, 11, 30)], sessions.schema
    )
    none = make_tables(spark)
    write_warehouse(Tables(none.players, sessions.unionAll(rare), none.purchases), str(tmp_path))
    opened = read_warehouse(spark, str(tmp_path))
    found = opened.sessions.where("player_id = 'p00401'")
    assert found.count() == 3
    assert _rows_scanned(opened.sessions.where("player_id = 'p00401'")) <= 5 * (n_players + 1)
    assert _rows_scanned(opened.sessions.where("player_id = 'p99999'")) <= 2 * n_players
    assert _rows_scanned(opened.sessions.where("player_id >= 'p00401'")) == n_days * n_players + 3


def _rows_scanned(df) -> int:
    """Rows in the row groups that a query read: what the scan put out before the filter."""
    frame = df.select("session_id")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scan = leaves.apply(0)
    return int(scan.metrics().apply("numOutputRows").value())


def test_many_rows_survive(spark, tmp_path):
    built = many_sessions(spark)
    write_warehouse(built, str(tmp_path))
    assert rows(read_warehouse(spark, str(tmp_path))) == rows(built)
