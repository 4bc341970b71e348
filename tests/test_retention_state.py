"""Maintained retention state: refreshed by date, equal to what all sessions say."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from playpulse.filters import PlayerFilter
from playpulse.operators import retention
from playpulse.schema import Tables
from playpulse.sources.retention_state import open_state, refresh
from playpulse.sources.versions import Versions
from playpulse.sources.warehouse import current_folder, read_warehouse, write_warehouse
from support import make_tables, values
from test_warehouse import JOB_FAILURE

START = date(2024, 1, 1)
RANGES = [
    (PlayerFilter("2024-01-01", "2024-12-31"), (1, 3, 7)),
    (PlayerFilter("2024-02-20", "2024-03-20"), (0, 64, 200)),
    (PlayerFilter("2023-12-20", "2024-01-03"), (1, 30)),
    (PlayerFilter("2025-01-01", "2025-12-31"), (1,)),
    (PlayerFilter("2024-03-02", "2024-03-01"), (1,)),
]


def some_sessions(seed, days, n=300, players=40):
    rng = random.Random(seed)
    ids = [*(f"P{i}" for i in range(players)), None]
    return [(f"S{i}", rng.choice(ids), rng.choice(days), 1.0) for i in range(n)]


def on(*offsets):
    return [START + timedelta(d) for d in offsets]


class Game:
    """A warehouse, its state, and the sessions they should show."""

    def __init__(self, spark, path):
        self.spark, self.warehouse, self.state = spark, f"{path}/warehouse", f"{path}/state"

    def load(self, sessions, spoil_but=None):
        """Store the sessions; of all days but these no file can be read any more."""
        write_warehouse(make_tables(self.spark, sessions=sessions), self.warehouse)
        self.truth = make_tables(self.spark, sessions=sessions)
        if spoil_but is not None:
            folder = Path(current_folder(self.spark, self.warehouse), "fact_sessions")
            kept = {f"session_date={day or '__HIVE_DEFAULT_PARTITION__'}" for day in spoil_but}
            for file in folder.rglob("*.parquet"):
                if file.parent.name not in kept:
                    file.write_bytes(b"x" * file.stat().st_size)

    def check(self, ranges=RANGES[:2]):
        state = refresh(read_warehouse(self.spark, self.warehouse), self.state)
        assert sorted(values(retention.player_first_day(state)), key=str) == sorted(
            values(retention.player_first_day(self.truth)), key=str
        )
        for flt, days in ranges:
            want = values(retention.retention_counts(self.truth, flt, days))
            assert values(retention.retention_counts(state, flt, days)) == want
        return state


@pytest.fixture()
def game(spark, tmp_path):
    return Game(spark, str(tmp_path))


def test_a_later_day_is_all_that_is_read(game):
    first = some_sessions(1, on(0, 1, 2, 3, 60, 61, 68, 70))
    game.load(first)
    before = game.check()
    more = [("N1", "P1", START + timedelta(71), 1.0), ("N2", "new", START + timedelta(71), 1.0)]
    game.load(first + more, spoil_but=on(71))
    after = game.check(RANGES)
    # Earlier blocks stay in the folders in which they were first written.
    old = {b: f for b, f in before.commit["blocks"].items() if b != max(before.commit["blocks"])}
    assert old and all(after.commit["blocks"][b] == f for b, f in old.items())
    with pytest.raises(JOB_FAILURE):
        read_warehouse(game.spark, game.warehouse).sessions.collect()


def test_without_changes_nothing_is_read_or_written(game):
    sessions = some_sessions(2, on(0, 1, 2))
    game.load(sessions)
    game.check()
    numbers = Versions(game.spark, game.state).numbers()
    game.load(sessions[::-1], spoil_but=[])  # a rebuild of the same rows in another order
    game.check()
    assert Versions(game.spark, game.state).numbers() == numbers


def test_late_replaced_and_removed_days(game):
    days = on(0, 2, 4, 63, 64, 128, 200)
    sessions = some_sessions(3, days)
    game.load(sessions)
    game.check()
    late = some_sessions(4, on(1, 3), 20, 60)  # earlier first days
    game.load(sessions + late, spoil_but=on(1, 3))
    game.check()
    replaced = [s for s in sessions + late if s[2] != START] + some_sessions(5, on(0), 9, 90)
    game.load(replaced, spoil_but=on(0))
    game.check()
    removed = [s for s in replaced if s[2] not in on(2, 63, 200)]
    game.load(removed, spoil_but=[])
    game.check()
    game.load([])
    game.check()


def test_sessions_without_a_day_or_a_player(game):
    sessions = some_sessions(6, [None, *on(0, 5)], 60, 10)
    game.load(sessions)
    game.check()
    more = [*sessions, ("x", "ghost", None, 1.0), ("y", None, START + timedelta(9), 1.0)]
    game.load(more, spoil_but=[None, START + timedelta(9)])
    game.check()
    # A player known only from sessions without a day gets one later.
    game.load([*more, ("z", "ghost", START + timedelta(12), 1.0)], spoil_but=on(12))
    game.check()
    game.load([s for s in more if s[2]], spoil_but=[])
    game.check()


def test_random_histories(game, seed=0):
    rng = random.Random(seed)
    sessions = []
    for step in range(4):
        days = on(*rng.sample(range(step * 20, step * 20 + 40), 3), rng.choice([0, 63, 64, 127, 128]))
        touched = rng.sample(days, 2)
        sessions = [s for s in sessions if s[2] not in touched]
        sessions += some_sessions(seed * 10 + step, days, 40, 25)
        game.load(sessions)
        game.check()


def test_a_report_reads_the_blocks_of_its_range(game, capsys):
    game.load(some_sessions(7, on(0, 1, 5, 60, 64, 130, 200, 299)))
    state = game.check()
    assert len(state.commit["blocks"]) == 5
    capsys.readouterr()
    retention.retention(state, PlayerFilter("2024-03-01", "2024-03-05")).explain("formatted")
    plan = capsys.readouterr().out
    assert "fact_sessions" not in plan and plan.count("part=") == 1
    assert "Join" not in plan and "Window" not in plan


def test_days_before_1970(game):
    old = [date(1969, 12, 31), date(1969, 10, 29), date(1970, 1, 1), date(1900, 1, 1)]
    game.load(some_sessions(8, old, 40, 6))
    state = game.check()
    flt = PlayerFilter("1900-01-01", "1970-02-01")
    assert values(retention.retention_counts(state, flt)) == values(retention.retention_counts(game.truth, flt))


def test_unstored_tables_and_overlapping_refreshes(game):
    game.load(some_sessions(9, on(0, 1)))
    with pytest.raises(ValueError, match="stored"):
        refresh(game.truth, game.state)
    assert open_state(game.spark, game.state) is None
    game.check()
    reader = open_state(game.spark, game.state)
    want = values(retention.retention(reader, RANGES[0][0]))
    game.load(some_sessions(10, on(0, 1, 2)))
    game.check()
    assert values(retention.retention(reader, RANGES[0][0])) == want  # its version is still there
