"""Every report against the direct SQL in DuckDB: test tables and random awkward ones."""

import random

import duckdb
import oracle
import pytest
from playpulse.filters import PlayerFilter
from support import assert_matches, day, make_duckdb, make_tables, reports

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def test_tables():
    con = duckdb.connect()
    for table in ("customer", "nation", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry.REPORTS) == set(registry.oracle_sql()) & set(registry.REPORTS)


@pytest.mark.parametrize("name", sorted(registry.REPORTS))
def test_query_on_test_tables(spark, test_tables, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert_matches(name, df, test_tables, registry.oracle_sql()[name])


@pytest.mark.parametrize(
    "name", sorted(n for n in registry.queries() if n.startswith(("stored_", "maintained_")))
)
def test_stored_query_on_test_tables(spark, test_tables, name):
    df = registry.queries()[name](spark, SF_DIR)
    assert_matches(name, df, test_tables, registry.oracle_sql()[name])


def test_entry_is_the_retention_report(spark):
    df = registry.entry(spark)
    assert df.columns[:2] == ["first_session_date", "cohort_size"]
    assert df.count() > 0


def random_rows(seed: int) -> dict:
    """Repeated and missing keys, orphans, repeated session ids, missing values, one busy player."""
    rng = random.Random(seed)
    ids = [f"P{i}" for i in range(30)]
    known = [*ids, *rng.sample(ids, 4), None, None]

    def anyone():
        return "P0" if rng.random() < 0.33 else rng.choice([*ids, "ghost", None])

    def some_day():
        return None if rng.random() < 0.03 else day(rng.randint(1, 28))

    def amount(top):
        return None if rng.random() < 0.05 else round(rng.uniform(0, top), 2)

    return {
        "players": [
            (pid, rng.choice(["DE", "NA", "FR", "US", None]), rng.choice(["iOS", "Android", "Web", None]))
            for pid in known
        ],
        "sessions": [
            (rng.choice([f"S{i}", f"S{i}", f"S{rng.randint(0, 9)}", None]), anyone(), some_day(), amount(90))
            for i in range(400)
        ],
        "purchases": [
            (rng.choice([f"B{i}", None]), anyone(), some_day(), rng.choice(["bundle", "cosmetic", None]), amount(50))
            for i in range(120)
        ],
    }


@pytest.mark.parametrize(
    ("seed", "platforms"), [(1, ["iOS", "Web"]), (2, None), (3, ["Android"]), (4, [])]
)
def test_random_tables(spark, seed, platforms):
    rows = random_rows(seed)
    lo, hi = "2024-01-05", "2024-01-19"
    flt, cohorts = PlayerFilter(lo, hi, platforms), PlayerFilter("2024-01-02", hi)
    tables, con = make_tables(spark, **rows), make_duckdb(**rows)
    for frame in tables.named().values():
        frame.cache()
    sql = oracle.bodies(lo, hi, platforms, ("2024-01-02", hi))
    for name, report in reports(flt, cohorts).items():
        assert_matches(name, report(tables), con, sql[name])
