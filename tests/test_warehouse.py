"""CSV in, star schema out, and back again."""

from datetime import date, datetime
from pathlib import Path

import pytest
from playpulse.filters import PlayerFilter
from playpulse.operators import kpis, quality, retention, selection, trends
from playpulse.schema import RAW_SCHEMAS, WAREHOUSE_SCHEMAS, Tables, empty_tables
from playpulse.sources.raw_csv import read_csv, read_raw, write_csv, write_raw
from playpulse.sources.warehouse import (
    build_dim_players,
    build_tables,
    current_folder,
    load_warehouse,
    read_warehouse,
    save_warehouse,
    write_warehouse,
)
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from support import values

JOB_FAILURE = (PySparkException, Py4JJavaError)
RANGE = PlayerFilter("2024-01-01", "2024-01-31")

PLAYERS = """player_id,registration_date,country,platform,install_source,device_type,player_level
P000000,2023-06-01,NA,iOS,organic,mobile,1
P000001,2023-07-15,DE,Web,"say ""hi"", there",desktop,1
P000002,,,Android,google,tablet,1
"""
SESSIONS = """session_id,player_id,session_start,session_end,duration_minutes,levels_completed,deaths,items_collected,score
S0,P000000,2024-01-05 23:50:00,2024-01-06 00:10:00,20,1,2,3,400
S1,P000001,2024-01-05 08:00:00.123456,2024-01-05 08:03:00,3,0,0,5,100
S2,P000000,2024-01-06 09:00:00,2024-01-06 10:30:00,90,5,9,50,9999
"""
PURCHASES = """purchase_id,player_id,session_id,purchase_time,item_type,item_name,price_usd,currency,platform
B0,P000000,S0,2024-01-06 00:05:00,bundle,bundle_7,49.99,USD,Web
"""


@pytest.fixture()
def raw_dir(tmp_path):
    for name, text in (("players", PLAYERS), ("sessions", SESSIONS), ("purchases", PURCHASES)):
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def rows(tables: Tables) -> dict[str, list]:
    return {
        name: sorted(values(df.drop("loaded_at")), key=str) for name, df in tables.named().items()
    }


def many_sessions(spark, hot_share: int = 3) -> Tables:
    """12,000 sessions on eight days in twelve splits: a third on one day, a third by one player."""
    ids = spark.range(0, 12_000, 1, 12)
    sessions = ids.selectExpr(
        "cast(id as string) session_id",
        f"if(id % {hot_share} = 0, 'hot', concat('p', id % 500)) player_id",
        f"timestamp_ntz'2024-01-01 10:00:00' + make_interval(0,0,0, cast(if(id % {hot_share} = 1, 3, id % 8) as int)) "
        "session_start",
        "cast(null as timestamp_ntz) session_end",
        "id % 100 duration_minutes",
        "1L levels_completed",
        "1L deaths",
        "1L items_collected",
        "id score",
    )
    players = spark.range(500).selectExpr(
        "concat('p', id) player_id",
        "'2023-01-01' registration_date",
        "'DE' country",
        "if(id % 2 = 0, 'iOS', 'Web') platform",
        "'x' install_source",
        "'y' device_type",
        "1L player_level",
    )
    hot = players.limit(1).selectExpr("'hot' player_id", *players.columns[1:])
    raw = empty_tables(spark, RAW_SCHEMAS)
    return build_tables(Tables(players.union(hot), sessions, raw.purchases))


def test_build_types_and_values(spark, raw_dir):
    built = build_tables(read_raw(spark, raw_dir))
    for name, df in built.named().items():
        assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in WAREHOUSE_SCHEMAS[name]}
        assert df.columns == WAREHOUSE_SCHEMAS[name].fieldNames()
    players = {row.player_id: row for row in built.players.collect()}
    assert players["P000000"].country == "NA"
    assert players["P000001"].install_source == 'say "hi", there'
    assert players["P000002"].country is None and players["P000002"].registration_date is None
    first = built.sessions.filter("session_id = 'S0'").head()
    assert first.session_date == date(2024, 1, 5)
    assert first.session_end == datetime(2024, 1, 6, 0, 10)
    assert built.purchases.head().purchase_date == date(2024, 1, 6)


def test_inferred_types_give_the_same_tables(spark, raw_dir):
    assert rows(build_tables(read_raw(spark, raw_dir, infer=True))) == rows(
        build_tables(read_raw(spark, raw_dir))
    )


def test_csv_round_trip_keeps_values_whole(spark, raw_dir, tmp_path):
    raw = read_raw(spark, raw_dir)
    write_raw(raw, str(tmp_path / "copy"))
    again = read_raw(spark, str(tmp_path / "copy"))
    for name, df in raw.named().items():
        assert sorted(values(df), key=str) == sorted(values(again.named()[name]), key=str)

    text = spark.createDataFrame(
        [(" padded ", "back\\slash", datetime(2024, 1, 5, 8, 0, 0, 123456)), (None, None, None)],
        "a string, b string, t timestamp_ntz",
    )
    write_csv(text, str(tmp_path / "odd"))
    back = read_csv(spark, str(tmp_path / "odd"), "a string, b string, t timestamp_ntz")
    assert sorted(values(back), key=str) == sorted(values(text), key=str)


def test_bad_input_raises(spark, raw_dir, tmp_path):
    bad_number = tmp_path / "bad_number.csv"
    bad_number.write_text(SESSIONS.replace(",20,", ",twenty,"))
    with pytest.raises(JOB_FAILURE):
        read_csv(spark, str(bad_number), RAW_SCHEMAS["sessions"]).collect()

    swapped = tmp_path / "swapped.csv"
    swapped.write_text(PLAYERS.replace("country,platform", "platform,country"))
    with pytest.raises(JOB_FAILURE):
        read_csv(spark, str(swapped), RAW_SCHEMAS["players"]).collect()

    raw = read_raw(spark, raw_dir)
    broken = Tables(raw.players.replace("2023-06-01", "June"), raw.sessions, raw.purchases)
    with pytest.raises(JOB_FAILURE):
        build_dim_players(broken).collect()
    lenient = build_dim_players(broken, strict=False).filter("player_id = 'P000000'").head()
    assert lenient.registration_date is None and lenient.country == "NA"


def test_reports_survive_the_round_trip(spark, raw_dir, tmp_path):
    built = build_tables(read_raw(spark, raw_dir))
    path = str(tmp_path / "warehouse")
    write_warehouse(built, path)
    opened = read_warehouse(spark, path)
    assert rows(opened) == rows(built)
    for name, df in opened.named().items():
        assert df.schema == WAREHOUSE_SCHEMAS[name]
    assert values(quality.warehouse_summary(opened)) == [(3, 3, 1, 49.99, pytest.approx(113 / 3))]
    assert values(kpis.executive_kpis(opened, RANGE)) == [(2, 3, 49.99, 49.99)]
    assert values(retention.retention(opened, RANGE)) == [(date(2024, 1, 5), 2, 50.0, 0.0, 0.0)]


def test_rebuild_replaces_everything(spark, raw_dir, tmp_path):
    built = build_tables(read_raw(spark, raw_dir))
    path = str(tmp_path / "warehouse")
    write_warehouse(built, path)
    write_warehouse(built, path)
    assert rows(read_warehouse(spark, path)) == rows(built)

    # A later load without some day must not keep it, whatever the session says.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        later = built.sessions.filter("session_date > date'2024-01-05'")
        write_warehouse(Tables(built.players, later, built.purchases), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert read_warehouse(spark, path).sessions.count() == 1


def test_missing_start_keeps_the_session(spark, raw_dir, tmp_path):
    raw = read_raw(spark, raw_dir)
    cleared = raw.sessions.replace("2024-01-06 09:00:00", None, "session_start")
    built = build_tables(Tables(raw.players, cleared, raw.purchases))
    write_warehouse(built, str(tmp_path / "warehouse"))
    opened = read_warehouse(spark, str(tmp_path / "warehouse"))
    assert rows(opened) == rows(built)
    assert values(kpis.total_sessions(opened, RANGE)) == [(2,)]
    assert values(quality.warehouse_summary(opened))[0][1] == 3


def test_empty_warehouse_opens(spark, tmp_path):
    path = str(tmp_path / "warehouse")
    write_warehouse(empty_tables(spark), path)
    opened = read_warehouse(spark, path)
    assert values(quality.empty_table_check(opened)) == [("sessions", 0, True), ("purchases", 0, True)]
    assert values(selection.date_bounds(opened)) == [(None, None)]


def test_a_busy_day_is_split_over_tasks(spark, tmp_path):
    # Sizes at which AQE leaves ranges of this small table apart.
    small = [
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize",
    ]
    for name in small:
        spark.conf.set(name, "20k")
    try:
        path = str(tmp_path / "warehouse")
        built = many_sessions(spark)
        write_warehouse(built, path)
    finally:
        for name in small:
            spark.conf.unset(name)
    facts = Path(current_folder(spark, path)) / "fact_sessions"
    files = {d.name: len(list(d.glob("part-*"))) for d in facts.glob("session_date=*")}
    assert len(files) == 8
    assert files["session_date=2024-01-04"] > 1
    # Each file is ordered by player, which is what lets row groups be skipped.
    hot_file = next((facts / "session_date=2024-01-04").glob("part-*"))
    players = [row.player_id for row in spark.read.parquet(str(hot_file)).collect()]
    assert players == sorted(players)
    assert rows(read_warehouse(spark, path)) == rows(built)


def test_catalog_tables(spark):
    built = many_sessions(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS play")
    for buckets in (None, 3):
        save_warehouse(built, "play", player_buckets=buckets)
        opened = load_warehouse(spark, "play")
        assert rows(opened) == rows(built)
    assert values(kpis.total_sessions(opened, RANGE)) == [(12_000,)]
    assert values(trends.dau_trend(opened, RANGE))[0][0] == date(2024, 1, 1)


def test_files_cover_disjoint_players(spark, tmp_path):
    """A day's files, and the players', do not overlap; a hot (day, player) is still split."""
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_warehouse(many_sessions(spark), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tables = read_warehouse(spark, str(tmp_path))
    players = tables.players.select(F.lit(1).alias("day"), "player_id", F.input_file_name().alias("file"))
    sessions = tables.sessions.select(
        F.col("session_date").alias("day"), "player_id", F.input_file_name().alias("file")
    )
    for df in (players, sessions):
        files = (
            df.groupBy("day", "file")
            .agg(F.min("player_id").alias("low"), F.max("player_id").alias("high"))
            .orderBy("day", "low", "high")
            .collect()
        )
        for a, b in zip(files, files[1:]):
            assert a.day != b.day or a.high <= b.low
    # A player lookup opens one file of the players, and of each day the few that can have it.
    assert players.where("player_id = 'p77'").select("file").distinct().count() == 1
    opened = sessions.where("player_id = 'p77'").groupBy("day").agg(F.count_distinct("file").alias("n"))
    assert opened.agg(F.max("n")).first()[0] == 1


def test_a_busy_player_of_a_day_is_split(spark, tmp_path):
    """A third of all rows on one day and by one player: ids tell the ranges apart."""
    from pyspark.sql import functions as F

    t = many_sessions(spark)
    one = t.sessions.withColumn("session_date", F.lit("2024-01-04").cast("date")).withColumn(
        "player_id", F.lit("hot")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_warehouse(Tables(t.players, one, t.purchases), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    day = Path(current_folder(spark, str(tmp_path))) / "fact_sessions" / "session_date=2024-01-04"
    assert len(list(day.glob("part-*"))) == 4  # as many as there are shuffle partitions


def test_csv_with_another_separator(spark, tmp_path):
    path = str(tmp_path / "other.csv")
    with open(path, "w") as f:
        f.write("a;b\n1;x\n2;y\n")
    rows = read_csv(spark, path, sep=";")
    assert rows.columns == ["a", "b"] and [tuple(r) for r in rows.orderBy("a").collect()] == [(1, "x"), (2, "y")]
