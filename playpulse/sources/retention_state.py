"""Maintained state for retention: who was active on which day, kept up date by date.

Cohort retention depends on all history, for the first day of a player may lie long before
the range that is asked for. The state spares reading it again: a row for each player and
block of 64 days with the days as bits and the player's first day beside them, stored by
block. A report on a range reads the blocks of that range alone, and groups without moving
rows by player. A refresh compares the content numbers in the statistics of a stored
warehouse with those it has seen, and reads the sessions of dates that are new, changed or
gone, nothing else.

Stored under a path of its own, in versions: ``bits`` by block, ``firsts`` (one row for each
player) and ``days`` (what is included). A refresh that only adds later days, the daily case,
writes the blocks of those days anew and leaves the others where they are. A late or replaced
day may change first days anywhere, so then all blocks are written, from the state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playpulse.filters import PlayerFilter, date_literal
from playpulse.functions.day_bits import BLOCK_DAYS, active_bits, block_of
from playpulse.plans.rollups import KEY
from playpulse.schema import Tables
from playpulse.sources.versions import Versions

#: The block of sessions without a date. They give a player no day.
NO_DAY = -(2**31)
_LOWEST = -(2**63)
KEPT_VERSIONS = 2


def _first_bit(block: Column, bits: Column) -> Column:
    """The earliest day of a row."""
    # The lowest bit less one has as many bits as places lie below it.
    place = F.when(bits == F.lit(_LOWEST), F.lit(BLOCK_DAYS - 1)).otherwise(
        F.bit_count(bits.bitwiseAND(-bits) - F.lit(1))
    )
    day = F.date_from_unix_date(block * BLOCK_DAYS + place)
    return F.when(block != NO_DAY, day)


def _folded(sessions: DataFrame) -> DataFrame:
    """(player, block, bits) of sessions."""
    day = F.col("session_date")
    dated = sessions.groupBy(KEY, F.coalesce(block_of(day), F.lit(NO_DAY)).alias("block"))
    bits = F.coalesce(active_bits(day), F.lit(1).cast("bigint"))
    return dated.agg(bits.alias("bits"))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(KEY, "block").agg(F.bit_or("bits").alias("bits"))


def _block_number(day: date | None) -> int:
    if day is None:
        return NO_DAY
    return (day.toordinal() - date(1970, 1, 1).toordinal()) // BLOCK_DAYS


def _mask(days: Sequence[date | None]) -> int:
    """The bits of days of one block, as a signed 64-bit number."""
    if days == [None]:
        return 1
    epoch = date(1970, 1, 1).toordinal()
    bits = sum(1 << (day.toordinal() - epoch) % BLOCK_DAYS for day in days)
    return bits - (1 << 64) if bits >= 1 << 63 else bits


@dataclass(frozen=True)
class RetentionState:
    """One version of the state. The frames read the files of the blocks they need."""

    spark: SparkSession
    path: str
    commit: dict

    def _schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(self.commit["schemas"][name])

    def days(self) -> DataFrame:
        return self.spark.read.schema(self._schema("days")).parquet(f"{self.path}/{self.commit['days']}")

    def firsts(self) -> DataFrame:
        """(player, first) of every player with a session, the null player included."""
        return self.spark.read.schema(self._schema("firsts")).parquet(
            f"{self.path}/{self.commit['firsts']}"
        )

    def bits(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """(player, block, bits, first) of the blocks from ``low`` to ``high``."""
        folders = [
            f"{self.path}/{folder}"
            for block, folder in self.commit["blocks"].items()
            if (low is None or int(block) >= low) and (high is None or int(block) <= high)
        ]
        schema = self._schema("bits")
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)


def open_state(spark: SparkSession, path: str) -> RetentionState | None:
    commit = Versions(spark, path).latest()
    return RetentionState(spark, path.rstrip("/"), commit) if commit else None


def _changes(state: RetentionState | None, now: DataFrame) -> list[tuple[date | None, bool, bool]]:
    """(day, seen before, there now) of dates whose content is not what the state has.

    One short row for each such date reaches the driver, however many sessions it has.
    """
    if state is None:
        return [(row.day, False, True) for row in now.select("day").collect()]
    then = state.days().select(F.col("day").alias("of_day"), F.col("content").alias("seen"))
    both = now.join(then, F.col("day").eqNullSafe(F.col("of_day")), "full")
    changed = both.where(~F.col("content").eqNullSafe(F.col("seen")))
    rows = changed.select(
        F.coalesce("day", "of_day").alias("day"),
        F.col("seen").isNotNull().alias("before"),
        F.col("content").isNotNull().alias("after"),
    )
    return [(row.day, row.before, row.after) for row in rows.collect()]


def _on(days: Sequence[date | None], column: str) -> Column:
    """Whether a date is one of the days; literals, so that a scan skips the others."""
    named = [date_literal(day) for day in days if day is not None]
    found = F.col(column).isin(named) if named else F.lit(False)
    return found | F.col(column).isNull() if None in days else found


def refresh(tables: Tables, path: str, *, keep: int = KEPT_VERSIONS) -> RetentionState:
    """Bring the state under ``path`` up to the stored tables, and return it.

    Reads the sessions of dates that are not in the state as they are now. Raises where the
    tables have no up-to-date statistics.
    """
    spark = tables.sessions.sparkSession
    stats = tables.statistics()
    if stats is None:
        raise ValueError("the tables are not stored, or their statistics are stale: write them anew")
    state = open_state(spark, path)
    now = stats.where((F.col("table_name") == "sessions") & (F.col("n_rows") > 0)).select("day", "content")
    changes = _changes(state, now)
    if state is not None and not changes:
        return state

    days = [day for day, _, _ in changes]
    if state is None:
        sessions = tables.sessions
    else:
        sessions = tables.sessions.where(_on([day for day, _, there in changes if there], "session_date"))
    delta = _folded(sessions.select(KEY, "session_date"))

    blocks: dict[int, list[date | None]] = {}
    for day in days:
        blocks.setdefault(_block_number(day), []).append(day)
    known = {int(b): folder for b, folder in state.commit["blocks"].items()} if state else {}
    last = state.commit["last_day"] if state else None
    adds_only = not any(before for _, before, _ in changes) and None not in days
    later = adds_only and (last is None or min(days).isoformat() > last)
    if state is None:
        bits = delta
        firsts = _firsts(bits)
    elif later:
        old = _only(state, blocks)
        bits = _merged(old.unionByName(delta))
        firsts = state.firsts().unionByName(_firsts(delta)).groupBy(KEY).agg(F.min("first").alias("first"))
    else:
        old = state.bits().select(KEY, "block", "bits")
        gone = F.lit(0).cast("bigint")
        for block, of_block in blocks.items():
            gone = F.when(F.col("block") == block, F.lit(_mask(of_block))).otherwise(gone)
        left = old.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(gone)))
        bits = _merged(left.where(F.col("bits") != 0).unionByName(delta))
        firsts = _firsts(bits)
        known = {}
    return _store(spark, path, state, bits, firsts, now, known, keep)


def _only(state: RetentionState, blocks: dict) -> DataFrame:
    folders = {block: state.commit["blocks"].get(str(block)) for block in blocks}
    some = RetentionState(
        state.spark, state.path, state.commit | {"blocks": {b: f for b, f in folders.items() if f}}
    )
    return some.bits().select(KEY, "block", "bits")


def _firsts(bits: DataFrame) -> DataFrame:
    return bits.groupBy(KEY).agg(F.min(_first_bit(F.col("block"), F.col("bits"))).alias("first"))


def _store(
    spark: SparkSession,
    path: str,
    state: RetentionState | None,
    bits: DataFrame,
    firsts: DataFrame,
    days: DataFrame,
    known: dict[int, str],
    keep: int,
) -> RetentionState:
    versions = Versions(spark, path)
    number, name = versions.new_folder()
    folder = f"{versions.path}/{name}"
    try:
        firsts.write.parquet(f"{folder}/firsts")
        stored = spark.read.schema(firsts.schema).parquet(f"{folder}/firsts")
        of_player = stored.select(F.col(KEY).alias("of"), "first")
        rows = bits.join(of_player, F.col(KEY).eqNullSafe(F.col("of")), "left").drop("of")
        (
            rows.withColumn("part", F.col("block"))
            .repartitionByRange("part", KEY)
            .sortWithinPartitions("part", KEY)
            .write.partitionBy("part")
            .parquet(f"{folder}/bits")
        )
        days.coalesce(1).write.parquet(f"{folder}/days")
        written = spark.read.schema(days.schema).parquet(f"{folder}/days")
        found = written.agg(F.max("day")).first()[0]
        fresh = spark.read.schema(rows.schema).parquet(f"{folder}/bits").select("block").distinct()
        blocks = known | {row.block: f"{name}/bits/part={row.block}" for row in fresh.collect()}
        document = {
            "folders": sorted({name, *(f.split("/")[0] for f in blocks.values())}),
            "blocks": {str(block): f for block, f in blocks.items()},
            "firsts": f"{name}/firsts",
            "days": f"{name}/days",
            "last_day": found.isoformat() if found else None,
            "schemas": {
                "bits": rows.schema.jsonValue(),
                "firsts": firsts.schema.jsonValue(),
                "days": days.schema.jsonValue(),
            },
        }
        versions.commit(number, document, keep)
    except BaseException:
        versions.delete([name])
        raise
    return RetentionState(spark, versions.path, document)


def blocks_of(flt: PlayerFilter, days: Sequence[int]) -> tuple[int, int]:
    """The blocks that the cohorts of a range and their returns lie in."""
    epoch = date(1970, 1, 1).toordinal()
    low = (flt.date_from.toordinal() - epoch) // BLOCK_DAYS
    return low, (flt.date_to.toordinal() - epoch + max(days)) // BLOCK_DAYS
