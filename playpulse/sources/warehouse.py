"""Star schema: build it from raw tables, store it, open it again."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playpulse.schema import DATE_COLUMNS, TABLE_NAMES, WAREHOUSE_SCHEMAS, Tables
from playpulse.sources import statistics
from playpulse.sources.versions import Versions


def _cast(name: str, kind: str, strict: bool) -> Column:
    value = F.col(name)
    return (value.cast(kind) if strict else value.try_cast(kind)).alias(name)


def _whole(df: DataFrame, name: str, strict: bool) -> Column:
    """Text and integers become BIGINT; a fractional column keeps its type."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.IntegralType, T.NullType)):
        return _cast(name, "bigint", strict)
    return F.col(name)


def build_dim_players(raw: Tables, *, strict: bool = True) -> DataFrame:
    """Player dimension with a typed registration date and a load stamp.

    ``strict=False`` turns values that do not parse into NULL instead of raising.
    """
    src = raw.players
    return src.select(
        "player_id",
        _cast("registration_date", "date", strict),
        "country",
        "platform",
        "install_source",
        "device_type",
        _whole(src, "player_level", strict),
        F.current_timestamp().alias("loaded_at"),
    )


def build_fact_sessions(raw: Tables, *, strict: bool = True) -> DataFrame:
    """Session facts; the date is the day the session *started* on."""
    src = raw.sessions
    counters = ["duration_minutes", "levels_completed", "deaths", "items_collected", "score"]
    typed = src.select(
        "session_id",
        "player_id",
        _cast("session_start", "timestamp_ntz", strict),
        _cast("session_end", "timestamp_ntz", strict),
        *[_whole(src, name, strict) for name in counters],
    )
    return typed.select(
        "*",
        F.to_date("session_start").alias("session_date"),
        F.current_timestamp().alias("loaded_at"),
    )


def build_fact_purchases(raw: Tables, *, strict: bool = True) -> DataFrame:
    """Purchase facts with the day of purchase."""
    typed = raw.purchases.select(
        "purchase_id",
        "player_id",
        "session_id",
        _cast("purchase_time", "timestamp_ntz", strict),
        "item_type",
        "item_name",
        _cast("price_usd", "double", strict),
        "currency",
        "platform",
    )
    return typed.select(
        "*",
        F.to_date("purchase_time").alias("purchase_date"),
        F.current_timestamp().alias("loaded_at"),
    )


def build_tables(raw: Tables, *, strict: bool = True) -> Tables:
    return Tables(
        players=build_dim_players(raw, strict=strict),
        sessions=build_fact_sessions(raw, strict=strict),
        purchases=build_fact_purchases(raw, strict=strict),
    )


_IDS = {"sessions": "session_id", "purchases": "purchase_id"}

#: Versions of a warehouse that stay readable, the current one included.
KEPT_VERSIONS = 2


def _laid_out(name: str, df: DataFrame) -> DataFrame:
    """Rows dealt by ranges of (date, player, id), sorted the same way.

    A date filter skips directories; the files of a day, and those of the players, cover
    player keys that do not overlap, so a player lookup opens one or two of them. Ranges
    come from a sample of the rows: a launch day, and a player who owns much of one, are
    split over several tasks, and AQE joins small ranges up.
    """
    keys = ["player_id"]
    if name in DATE_COLUMNS:
        keys = [DATE_COLUMNS[name], "player_id", _IDS[name]]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _writer(name: str, df: DataFrame) -> DataFrameWriter:
    """Files with a Bloom filter of the player key in each row group.

    A player has rows on few of the days, but on most days the key lies between the least and
    the greatest of a file: the filter tells a lookup to skip the row group. Its size adapts
    to the number of keys, up to 1 MB.
    """
    writer = df.write.options(
        **{
            "parquet.bloom.filter.enabled#player_id": "true",
            "parquet.bloom.filter.adaptive.enabled": "true",
        }
    )
    return writer.partitionBy(DATE_COLUMNS[name]) if name in DATE_COLUMNS else writer


@dataclass(frozen=True)
class StoredTables(Tables):
    """Tables of one version of a warehouse, with the statistics written beside them."""

    folder: str = ""

    def _kept(self) -> DataFrame:
        return self.players.sparkSession.read.parquet(f"{self.folder}/statistics")

    def stale(self) -> DataFrame:
        """(table_name, day) whose files were changed by hand since they were counted."""
        return statistics.stale(self.players.sparkSession, self._kept(), self.folder)

    def statistics(self) -> DataFrame | None:
        """The kept statistics; None if some are stale. Lists the files, opens none of them."""
        return None if self.stale().limit(1).count() else self._kept()


def write_warehouse(tables: Tables, path: str, *, keep: int = KEPT_VERSIONS) -> None:
    """Rebuild all three tables as Parquet under ``path``, in a new version.

    Readers see the version before until all of the new one is written, statistics included.
    """
    spark = tables.players.sparkSession
    versions = Versions(spark, path)
    number, name = versions.new_folder()
    folder = f"{versions.path}/{name}"
    try:
        for table, df in tables.named().items():
            _writer(table, _laid_out(table, df)).parquet(f"{folder}/{TABLE_NAMES[table]}")
        schemas = {table: df.schema for table, df in tables.named().items()}
        counted = statistics.gather(spark, Tables(**_frames(spark, folder, schemas)), folder)
        counted.coalesce(1).write.parquet(f"{folder}/statistics")
        document = {
            "folders": [name],
            "schemas": {table: schema.jsonValue() for table, schema in schemas.items()},
        }
        versions.commit(number, document, keep)
    except BaseException:
        versions.delete([name])
        raise


def _frames(spark: SparkSession, folder: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(schema)
        .parquet(f"{folder}/{TABLE_NAMES[name]}")
        .select(*schema.fieldNames())
        for name, schema in schemas.items()
    }


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the committed version."""
    commit = Versions(spark, path).latest()
    return f"{path.rstrip('/')}/{commit['folders'][0]}" if commit else None


def read_warehouse(
    spark: SparkSession, path: str, schemas: dict[str, T.StructType] | None = None
) -> Tables:
    """Open the committed version of the tables under ``path``.

    The schemas are those that were written, not read from file footers, so empty tables open
    too; ``schemas`` replaces some. Tables that lie under ``path`` without a commit (written
    by other means) open as well, with the schemas of WAREHOUSE_SCHEMAS and no statistics.
    """
    commit = Versions(spark, path).latest()
    if commit is None:
        return Tables(**_frames(spark, path, {**WAREHOUSE_SCHEMAS, **(schemas or {})}))
    written = {name: T.StructType.fromJson(s) for name, s in commit["schemas"].items()}
    folder = f"{path.rstrip('/')}/{commit['folders'][0]}"
    return StoredTables(**_frames(spark, folder, {**written, **(schemas or {})}), folder=folder)


def save_warehouse(tables: Tables, database: str, *, player_buckets: int | None = None) -> None:
    """The same rebuild as catalog tables: new tables, and views that are then turned to them.

    Until a view is replaced it shows the table before, which is kept until the next rebuild.
    ``player_buckets`` buckets the player dimension by its key. With as many
    buckets as reports use shuffle partitions, they no longer shuffle it. The
    facts stay unbucketed: one player may own a large part of them, and a
    bucket is read by a single task.
    """
    spark = tables.players.sparkSession
    mark = uuid.uuid4().hex[:8]
    for name, df in tables.named().items():
        if name == "players" and player_buckets:
            spread = df.repartition(player_buckets, "player_id")
            writer = _writer(name, spread).bucketBy(player_buckets, "player_id").sortBy("player_id")
        else:
            writer = _writer(name, _laid_out(name, df))
        writer.format("parquet").saveAsTable(f"{database}.{TABLE_NAMES[name]}__{mark}")
    for table in TABLE_NAMES.values():
        view = f"{database}.{table}"
        shown = None
        if spark.catalog.tableExists(view):
            found = spark.catalog.getTable(view)
            if found.tableType == "VIEW":
                shown = spark.sql(f"SHOW TBLPROPERTIES {view} ('shows')").first()["value"]
            else:  # a table of an unversioned warehouse
                spark.sql(f"DROP TABLE {view}")
        new = f"{table}__{mark}"
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('shows' = '{new}') "
            f"AS SELECT * FROM {database}.{new}"
        )
        for old in spark.catalog.listTables(database, f"{table}__*"):
            if old.name not in (new, shown):
                spark.sql(f"DROP TABLE IF EXISTS {database}.{old.name}")


def load_warehouse(spark: SparkSession, database: str) -> Tables:
    """Open the catalog tables of ``database``."""
    opened = {}
    for name, table in TABLE_NAMES.items():
        order = WAREHOUSE_SCHEMAS[name].fieldNames()
        opened[name] = spark.table(f"{database}.{table}").select(*order)
    return Tables(**opened)
