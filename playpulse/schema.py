"""Table shapes: the raw CSV files and the star schema built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Tables:
    """The three frames every operator works on (raw or warehouse form)."""

    players: DataFrame
    sessions: DataFrame
    purchases: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {"players": self.players, "sessions": self.sessions, "purchases": self.purchases}

    def statistics(self) -> DataFrame | None:
        """Counts and sums by table and date, where they are kept and up to date."""
        return None


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STRING, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
_DATE, _NTZ, _STAMP = T.DateType(), T.TimestampNTZType(), T.TimestampType()

# Dates and times stay text in the raw files: the warehouse build casts them, so
# a malformed value raises there instead of turning into NULL in the CSV reader.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "players": _struct(
        player_id=_STRING,
        registration_date=_STRING,
        country=_STRING,
        platform=_STRING,
        install_source=_STRING,
        device_type=_STRING,
        player_level=_LONG,
    ),
    "sessions": _struct(
        session_id=_STRING,
        player_id=_STRING,
        session_start=_STRING,
        session_end=_STRING,
        duration_minutes=_LONG,
        levels_completed=_LONG,
        deaths=_LONG,
        items_collected=_LONG,
        score=_LONG,
    ),
    "purchases": _struct(
        purchase_id=_STRING,
        player_id=_STRING,
        session_id=_STRING,
        purchase_time=_STRING,
        item_type=_STRING,
        item_name=_STRING,
        price_usd=_DOUBLE,
        currency=_STRING,
        platform=_STRING,
    ),
}

WAREHOUSE_SCHEMAS: dict[str, T.StructType] = {
    "players": _struct(
        player_id=_STRING,
        registration_date=_DATE,
        country=_STRING,
        platform=_STRING,
        install_source=_STRING,
        device_type=_STRING,
        player_level=_LONG,
        loaded_at=_STAMP,
    ),
    "sessions": _struct(
        session_id=_STRING,
        player_id=_STRING,
        session_start=_NTZ,
        session_end=_NTZ,
        duration_minutes=_LONG,
        levels_completed=_LONG,
        deaths=_LONG,
        items_collected=_LONG,
        score=_LONG,
        session_date=_DATE,
        loaded_at=_STAMP,
    ),
    "purchases": _struct(
        purchase_id=_STRING,
        player_id=_STRING,
        session_id=_STRING,
        purchase_time=_NTZ,
        item_type=_STRING,
        item_name=_STRING,
        price_usd=_DOUBLE,
        currency=_STRING,
        platform=_STRING,
        purchase_date=_DATE,
        loaded_at=_STAMP,
    ),
}

TABLE_NAMES: dict[str, str] = {
    "players": "dim_players",
    "sessions": "fact_sessions",
    "purchases": "fact_purchases",
}

DATE_COLUMNS: dict[str, str] = {"sessions": "session_date", "purchases": "purchase_date"}


def empty_tables(spark: SparkSession, schemas: dict[str, T.StructType] | None = None) -> Tables:
    """Zero-row frames that still carry every column and type."""
    chosen = schemas or WAREHOUSE_SCHEMAS
    return Tables(**{name: spark.createDataFrame([], schema) for name, schema in chosen.items()})
