"""Raw CSV files: one headed file set per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playpulse.schema import RAW_SCHEMAS, Tables
from playpulse.sources.dialect import Dialect, detect

# Quotes inside a quoted field are doubled, not escaped with a backslash. Only
# an empty field is NULL: the text NA is a country code.
_FORMAT = {"header": True, "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    multiline: bool = False,
    sep: str | None = None,
) -> DataFrame:
    """Scan one CSV table; without a schema the types are inferred.

    What separates and quotes the fields, and whether names come first, is found out from the
    beginning of a few files; ``sep`` tells it for files with names. Names are checked against
    the schema in every file, and a malformed number raises. Inference costs one more pass over
    the files; times are taken as written, without a zone. ``multiline`` allows line breaks
    inside quoted fields, at the price of unsplittable files.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames() if schema is not None else None
    found = Dialect(sep) if sep is not None else detect(spark, path, names)
    options = _FORMAT | {"sep": found.sep, "quote": found.quote, "header": found.header}
    if found.quote != '"':
        options["escape"] = found.quote
    reader = spark.read.options(**options, multiLine=multiline, mode="FAILFAST", enforceSchema=False)
    if schema is None:
        inferred = reader.option("inferSchema", True).csv(path).schema
        schema = T.StructType(
            [
                T.StructField(
                    f.name,
                    T.TimestampNTZType() if f.dataType == T.TimestampType() else f.dataType,
                )
                for f in inferred
            ]
        )
    return reader.schema(schema).csv(path)


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    infer: bool = False,
    multiline: bool = False,
    sep: str | None = None,
) -> Tables:
    """The three raw tables under ``path``: players.csv, sessions.csv and purchases.csv."""
    return Tables(
        **{
            name: read_csv(
                spark,
                f"{path}/{name}.csv",
                None if infer else schema,
                multiline=multiline,
                sep=sep,
            )
            for name, schema in RAW_SCHEMAS.items()
        }
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write a frame as headed CSV, replacing what is there.

    Times go out as text because the CSV writer would cut them to milliseconds;
    spaces around a value are part of it.
    """
    times = (T.TimestampType, T.TimestampNTZType)
    columns = [
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, times) else f.name
        for f in df.schema
    ]
    writer = df.select(*columns).write.mode("overwrite").options(**_FORMAT)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_raw(raw: Tables, path: str) -> None:
    for name, df in raw.named().items():
        write_csv(df, f"{path}/{name}.csv")
