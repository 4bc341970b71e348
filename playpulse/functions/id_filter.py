"""A filter of fixed size for ids: which rows may have an id out of a set.

The set's hashes set bits in a table of at most CELLS rows of 64, whatever the size of the
set, so the table may be broadcast. It lets every id of the set through and a few others; a
set of many millions lets most ids through. It saves work and decides nothing: callers must
be right for any id that passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**23 bits, 1 MB.
CELLS = 1 << 17


def _cell(id_column: str) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(CELLS)).cast("int")


def _place(id_column: str) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(id_column), 17), F.lit(64)).cast("int")


def cells(ids: DataFrame, id_column: str) -> DataFrame:
    """The filter of the ids of a column."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(id_column))
    return ids.groupBy(_cell(id_column).alias("cell")).agg(F.bit_or(bit).alias("cell_bits"))


def marked(rows: DataFrame, id_column: str, table: DataFrame, name: str) -> DataFrame:
    """Rows with a boolean ``name``: true wherever the id is in the set, false for most others."""
    hit = F.getbit("cell_bits", _place(id_column)) == 1
    keyed = rows.withColumn("cell_of_id", _cell(id_column))
    joined = keyed.join(F.broadcast(table), F.col("cell_of_id") == F.col("cell"), "left")
    found = F.coalesce(hit, F.lit(False)) & F.col(id_column).isNotNull()
    return joined.withColumn(name, found).drop("cell_of_id", "cell", "cell_bits")
