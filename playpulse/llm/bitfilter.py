"""A filter of fixed size over 64-bit hashes, for dropping rows before a shuffle.

Its size is a constant, not a share of the data, so it may go to every task. It lets every
hash through that was put in, and some others: callers still join by the true key, and the
fuller the filter, the more rows they join. It decides nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.names import free_names
from playpulse.llm.scratch import once

BITS = 23
_CELL = 32


def build(hashes: DataFrame) -> np.ndarray:
    """The filter of a long column `hash`; at most 2**BITS / 32 rows reach the driver (1 MB)."""
    bit = F.pmod("hash", F.lit(1 << BITS))
    with once(hashes.sparkSession):
        cells = (
            hashes.select(
                F.floor(bit / _CELL).cast("int").alias("cell"),
                (bit % _CELL).cast("int").alias("at"),
            )
            .groupBy("cell")
            .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
            .toArrow()
        )
    filled = np.zeros((1 << BITS) // _CELL, dtype=np.uint32)
    filled[cells["cell"].to_numpy()] = cells["bits"].to_numpy().astype(np.uint32)
    return filled


def passing(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.astype(np.uint64) & np.uint64((1 << BITS) - 1)
    cell = filled[(bit // np.uint64(_CELL)).astype(np.int64)]
    return (cell >> (bit % np.uint64(_CELL)).astype(np.uint32)) & np.uint32(1) == 1



def cells(hashes: DataFrame) -> DataFrame:
    """The filter of a long column `hash` as a table: 2**BITS / 64 rows at most."""
    bit = F.pmod("hash", F.lit(1 << BITS))
    return (
        hashes.select(bit.alias("bit"))
        .select(F.floor(F.col("bit") / 64).cast("int").alias("__cell"), "bit")
        .groupBy("__cell")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("__bits"))
    )


def passes(rows: DataFrame, table: DataFrame, hash_column: Column, name: str) -> DataFrame:
    """rows with a boolean column `name`, by a broadcast of the filter's table.

    The table has 131,072 short rows at most, whatever was put in, so it is always broadcast.
    Callers choose a name that rows do not have.
    """
    at, cell, bits = free_names(rows, "__at", "__cell", "__bits")
    table = table.select(F.col("__cell").alias(cell), F.col("__bits").alias(bits))
    found = rows.withColumn(at, F.pmod(hash_column, F.lit(1 << BITS)))
    found = found.withColumn(cell, F.floor(F.col(at) / 64).cast("int"))
    hit = F.getbit(F.col(bits), (F.col(at) % 64).cast("int")) == 1
    return (
        found.join(F.broadcast(table), cell, "left")
        .withColumn(name, F.coalesce(hit, F.lit(False)))
        .drop(cell, at, bits)
    )
