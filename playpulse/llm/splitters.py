"""Range boundaries from weighted samples of keys, for keys of two longs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES_PER_RANGE = 16
LEAST = -(1 << 63)

Key = tuple[int, int]


def sampled(rows: DataFrame, rate: float, seed: int) -> list[tuple[int, int, int]]:
    """(first, second, times) of keys drawn with `rate` draws expected for a unit of weight.

    The draw depends on the row's values only, so a repeated task draws the same rows.
    """
    expected = F.col("weight") * F.lit(float(rate))
    luck = F.pmod(F.xxhash64("first", "second", "weight", F.lit(seed)), F.lit(1 << 40)) / (1 << 40)
    times = F.floor(expected + luck).cast("long")
    table = rows.select("first", "second", times.alias("times")).where("times > 0").toArrow()
    return list(zip(*(table[c].to_pylist() for c in ("first", "second", "times")), strict=True))


def quantiles(sample: list[tuple[int, int, int]], n_ranges: int) -> list[Key]:
    """Keys that cut the sample into ranges of about equal weight; fewer if keys repeat."""
    if not sample or n_ranges < 2:
        return []
    sample = sorted(sample)
    reached = np.cumsum([times for _, _, times in sample])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, n_ranges) / n_ranges)
    return sorted({sample[i][:2] for i in at.tolist()})


def splitters(rows: DataFrame, n_ranges: int, total: int, seed: int = 7) -> list[Key]:
    """At most n_ranges - 1 boundaries for rows (first, second, weight) of this total weight.

    About SAMPLES_PER_RANGE keys for each range come to the driver, whatever the data's size.
    """
    rate = n_ranges * SAMPLES_PER_RANGE / max(total, 1)
    return quantiles(sampled(rows, rate, seed), n_ranges)


def longs(values: list[int]) -> Column:
    """A constant array, written as one text so that long lists stay one expression."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def range_of(first: Column, second: Column, cuts: list[Key]) -> Column:
    """The number of boundaries at or before a key, by binary search."""
    if not cuts:
        return F.lit(0)
    firsts, seconds = longs([a for a, _ in cuts]), longs([b for _, b in cuts])
    steps = F.array(*(F.lit(1 << p) for p in reversed(range(len(cuts).bit_length()))))

    def further(low: Column, step: Column) -> Column:
        at = low + step - 1
        a, b = F.get(firsts, at), F.get(seconds, at)
        passed = F.coalesce((a < first) | ((a == first) & (b <= second)), F.lit(False))
        return F.when(passed, low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), further)
