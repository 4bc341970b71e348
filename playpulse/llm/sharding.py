"""Shards of near equal bytes by sampled splitters. DataFrame functions only.

Records are ordered by (hash of the text, doc_id). Keys are sampled with a chance in
proportion to their record's size, quantiles of the sample cut the order into ranges
(several for each shard, and no more rows in one than a task sorts with ease), and ranges
whose measured bytes are too many are sampled again, more densely, and subdivided. A text
that is on a cut only once moves whole to one side; a text so frequent that it fills
ranges is divided by doc_id. The bytes of all ranges then give each range its place in the
whole order, a window inside each range gives each record its place, and shard boundaries
are equal steps of bytes. Groups of equal texts below GROUP_SHARE of a shard stay whole, and
a shard is off its share by such groups or one record at most.

Only sampled keys and one row for each range, or range and shard, reach the driver.

Defined cases: a null text has no bytes, and counts as one text; null doc_ids come first;
repeated rows are records of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playpulse.llm import splitters
from playpulse.llm.scratch import cut
from playpulse.llm.splitters import Key

OVERHEAD = 16
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 1_000_000
OVERFULL = 2.0
GROUP_SHARE = 0.02
_ROUNDS = 6


def _whole_groups(cuts: list[Key]) -> list[Key]:
    """Cuts before a text, not inside it, unless the text holds several cuts."""
    times: dict[int, int] = {}
    for text, _ in cuts:
        times[text] = times.get(text, 0) + 1
    return sorted({(t, d if times[t] > 1 else splitters.LEAST) for t, d in cuts})


def _measured(keys: DataFrame, cuts: list[Key]) -> tuple[DataFrame, list[int]]:
    """Rows with their range; the bytes of every range."""
    ranged = keys.withColumn("range", splitters.range_of(F.col("first"), F.col("second"), cuts))
    sums = ranged.groupBy("range").agg(F.sum("weight").alias("n")).toArrow()
    sizes = [0] * (len(cuts) + 1)
    for r, n in zip(sums["range"].to_pylist(), sums["n"].to_pylist(), strict=True):
        sizes[r] = n
    return ranged, sizes


def _ranges(keys: DataFrame, n_ranges: int, total: int) -> tuple[DataFrame, list[int]]:
    """Rows with a range of bounded size, and the ranges' bytes."""
    cuts = _whole_groups(splitters.splitters(keys, n_ranges, total))
    ranged, sizes = _measured(keys, cuts)
    fair = total / n_ranges
    for turn in range(_ROUNDS):
        full = [r for r, n in enumerate(sizes) if n > OVERFULL * fair]
        if not full:
            break
        rate = splitters.SAMPLES_PER_RANGE / fair * 2**turn
        inside = F.array_contains(splitters.longs(full), F.col("range").cast("long"))
        found = splitters.sampled(ranged.where(inside), rate, seed=11 + turn)
        by_range: dict[int, list[tuple[int, int, int]]] = {r: [] for r in full}
        for sample in found:
            low, high = 0, len(cuts)
            while low < high:
                middle = (low + high) // 2
                low, high = (middle + 1, high) if cuts[middle] <= sample[:2] else (low, middle)
            by_range[low].append(sample)
        more = [c for r, s in by_range.items() for c in splitters.quantiles(s, int(sizes[r] / fair) + 1)]
        finer = _whole_groups(sorted({*cuts, *more}))
        if finer == cuts:
            break  # what is left cannot be told apart by key: one huge record, or equal keys
        cuts = finer
        ranged, sizes = _measured(keys, cuts)
    return ranged, sizes


def _starts(sizes: list[int]) -> list[int]:
    starts, at = [], 0
    for n in sizes:
        starts.append(at)
        at += n
    return starts


def shards(documents: DataFrame, n_shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, text_hash, shard, slot) for every row of documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    records = cut(
        documents.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("weight"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("first"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(splitters.LEAST)).alias("second"),
        )
    )
    n_rows, total = records.agg(F.count("*"), F.coalesce(F.sum("weight"), F.lit(0))).first()
    n_ranges = max(n_shards * RANGES_PER_SHARD, -(-n_rows // ROWS_PER_RANGE))
    ranged, sizes = _ranges(records, n_ranges, max(total, 1))

    in_range = Window.partitionBy("range").orderBy("first", "second")
    in_group = Window.partitionBy("range", "first")
    placed = (
        ranged.withColumn("row", F.row_number().over(in_range))
        .withColumn("reached", F.sum("weight").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("group", F.sum("weight").over(in_group))
        .withColumn("group_start", F.min(F.col("reached") - F.col("weight")).over(in_group))
    )
    # Twice the middle of a record, or of its group, in the order of all bytes.
    alone = 2 * F.col("reached") - F.col("weight")
    together = 2 * F.col("group_start") + F.col("group")
    small = F.col("group") <= F.lit(int(GROUP_SHARE * total / n_shards))
    start = F.get(splitters.longs(_starts(sizes)), F.col("range"))
    placed = placed.withColumn("middle", 2 * start + F.when(small, together).otherwise(alone))
    shard = F.expr(f"least({n_shards - 1}, middle * {n_shards} div {2 * max(total, 1)})")
    placed = cut(
        placed.select(
            "doc_id", "weight", "text_crc32", "first", "range", "row", shard.cast("int").alias("shard")
        )
    )
    counts = placed.groupBy("range", "shard").count().toArrow()
    cells = sorted(zip(*(counts[c].to_pylist() for c in ("range", "shard", "count")), strict=True))
    # For every range its first shard, and from there on what to add to a row's number to
    # get its slot: the shard's rows in earlier ranges less the range's in earlier shards.
    first_shard, place, bases = [0] * len(sizes), [0] * len(sizes), []
    in_shard, in_range_before, at = [0] * n_shards, 0, None
    for r, s, n in cells:
        if r != at:
            at, in_range_before = r, 0
            first_shard[r], place[r] = s, len(bases)
        bases += [0] * (place[r] + s - first_shard[r] - len(bases))
        bases.append(in_shard[s] - in_range_before - 1)
        in_shard[s] += n
        in_range_before += n
    cell = F.get(splitters.longs(place), F.col("range")) + (
        F.col("shard") - F.get(splitters.longs(first_shard), F.col("range"))
    )
    base = F.get(splitters.longs(bases), cell.cast("int"))
    return placed.select(
        "doc_id",
        F.col("weight").alias("size"),
        "text_crc32",
        F.col("first").alias("text_hash"),
        "shard",
        (base + F.col("row")).alias("slot"),
    )
