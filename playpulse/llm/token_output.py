"""Token ids of a corpus as Huffman-coded files, and their reader.

Texts are tokenized once, to a table of ids in the output folder. All ids are counted;
their canonical code, no longer than CODE_LIMIT bits (or what the vocabulary needs), comes
from these global counts. Each document is coded where its ids are read, so that only
coded bytes are shuffled. No stage has more than one Python node, so a task needs one worker,
and workers give up the tokenizer and its pieces in the next stage. Parts are ranges of doc_id by weighted sampled splitters; a part
is sorted and written as blocks of whole documents of about BLOCK_BYTES. Then the table of
ids is deleted.

A folder holds two Parquet tables. `code`: id, length (the canonical code follows from
them). `blocks`: part, block, first_token (within the part), and lists over the block's
documents (doc_ids, n_tokens, n_bytes), the bits of every step of 128 ids, and the coded
bytes. Every document starts on a byte and the sums of step bits are bit offsets, so each
block, each document and each step can be decoded alone; the reader decodes all steps of
a block side by side by one table lookup for each id.

Files are written by Spark's own writer: a task that is lost or repeated leaves nothing
behind. The driver holds one row for each id of the vocabulary and one for each part, of
which there are MAX_PARTS at most.

Defined cases: a null or empty text has the end id only. Documents of null doc_id come
first; equal doc_ids follow each other in an order by their text's hash. An empty table
gives tables without rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from playpulse.llm import huffman, splitters, token_pieces
from playpulse.llm.scratch import delete_folder

CODE_LIMIT = 18
BLOCK_BYTES = 1 << 19
PART_BYTES = 64 << 20
MAX_PARTS = 100_000
_ROWS_AT_ONCE = 512


def _tokenized(definition: str, end_id: int, width: str):
    """The ids of every document, as bytes."""
    size = np.dtype(width).itemsize

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for row, ids, bounds in token_pieces.encoded(definition, batch.column("text"), end_id):
                n = len(bounds) - 1
                yield pa.record_batch(
                    {
                        **{c: rest.column(c).slice(row, n) for c in rest.schema.names},
                        "ids": _binary(ids.astype(width), bounds * size),
                    }
                )

    return tokenized


def _binary(values: np.ndarray, byte_bounds: np.ndarray) -> pa.Array:
    """A binary column over the bytes of one array."""
    offsets = pa.py_buffer(byte_bounds.astype(np.int32))
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(byte_bounds) - 1, [None, offsets, data])


def _views(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of a binary column of ids."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data.view(width), (offsets - offsets[0]).astype(np.int64) // np.dtype(width).itemsize


def _counted(width: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_pieces.forget()
        totals = np.zeros(1, dtype=np.int64)
        for batch in batches:
            n = np.bincount(_views(batch.column("ids"), width)[0])
            if len(n) > len(totals):
                totals = np.pad(totals, (0, len(n) - len(totals)))
            totals[: len(n)] += n
        used = np.flatnonzero(totals)
        yield pa.record_batch({"id": used.astype(np.int32), "n": totals[used]})

    return count


def _coded(code: huffman.Code, width: str):
    words, lengths = code.encoder()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_pieces.forget()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                rows = batch.slice(at, _ROWS_AT_ONCE)
                ids, bounds = _views(rows.column("ids"), width)
                data, data_at, bits, steps = huffman.encode(ids, bounds, words, lengths)
                rest = rows.drop_columns(["ids"])
                yield pa.record_batch(
                    {
                        **{c: rest.column(c) for c in rest.schema.names},
                        "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                        "step_bits": _binary(bits.astype("<u2"), 2 * steps),
                        "coded": _binary(data, data_at),
                    }
                )

    return coded


_BLOCK = (
    "part int, block int, first_token long, doc_ids array<{id}>, n_tokens array<long>, "
    "n_bytes array<int>, step_bits binary, coded binary"
)


def _blocks(id_type: pa.DataType):
    """Joins the documents of one sorted part to blocks."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, reached = None, 0, 0
        held: dict[str, list] = {}

        def block() -> pa.RecordBatch:
            nonlocal number, reached
            out = pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([number], pa.int32()),
                    "first_token": pa.array([reached], pa.int64()),
                    "doc_ids": pa.array([held["doc_id"]], pa.list_(id_type)),
                    "n_tokens": pa.array([held["n_tokens"]], pa.list_(pa.int64())),
                    "n_bytes": pa.array([[len(c) for c in held["coded"]]], pa.list_(pa.int32())),
                    "step_bits": pa.array([b"".join(held["step_bits"])], pa.binary()),
                    "coded": pa.array([b"".join(held["coded"])], pa.binary()),
                }
            )
            number, reached = number + 1, reached + sum(held["n_tokens"])
            return out

        size = 0
        for batch in batches:
            columns = {
                c: batch.column(c).to_pylist()
                for c in ("part", "doc_id", "n_tokens", "step_bits", "coded")
            }
            for row in zip(*columns.values(), strict=True):
                if held and (row[0] != part or size >= BLOCK_BYTES):
                    yield block()
                    held, size = {}, 0
                if row[0] != part:
                    part, number, reached = row[0], 0, 0
                for name, value in zip(columns, row, strict=True):
                    held.setdefault(name, []).append(value)
                size += len(row[4])
        if held:
            yield block()

    return blocks


def _most(definition: str, end_id: int) -> int:
    """The largest id that can occur."""
    known = json.loads(definition)
    added = [t["id"] for t in known.get("added_tokens", [])]
    return max(*known["model"]["vocab"].values(), *added, end_id, 0)


def write_tokens(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int, part_bytes: int = PART_BYTES
) -> None:
    """Write the ids of all texts, in ascending doc_id order, to a new folder.

    tokenizer: path of a definition for the tokenizers library, read on the driver.
    """
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    width = "<u2" if _most(definition, end_id) < 1 << 16 else "<u4"
    field = documents.schema["doc_id"]
    id_type = field.dataType.simpleString()
    keyed = documents.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(splitters.LEAST)).alias("first"),
        F.xxhash64("text").alias("second"),
        F.col("text").cast("string").alias("text"),
    )
    (
        keyed.mapInArrow(
            _tokenized(definition, end_id, width),
            f"doc_id {id_type}, first long, second long, ids binary",
        )
        .write.option("compression", "zstd")
        .parquet(f"{folder}/ids")
    )
    stored = spark.read.parquet(f"{folder}/ids")
    counts = (
        stored.select("ids")
        .mapInArrow(_counted(width), "id int, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    ids, n = counts["id"].to_numpy(), counts["n"].to_numpy()
    limit = max(CODE_LIMIT, (max(len(ids), 1) - 1).bit_length() + 1)
    code = huffman.Code(ids, huffman.code_lengths(n, limit))
    # From Arrow: rows of a list would start Python workers of another kind on the executors.
    table = pa.table(
        {"id": np.asarray(code.symbols, np.int32), "length": np.asarray(code.lengths, np.int32)}
    )
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/code")

    keys = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(splitters.LEAST)).alias("first"),
        F.xxhash64("text").alias("second"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("weight"),
    )
    total = keys.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    wanted = max(-(-total // part_bytes), spark.sparkContext.defaultParallelism)
    cuts = splitters.splitters(keys, min(wanted, MAX_PARTS), total)
    rows = stored.withColumn("part", splitters.range_of(F.col("first"), F.col("second"), cuts))
    coded = rows.mapInArrow(
        _coded(code, width),
        f"doc_id {id_type}, first long, second long, part int, "
        "n_tokens long, step_bits binary, coded binary",
    )
    (
        coded.repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("part", "first", "second")
        .mapInArrow(_blocks(to_arrow_type(field.dataType)), _BLOCK.format(id=id_type))
        .write.parquet(f"{folder}/blocks")
    )
    delete_folder(spark, f"{folder}/ids")


def _decoded(code: huffman.Code, part_starts: np.ndarray, packed: bool):
    symbols, lengths = code.decoder()

    def column(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        if packed:
            return _binary(ids.astype("<u4"), 4 * bounds)
        return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.view(np.int32)))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_pieces.forget()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                doc_ids = row.column("doc_ids").flatten()
                n = row.column("n_tokens").flatten().to_numpy()
                n_bytes = row.column("n_bytes").flatten().to_numpy().astype(np.int64)
                bits = np.frombuffer(row.column("step_bits")[0].as_buffer(), dtype="<u2")
                data = np.frombuffer(row.column("coded")[0].as_buffer(), dtype=np.uint8)
                starts = np.cumsum(n_bytes) - n_bytes
                ids = huffman.decode(data, starts, n, bits, symbols, lengths)
                first = row.column("first_token")[0].as_py()
                first += int(part_starts[row.column("part")[0].as_py()])
                bounds = np.append(0, np.cumsum(n))
                yield pa.record_batch(
                    {
                        "doc_id": doc_ids,
                        "start": pa.array(first + bounds[:-1], pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()),
                        "ids": column(ids, bounds),
                    }
                )

    return decoded


def read_tokens(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a folder.

    start: how many ids the documents before it have, over the whole folder.
    packed: ids as one binary of little-endian unsigned 32-bit integers, not as an array.
    """
    table = spark.read.parquet(f"{folder}/code").toArrow()
    code = huffman.Code(table["id"].to_numpy(), table["length"].to_numpy())
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = (
        blocks.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    per_part = np.zeros(MAX_PARTS, dtype=np.int64)
    per_part[sizes["part"].to_numpy()] = sizes["n"].to_numpy()
    part_starts = np.cumsum(per_part) - per_part
    used = int(sizes["part"].to_numpy().max(initial=0)) + 1
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    ids = "binary" if packed else "array<int>"
    return blocks.mapInArrow(
        _decoded(code, part_starts[:used], packed),
        f"doc_id {id_type}, start long, n_tokens long, ids {ids}",
    )
