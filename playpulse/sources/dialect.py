"""What separates and quotes the fields of CSV files, and whether they begin with names.

Found out from the first SAMPLE_BYTES of at most SAMPLE_FILES files. A reader then checks the
names at the head of every file, so files that differ from the sample raise when they are read.
"""

from __future__ import annotations

import bz2
import csv
import io
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

SAMPLE_FILES = 8
SAMPLE_BYTES = 64 << 10
#: Separators that are tried, the usual one first.
SEPARATORS = (",", ";", "\t", "|")
QUOTES = ('"', "'")

_TYPED = re.compile(
    r"[-+]?\d+(\.\d*)?([eE][-+]?\d+)?"  # numbers
    r"|\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?"  # dates and times
    r"|true|false",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str = '"'
    header: bool = True


def _decoded(data: bytes, name: str, whole: bool) -> str:
    if name.endswith((".gz", ".gzip")):
        data = zlib.decompressobj(31).decompress(data, SAMPLE_BYTES)
        whole = False
    elif name.endswith(".bz2"):
        data = bz2.BZ2Decompressor().decompress(data, SAMPLE_BYTES)
        whole = False
    if not whole and b"\n" in data:
        data = data[: data.rindex(b"\n") + 1]  # the last line may be cut off
    return data.decode("utf-8-sig", errors="replace")


def samples(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, first text) of some files of a path: the first, the last and others between."""
    conf = spark._jsc.hadoopConfiguration()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    files = []
    for status in fs.globStatus(root) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        files += [
            f for f in inside if f.isFile() and f.getLen() and f.getPath().getName()[0] not in "._"
        ]
    step = max(1, -(-len(files) // SAMPLE_FILES))
    chosen = {id(f): f for f in (*files[::step], *files[-1:])}.values()
    out = []
    for file in chosen:
        stream = fs.open(file.getPath())
        try:
            data = bytes(stream.readNBytes(SAMPLE_BYTES))
        finally:
            stream.close()
        name = file.getPath().getName()
        out.append((name, _decoded(data, name, len(data) == file.getLen())))
    return out


def _rows(text: str, sep: str, quote: str) -> list[list[str]]:
    reader = csv.reader(io.StringIO(text, newline=""), delimiter=sep, quotechar=quote)
    return [row for row in reader if row]


def _even(rows: list[list[str]]) -> bool:
    return len({len(row) for row in rows}) == 1


def _header(rows: list[list[str]], columns: Sequence[str] | None) -> bool:
    first = [value.strip() for value in rows[0]]
    if columns is not None:
        return bool(set(first) & set(columns))
    if not all(first) or len(set(first)) < len(first) or any(map(_TYPED.fullmatch, first)):
        return False
    return True


def of_text(text: str, columns: Sequence[str] | None = None) -> Dialect | None:
    """The dialect of one file; None for a file without a line.

    Of the separators that give every line the same number of fields the one with the most
    fields is taken, of equal ones the first; one that gives the names of ``columns`` comes
    before all others.
    """
    best: tuple[tuple, Dialect] | None = None
    for quote in QUOTES:
        for sep in SEPARATORS:
            try:
                rows = _rows(text, sep, quote)
            except csv.Error:
                continue
            if not rows:
                return None
            named = columns is not None and rows[0] == list(columns)
            n = len(rows[0])
            quoted = sum(
                value[:1] == value[-1:] == other and len(value) > 1
                for row in rows
                for value in row
                for other in QUOTES
                if other != quote
            )
            rank = (named, _even(rows) and n > 1, -quoted, n if _even(rows) else 0)
            if best is None or rank > best[0]:
                best = rank, Dialect(sep, quote, _header(rows, columns))
    return best[1] if best else None


def detect(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> Dialect:
    """The dialect of the files under a path; raises where the sampled ones contradict."""
    found: dict[Dialect, str] = {}
    for name, text in samples(spark, path):
        dialect = of_text(text, columns)
        if dialect is not None:
            found.setdefault(dialect, name)
    if len(found) > 1:
        told = "; ".join(f"{name}: {dialect}" for dialect, name in found.items())
        raise ValueError(f"files of {path} are written differently: {told}")
    return next(iter(found), Dialect())
