"""Versioned folders: what a load writes becomes visible at once, by one commit file.

    <path>/_commits/00000000000000000007.json   what version 7 consists of
    <path>/v7-3f2a91c0/...                       files that the load of version 7 wrote

A load writes into a folder of its own and then puts a commit file in place by a rename that
never replaces one. Readers open the highest commit: before the rename they see the old
version whole, after it the new one. A load that fails leaves the old one as it was, and of
two loads at a time one raises. Folders that only older commits name are deleted, but for
those of the last few, which running readers may still have open.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

_COMMIT = re.compile(r"(\d{20})\.json")
_FOLDER = re.compile(r"v(\d+)-[0-9a-f]{8}")


class Versions:
    """The commits under a path, in whatever store Spark can write to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._new_array = spark._sc._gateway.new_array
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, name: str) -> list[str]:
        folder = self._at(name)
        if not self._fs.exists(folder):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(folder)]

    def numbers(self) -> list[int]:
        found = (_COMMIT.fullmatch(name) for name in self._names("_commits"))
        return sorted(int(match[1]) for match in found if match)

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._at(f"_commits/{number:020d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def latest(self) -> dict | None:
        """The last commit's document, or None where nothing was committed."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def new_folder(self) -> tuple[int, str]:
        """(number of the next version, name of a folder for its files)."""
        number = (self.numbers() or [0])[-1] + 1
        return number, f"v{number}-{uuid.uuid4().hex[:8]}"

    def commit(self, number: int, document: dict, keep: int) -> None:
        """Make a version visible. ``document["folders"]`` names all folders it reads.

        Raises where another load has committed this number. ``keep`` versions stay readable.
        """
        written = self._at(f"_commits/.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(written, False)
        try:
            stream.write(bytearray(json.dumps(document | {"version": number}).encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self._new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            target = self._at(f"_commits/{number:020d}.json")
            context.rename(self._fs.makeQualified(written), self._fs.makeQualified(target), options)
        except Exception as e:
            self._fs.delete(written, False)
            raise RuntimeError(f"version {number} of {self.path} is taken: load again") from e
        self._clean(keep)

    def delete(self, names: Iterable[str]) -> None:
        for name in names:
            self._fs.delete(self._at(name), True)

    def _clean(self, keep: int) -> None:
        """Drop old commits, and folders no kept commit names (those of failed loads too).

        A folder above the last version belongs to a load under way.
        """
        numbers = self.numbers()
        kept = numbers[-max(keep, 1) :]
        used = {folder for n in kept for folder in self.read(n)["folders"]}
        self.delete(f"_commits/{n:020d}.json" for n in numbers if n not in kept)
        found = ((name, _FOLDER.fullmatch(name)) for name in self._names(""))
        self.delete(
            name for name, match in found if match and int(match[1]) <= numbers[-1] and name not in used
        )
