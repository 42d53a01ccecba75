"""Landed snapshots as a streaming source whose offsets are their numbers.

Rows are (number, path): what landed, not what is in it, so that Spark's own readers parse the files in
parallel.  The number of the current snapshot is the offset, and it is kept in the query's checkpoint; so each is
given once, also over restarts, whatever its file is called.  Snapshots that were forgotten before
they were seen are left out, for a later one took their place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemill.sources.landing import CURRENT

NAME = "tidemill_snapshots"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there; it is asked in Python, where no session is."""
    if urlparse(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(folder).path
    return fs.FileSystem.from_uri(folder)


class _Landed(InputPartition):
    def __init__(self, number: int, path: str) -> None:
        self.number, self.path = number, path


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str) -> None:
        self._folder = folder.rstrip("/")

    def initialOffset(self) -> dict:
        return {"number": 0}

    def latestOffset(self) -> dict:
        store, root = _store(self._folder)
        at = f"{root}/{CURRENT}"
        if store.get_file_info(at).type == fs.FileType.NotFound:
            return {"number": 0}
        with store.open_input_stream(at) as f:
            return {"number": json.loads(f.read())["number"]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, root = _store(self._folder)
        names = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.base_name.startswith("snapshot-"))
        numbered = [(int(n.split("-")[1]), n) for n in names]
        found = [_Landed(k, f"{self._folder}/{n}") for k, n in numbered if start["number"] < k <= end["number"]]
        return found or [_Landed(0, "")]

    def read(self, partition: _Landed) -> Iterator[tuple]:
        if partition.number:
            yield partition.number, partition.path


class Snapshots(DataSource):
    """``spark.readStream.format(NAME).option("path", folder)`` after ``spark.dataSource.register(Snapshots)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "number long, path string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if "path" not in self.options:
            raise ValueError("the landing folder must be given as path")
        return _Reader(self.options["path"])
