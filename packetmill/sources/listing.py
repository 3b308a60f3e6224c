"""Folders of files as a table, listed in parallel, for batch and streaming reads.

``spark.read.format("listing").load(root)`` gives ``path, length, modified``, a row per file, empty
files among them, which Spark's binary file source hides. The folders right under the root (one per
load) are dealt to tasks, and every task lists its own. ``readStream`` gives the files that were
modified since the last batch.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FOLDERS = 256      # that one task lists
SETTLE = "10"      # seconds that a file must have been left alone before a stream takes it


class _Folders(InputPartition):
    """Folders to list whole, or files that lie right under the root."""

    def __init__(self, folders: list[str], files: list[tuple], after: int = -1, until: int = 1 << 62):
        super().__init__(None)
        self.folders, self.files, self.after, self.until = folders, files, after, until


def _row(info: fs.FileInfo) -> tuple:
    return info.path, info.size, info.mtime_ns


class _Lister:
    """What both readers share."""

    def __init__(self, options: dict):
        self.uri = options["path"]
        self.folders = int(options.get("folders", FOLDERS))
        self.settle = float(options.get("settle", SETTLE))
        _, self.root = fs.FileSystem.from_uri(self.uri)

    def shown(self, path: str) -> str:
        """The file's path below the given one, in the given spelling."""
        return self.uri.rstrip("/") + path[len(self.root.rstrip("/")):]

    def plan(self, after: int = -1, until: int = 1 << 62) -> list[_Folders]:
        files, root = fs.FileSystem.from_uri(self.uri)
        found = files.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=True))
        names = sorted(x.path for x in found if x.type == fs.FileType.Directory)
        here = [_row(x) for x in found if x.type == fs.FileType.File]
        parts = [_Folders(names[a:a + self.folders], [], after, until) for a in range(0, len(names), self.folders)]
        return parts + [_Folders([], here, after, until)]

    def rows(self, part: _Folders) -> Iterator[tuple]:
        files, _ = fs.FileSystem.from_uri(self.uri)
        found = list(part.files)
        for folder in [None, *part.folders]:
            if folder is not None:
                selector = fs.FileSelector(folder, recursive=True, allow_not_found=True)
                found = [_row(x) for x in files.get_file_info(selector) if x.type == fs.FileType.File]
            for path, size, at in found:
                if part.after < (at or 0) <= part.until:
                    yield self.shown(path), size, datetime.fromtimestamp((at or 0) / 1e9, UTC)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.lister = _Lister(options)

    def partitions(self) -> list[InputPartition]:
        return self.lister.plan()

    def read(self, partition: _Folders) -> Iterator[tuple]:
        return self.lister.rows(partition)


class _StreamReader(DataSourceStreamReader):
    """Files by the time they were modified: each batch takes those after the last one's end.

    The end lies ``settle`` seconds back, so that a file still being written waits for a later batch.
    """

    def __init__(self, options: dict):
        self.lister = _Lister(options)

    def initialOffset(self) -> dict:
        return {"until": -1}

    def latestOffset(self) -> dict:
        return {"until": time.time_ns() - int(self.lister.settle * 1e9)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.lister.plan(start["until"], end["until"])

    def read(self, partition: _Folders) -> Iterator[tuple]:
        return self.lister.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing to give back: the checkpoint holds where the last batch ended."""


class Listing(DataSource):
    """The registered source; options ``folders`` (per task) and ``settle`` (seconds, streams only)."""

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "path string, length bigint, modified timestamp"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def list_files(spark: SparkSession, root: str, folders: int = FOLDERS) -> DataFrame:
    """``path, length, modified`` of all files under the root."""
    spark.dataSource.register(Listing)
    return spark.read.format("listing").option("folders", str(folders)).load(root)


def stream_files(spark: SparkSession, root: str, settle: float = float(SETTLE), folders: int = FOLDERS) -> DataFrame:
    """The same as a stream of new and changed files."""
    spark.dataSource.register(Listing)
    return spark.readStream.format("listing").option("folders", str(folders)).option("settle", str(settle)).load(root)
