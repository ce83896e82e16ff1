"""Inventories of day folders as a data source: a partition for each folder, listed by the task that reads it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tracelode.sources.workers import importable

NAME = "day_folders"
SCHEMA = "folder_date date, path string, name string, modified timestamp, length long"


def _opened(root: str):
    """File system and path of a folder: a local path, or an address that the file system library knows."""
    from pyarrow import fs

    if re.match(r"[a-z][a-z0-9+.-]*:", root):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


@dataclass
class Day(InputPartition):
    name: str


class DayFolderReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["root"].rstrip("/")
        self.days = [d for d in options.get("days", "").split(",") if d]
        self.pattern = options.get("pattern", "*")
        bad = [d for d in self.days if not re.fullmatch(r"\d{8}", d)]
        if bad:
            raise ValueError(f"days are yyyymmdd, not {bad}")

    def partitions(self) -> list[Day]:
        """The days asked for, or all that the root has: one entry for each day, however many files it holds."""
        if self.days:
            return [Day(d) for d in sorted(set(self.days))]
        from pyarrow import fs

        files, base = _opened(self.root)
        found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return [Day(f.base_name) for f in found if f.type == fs.FileType.Directory and _date(f.base_name)]

    def read(self, partition: Day | None) -> Iterator[tuple]:
        from pyarrow import fs

        if partition is None:  # no folder at all
            return
        files, base = _opened(self.root)
        day = _date(partition.name)
        for f in files.get_file_info(fs.FileSelector(f"{base}/{partition.name}", allow_not_found=True)):
            if f.type == fs.FileType.File and fnmatchcase(f.base_name, self.pattern):
                yield day, f"{self.root}/{partition.name}/{f.base_name}", f.base_name, f.mtime, f.size


def _date(name: str) -> date | None:
    try:
        return date(int(name[:4]), int(name[4:6]), int(name[6:])) if re.fullmatch(r"\d{8}", name) else None
    except ValueError:
        return None


class DayFolders(DataSource):
    """Plain files directly inside <root>/<yyyymmdd>. Options: root; days, comma-joined (all folders by default);
    pattern of file names. Folders that are not there have no rows, and a folder's folders are not entered.

    There is no stream of it: files come to a folder in no order of their names, so a last name seen does not tell
    what is new. Streams of files read their folders themselves (streaming.jobs.text_bodies)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DayFolderReader:
        return DayFolderReader(self.options)


def day_folders(spark: SparkSession, root: str, days: list[date] | None = None, pattern: str = "*") -> DataFrame:
    """(folder_date, path, name, modified, length) of the files in the day folders below `root`."""
    importable(spark)
    spark.dataSource.register(DayFolders)
    reader = spark.read.format(NAME).option("root", root).option("pattern", pattern)
    if days is not None:
        if not days:
            return spark.createDataFrame([], SCHEMA)
        reader = reader.option("days", ",".join(f"{d:%Y%m%d}" for d in days))
    return reader.load()
