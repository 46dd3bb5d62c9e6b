"""Which files of a feed have been landed, and which writer each came from.

A delivery's folder grows for years. The index remembers every file by path, size and modification time
with the version its own footer or header told, so a landing opens the files that came since and no
others, and lands the days they belong to again. The index is a versioned table: it moves on when the
landing that it describes has been written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.versions import Version, VersionedTable

SCHEMA = "path string, day date, file string, bytes long, modified timestamp, feed_version tinyint"
AT_ONCE = 16


def listed(spark: SparkSession, base: str) -> DataFrame:
    """`path, day, file, bytes, modified` of all files below day directories; nothing is opened.

    Spark lists large trees in parallel, and the file content is a column nobody asks for.
    """
    try:
        files = spark.read.format("binaryFile").load(base)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA).drop("feed_version")
    return files.select(
        "path",
        F.regexp_extract("path", r"=([^/=]*)/[^/]*$", 1).try_cast("date").alias("day"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    ).where("day IS NOT NULL")


def versions_of(spark: SparkSession, files: DataFrame, look: Callable[[str], int]) -> DataFrame:
    """`files` with the version that each one's own header or footer tells, some at a time."""
    paths = [r["path"] for r in files.select("path").collect()]
    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        found = list(zip(paths, pool.map(look, paths), strict=True))
    told = spark.createDataFrame(found, "path string, feed_version tinyint")
    return files.join(told, "path")


@dataclass(frozen=True)
class Changes:
    """What a landing has to do, and the index to commit once it is done."""

    files: DataFrame
    opened: int
    days: list[dt.date]
    _table: VersionedTable
    _before: Version | None
    _folder: str | None

    def commit(self) -> None:
        if self._folder is not None:
            self._table.commit([self._folder], {"opened": self.opened}, self.files.schema, self._before)


class FileIndex:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.table = VersionedTable(spark, base)

    def read(self) -> DataFrame:
        before = self.table.current()
        return self.table.read(before) if before else self.spark.createDataFrame([], SCHEMA)

    def changes(self, base: str, look: Callable[[str], int]) -> Changes:
        """Compare the folder with the index. Days with a new, changed or vanished file are to be landed again."""
        before, known, now = self.table.current(), self.read(), listed(self.spark, base)
        same, there = ["path", "bytes", "modified"], now.select("day").distinct()
        fresh = now.join(known, same, "left_anti")
        told = versions_of(self.spark, fresh, look)
        # Days that this delivery does not mention stay as they are.
        stayed = known.join(now.select(*same), same, "left_semi").unionByName(known.join(there, "day", "left_anti"))
        gone = known.join(now, same, "left_anti").join(there, "day", "left_semi")
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        folder = self.table.new_folder()
        stayed.select(*names).unionByName(told.select(*names)).write.parquet(self.table.path(folder))
        index = self.spark.read.schema(SCHEMA).parquet(self.table.path(folder))
        new = index.join(known, same, "left_anti")
        days = {r["day"] for r in new.select("day").unionByName(gone.select("day")).distinct().collect()}
        return Changes(index, new.count(), sorted(days), self.table, before, folder if days else None)
