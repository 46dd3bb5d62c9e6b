"""Versioned tables: numbered snapshot folders, and a commit file written last.

    base/data/<number>-<random>/...   what one write left, never changed again
    base/commits/<number>.json        which folders a version is made of, its schema and notes

Rows are first staged in a folder that no reader knows, and become a version when the commit file of the
next number is created; creating it fails if another writer was first. A reader takes the highest number,
so it sees the old version or the new one and nothing between. A version may reuse folders of older ones:
appending writes the new rows only. All files are reached through Hadoop's file system, wherever they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class CommitConflict(RuntimeError):
    """Another writer committed this version number first."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]
    note: dict[str, Any] = field(default_factory=dict)
    schema: str | None = None


class Files:
    """The few file operations that commits need."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self._jvm = spark._jvm
        self._fs = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """False if the file was there already."""
        target = self._path(path)
        try:
            stream = self._fs.create(target, False)
        except Py4JJavaError as failure:
            if self._fs.exists(target):
                return False
            raise failure
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        return True

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self._files = Files(spark, self.base)

    def versions(self) -> list[Version]:
        """All committed versions, oldest first."""
        names = [n for n in self._files.names(f"{self.base}/commits") if n.endswith(".json") and n[0] not in "._"]
        return [v for v in map(self._version, names) if v is not None]

    def _version(self, name: str) -> Version | None:
        text = self._files.read(f"{self.base}/commits/{name}")
        if not text.endswith("\n"):  # being written at this moment
            return None
        told = json.loads(text)
        return Version(int(name[:-5]), tuple(told["folders"]), told["note"], told["schema"])

    def current(self) -> Version | None:
        names = [n for n in self._files.names(f"{self.base}/commits") if n.endswith(".json") and n[0] not in "._"]
        for name in reversed(names):
            version = self._version(name)
            if version is not None:
                return version
        return None

    def new_folder(self) -> str:
        """Where the next version may be staged; no reader looks there before it is committed."""
        number = (self.current() or Version(0, ())).number + 1
        return f"data/{number:06d}-{uuid.uuid4().hex[:8]}"

    def path(self, folder: str) -> str:
        return f"{self.base}/{folder}"

    def commit(
        self,
        folders: Sequence[str],
        note: dict[str, Any] | None = None,
        schema: T.StructType | None = None,
        after: Version | None = None,
    ) -> Version:
        """Make staged folders the next version. `after`: the version the rows were made from, if any."""
        number = (after.number if after else 0) + 1
        version = Version(number, tuple(folders), note or {}, schema.json() if schema else None)
        told = {"folders": list(folders), "note": version.note, "schema": version.schema}
        if not self._files.create(f"{self.base}/commits/{number:06d}.json", json.dumps(told, default=str) + "\n"):
            raise CommitConflict(f"version {number} of {self.base} was committed by another writer")
        return version

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the current one unless told otherwise."""
        version = version or self.current()
        if version is None:
            raise LookupError(f"{self.base} has no committed version")
        schema = T.StructType.fromJson(json.loads(version.schema))
        if not version.folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(f) for f in version.folders])

    def write(self, df: DataFrame, note: dict[str, Any] | None = None) -> Version:
        """Replace the whole table with one more version."""
        before = self.current()
        folder = self.new_folder()
        df.write.option("compression", "zstd").parquet(self.path(folder))
        return self.commit([folder], note, df.schema, before)

    def append(self, df: DataFrame, note: dict[str, Any] | None = None) -> Version:
        """One more version: the rows of the current one and these."""
        before = self.current()
        folder = self.new_folder()
        df.write.option("compression", "zstd").parquet(self.path(folder))
        return self.commit([*(before.folders if before else ()), folder], note, df.schema, before)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove folders that none of the newest `keep` versions uses, staged leftovers included.

        Only for times without a writer: a folder staged and not yet committed looks like a leftover.
        """
        used = {f.split("/")[1] for v in self.versions()[-keep:] for f in v.folders}
        gone = [name for name in self._files.names(f"{self.base}/data") if name not in used]
        for name in gone:
            self._files.remove(f"{self.base}/data/{name}")
        return gone
