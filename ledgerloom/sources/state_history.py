"""Type 2 history that lasts: every landed snapshot of a current-state feed adds to it.

A version of the history is one folder of open rows, replaced by each landing, and one folder per landing
of the rows closed by it, which are kept and never rewritten. A landing therefore writes as many rows as
are current plus those that changed, however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.scd2 import scd2_merge, scd2_start
from ledgerloom.sources.versions import Version, VersionedTable

# The watched columns of each feed with history, and its key.
WATCHED = {
    "customers": ("customer_id", ("segment", "kyc_status", "kyc_risk_band")),
    "accounts": ("account_id", ("product_code", "status")),
}


class OutOfOrder(ValueError):
    """A snapshot older than the newest landed one cannot be merged any more."""


class StateHistory:
    def __init__(self, spark: SparkSession, base: str, key: str, watched: Sequence[str]) -> None:
        self.table = VersionedTable(spark, base)
        self.key, self.watched = key, tuple(watched)

    def landed(self) -> list[str]:
        """The instants of all merged snapshots, oldest first."""
        current = self.table.current()
        return list(current.note["taken_at"]) if current else []

    def land(self, rows: DataFrame, taken_at: str) -> Version:
        """Merge one snapshot. One that has been merged already changes nothing."""
        current = self.table.current()
        done = self.landed() if current else []
        if taken_at in done:
            return current
        if done and taken_at < done[-1]:
            raise OutOfOrder(f"snapshot of {taken_at} after the one of {done[-1]}")
        at = F.lit(taken_at)
        if current is None:
            merged = scd2_start(rows, at)
        else:
            open_rows = self._read(current, current.note["open"])
            merged = scd2_merge(open_rows, _under(rows, open_rows.schema), self.key, self.watched, at)
        folder = self.table.new_folder()
        parted = merged.withColumn("row_state", F.when(F.col("valid_to").isNull(), "open").otherwise("closed"))
        parted.write.partitionBy("row_state").option("compression", "zstd").parquet(self.table.path(folder))
        wrote = self.table._files.exists
        opened = [f for f in [f"{folder}/row_state=open"] if wrote(self.table.path(f))]
        closed = [f for f in [f"{folder}/row_state=closed"] if wrote(self.table.path(f))]
        kept = list(current.note["closed"]) if current else []
        note = {"taken_at": [*done, taken_at], "open": opened, "closed": kept + closed}
        return self.table.commit(opened + kept + closed, note, _stored(merged.schema), current)

    def _read(self, version: Version, folders: list[str]) -> DataFrame:
        return self.table.read(Version(version.number, tuple(folders), version.note, version.schema))

    def read(self, as_landed: str | None = None) -> DataFrame:
        """The history, or what it was when the snapshot of `as_landed` was its newest."""
        if as_landed is None:
            return self.table.read()
        for version in self.table.versions():
            if version.note["taken_at"][-1] == as_landed:
                return self.table.read(version)
        raise LookupError(f"no landing of {as_landed}")


def _stored(schema: T.StructType) -> T.StructType:
    """Every column may be null once it has been written."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _under(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """A snapshot in the columns of the history; one the feed has lost is null, a new one is left out."""
    names = [f for f in schema.fields if f.name not in ("valid_from", "valid_to")]
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in names]
    )


def histories(spark: SparkSession, lake: str) -> dict[str, StateHistory]:
    return {
        feed: StateHistory(spark, f"{lake}/_history/{feed}", key, watched) for feed, (key, watched) in WATCHED.items()
    }
