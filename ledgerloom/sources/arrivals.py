"""The arrival ledger: which feed came in which run, against the calendar its contract declares.

Every run appends one row per feed that came. What did not come is found by comparing the run with the
declared feeds, so an absent feed is a row of the report and not a gap in it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.contracts import Register
from ledgerloom.sources.versions import VersionedTable

SCHEMA = "feed string, run_date date, rows long, bytes long, arrived_at timestamp"
# ISO week days as delivery windows name them; any other window means every day.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def calendar(spark: SparkSession, contracts: Register) -> DataFrame:
    """`feed, weekday` of the declared feeds; a null weekday means that the feed is due every day."""

    def weekday(feed: str) -> int | None:
        first = contracts[feed].delivery_window.split()[:1]
        return WEEKDAYS.index(first[0]) + 1 if first and first[0] in WEEKDAYS else None

    return spark.createDataFrame([(feed, weekday(feed)) for feed in contracts], "feed string, weekday int")


class ArrivalLedger:
    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.table = VersionedTable(spark, base)

    def record(self, run_date: dt.date, figures: DataFrame) -> None:
        """Append a run: `figures` has `feed, rows, bytes` of what came. A run told again is told anew."""
        day = F.lit(run_date)
        self.table.append(
            figures.select("feed", day.alias("run_date"), "rows", "bytes", F.current_timestamp().alias("arrived_at"))
        )

    def read(self) -> DataFrame:
        """One row per feed and run, the newest telling of each."""
        if self.table.current() is None:
            return self.spark.createDataFrame([], SCHEMA)
        told = F.struct("arrived_at", "rows", "bytes")
        newest = self.table.read().groupBy("feed", "run_date").agg(F.max(told).alias("t"))
        return newest.select("feed", "run_date", "t.rows", "t.bytes", "t.arrived_at")

    def report(self, contracts: Register, run_date: dt.date) -> DataFrame:
        """One row per declared feed: what came in this run, what came last before, and whether one is missing."""
        rows = self.read()
        last = rows.where(F.col("run_date") < F.lit(run_date)).groupBy("feed").agg(F.max_by("rows", "run_date").alias("previous"))
        now = rows.where(F.col("run_date") == F.lit(run_date)).select("feed", "rows", "bytes")
        judged = calendar(self.spark, contracts).join(now, "feed", "left").join(last, "feed", "left")
        due = F.col("weekday").isNull() | (F.col("weekday") == F.weekday(F.lit(run_date)) + 1)
        arrived = F.coalesce(F.col("rows"), F.lit(0)) > 0
        return judged.select(
            "feed",
            due.alias("due"),
            arrived.alias("arrived"),
            F.coalesce("rows", F.lit(0)).alias("row_count"),
            F.coalesce("previous", F.lit(0)).alias("previous_count"),
            (F.coalesce("rows", F.lit(0)) - F.coalesce("previous", F.lit(0))).alias("change"),
            F.when(arrived, "arrived").when(due, "absent").otherwise("not due").alias("status"),
        )
