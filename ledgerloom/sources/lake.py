"""Landing: contract gate first, then every delivered feed into Parquet under its canonical schema.

What a lake holds beside its tables:

    _files       which transaction files have been landed (`file_index`)
    _quarantine  rows that break a value rule of their contract, with the rules; they land all the same
    _history     Type 2 histories of the current-state feeds (`state_history`)
    _arrivals    which feed came in which run (`arrivals`)
    _ingest      the figures of the newest landing
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import checks
from ledgerloom.schemas import RAW_CUSTOMER
from ledgerloom.sources import contracts, feeds, readers, state_history
from ledgerloom.sources.arrivals import ArrivalLedger
from ledgerloom.sources.figures import partition_figures, table_figures
from ledgerloom.sources.file_index import Changes, FileIndex
from ledgerloom.sources.sinks import counted_write

TRANSACTIONS = "card_transactions"
FEW_FILES = 16  # a day, on average


def gate(spark: SparkSession, raw: str, folder: Path, fmt: str, force: bool = False) -> list[contracts.Verdict]:
    """The verdicts of all delivered feeds; raises before anything is written."""
    verdicts = contracts.check_all(contracts.load_contracts(folder), readers.observe_all(spark, raw, fmt))
    contracts.gate(verdicts, force)
    return verdicts


def _flat(raw: str) -> dict[str, tuple]:
    return {
        "customers": (readers.read_customers, f"{raw}/customers/customers.jsonl"),
        "accounts": (readers.read_accounts, f"{raw}/accounts/accounts.csv"),
        "cards": (readers.read_cards, f"{raw}/cards/cards.csv"),
        "merchants": (readers.read_merchants, f"{raw}/merchants/merchants.parquet"),
        "fx_rates": (readers.read_fx_rates, raw),
    }


def land(
    spark: SparkSession,
    raw: str,
    lake: str,
    folder: Path = contracts.BUNDLED,
    fmt: str = "avro",
    force: bool = False,
    taken_at: str | None = None,
    run_date: dt.date | None = None,
) -> DataFrame:
    """Land a delivery; returns (and keeps under `_ingest`) what the lake holds of each delivered feed.

    A feed that did not come keeps its last state. Of the transactions only days with new, changed or
    vanished files are landed. With `taken_at` the current-state feeds are merged into their histories as
    of that instant; with `run_date` the run is entered in the arrival ledger.
    """
    verdicts = gate(spark, raw, folder, fmt, force)
    came = [v.feed for v in verdicts]
    for feed, (read, path) in _flat(raw).items():
        if feed in came:
            # A scan packs small files and splits large ones, so the rows are written on where they are read.
            counted_write(read(spark, path), f"{lake}/{feed}", arranged=True)
    days = land_transactions(spark, raw, lake, folder, fmt).days if TRANSACTIONS in came else []
    quarantine(spark, lake, came, folder)
    if taken_at:
        land_state(spark, lake, taken_at, came)
    metrics = landed_figures(spark, lake, came)
    told = contracts.verdict_table(spark, verdicts).select("feed", "verdict", "message")
    metrics = metrics.join(told, "feed", "left")
    metrics.write.mode("overwrite").json(f"{lake}/_ingest")
    if run_date:
        ArrivalLedger(spark, f"{lake}/_arrivals").record(run_date, arrived(spark, lake, metrics, days))
    return metrics


def land_transactions(spark: SparkSession, raw: str, lake: str, folder: Path, fmt: str) -> Changes:
    """The days whose files changed since the last landing, replaced whole."""
    base = f"{raw}/{TRANSACTIONS}"
    index = FileIndex(spark, f"{lake}/_files")
    changes = index.changes(base, lambda path: readers.writer_version(spark, path, fmt))
    if changes.days:
        avro_schema = (Path(folder) / "card_transactions.v2.avsc").read_text() if fmt == "avro" else None
        rows = readers.read_transactions(spark, base, fmt, avro_schema, changes.files, changes.days)
        # Files of one day each, as they were delivered: at most a few a day, there is nothing to merge.
        landed = changes.files.where(F.col("day").isin(changes.days))
        arranged = landed.count() <= FEW_FILES * len(changes.days)
        counted_write(rows, f"{lake}/{TRANSACTIONS}", "posted_date", arranged)
    changes.commit()
    return changes


def land_state(spark: SparkSession, lake: str, taken_at: str, came: Iterable[str] = tuple(state_history.WATCHED)) -> None:
    """Merge the landed current state into the histories."""
    stage = {"customers": feeds.stage_customers, "accounts": feeds.stage_accounts}
    for feed, history in state_history.histories(spark, lake).items():
        if feed in came:
            history.land(stage[feed](feeds.scan_lake(spark, lake, feed)), taken_at)


def _in_contract_shape(spark: SparkSession, lake: str, feed: str) -> DataFrame:
    """A landed feed under the field names of its contract."""
    if feed == "customers":
        documents = feeds.scan_lake(spark, lake, feed, ["document"])
        # As a generator: a filter on the fields stays above it and does not parse the document again for each of them.
        return documents.select(F.inline(F.array(F.from_json("document", RAW_CUSTOMER))))
    return feeds.scan_lake(spark, lake, feed)


def quarantine(spark: SparkSession, lake: str, landed: Iterable[str], folder: Path = contracts.BUNDLED) -> None:
    """Tag the rows of the landed feeds that break a value rule of their contract files: one pass a feed."""
    for feed in landed:
        rules, key = contracts.feed_rules(folder, feed)
        broken = contracts.broken_rows(_in_contract_shape(spark, lake, feed), rules, key)
        broken.hint("rebalance").write.mode("overwrite").parquet(f"{lake}/_quarantine/{feed}")


def quarantined(spark: SparkSession, lake: str, landed: Iterable[str]) -> DataFrame:
    """`feed, check, violations` over the tags of all feeds; rules that nothing breaks have no row."""
    parts = [
        spark.read.parquet(f"{lake}/_quarantine/{feed}")
        .select(F.explode("broken").alias("check"))
        .groupBy("check")
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(feed).alias("feed"), "check", "violations")
        for feed in landed
    ]
    return checks.union_all(parts)


def landed_figures(spark: SparkSession, lake: str, landed: Iterable[str]) -> DataFrame:
    """`feed, rows, bytes, partitions`: what lies in the lake, by file footers and file status."""
    parts = []
    for feed in landed:
        by = "posted_date" if feed == TRANSACTIONS else None
        figures = table_figures(spark, f"{lake}/{feed}", by)
        parts.append(figures.select(F.lit(feed).alias("feed"), "rows", "bytes", "partitions"))
    return checks.union_all(parts)


def arrived(spark: SparkSession, lake: str, landed: DataFrame, days: list[dt.date]) -> DataFrame:
    """`feed, rows, bytes` of one run: whole states as they are, and the days of transactions that it landed."""
    states = landed.where(F.col("feed") != TRANSACTIONS).select("feed", "rows", "bytes")
    if not days:
        return states
    of_run = partition_figures(spark, f"{lake}/{TRANSACTIONS}", "posted_date").where(F.col("posted_date").isin(days))
    return states.unionByName(of_run.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).select(
        F.lit(TRANSACTIONS).alias("feed"), "rows", "bytes"
    ))


def row_conservation(spark: SparkSession, raw_counts: dict[str, DataFrame], lake: str) -> DataFrame:
    """Raw and landed rows per feed; `lost` must be zero."""
    parts = []
    for feed, raw in raw_counts.items():
        landed = spark.read.parquet(f"{lake}/{feed}").agg(F.count(F.lit(1)).alias("n")).scalar()
        one = raw.agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("lake_rows", landed)
        parts.append(one.select(F.lit(feed).alias("feed"), "raw_rows", "lake_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("lost", F.col("raw_rows") - F.col("lake_rows"))
