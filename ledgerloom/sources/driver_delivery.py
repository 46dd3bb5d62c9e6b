"""The test tables delivered in wire form and landed, so that the ingest path runs on given data.

Card transactions come monthly, from the middle of one month to the middle of the next. The month of the
change-over holds files of both feed versions.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.checks import union_all
from ledgerloom.plans import monitors
from ledgerloom.schemas import FIELDS_ADDED_IN_V2, RAW_TRANSACTIONS
from ledgerloom.session import new_folder, write_and_reload
from ledgerloom.sources import contracts, feeds, lake, readers, sinks, state_history
from ledgerloom.sources.arrivals import ArrivalLedger
from ledgerloom.sources.feeds import Feeds
from ledgerloom.sources.figures import partition_figures
from ledgerloom.sources.state_history import StateHistory


class Delivery:
    """One delivery: `raw` in wire form, `lake` landed from it, each made when first asked for."""

    def __init__(self, spark: SparkSession, staged: Feeds) -> None:
        self.spark = spark
        self.staged = staged

    @cached_property
    def raw(self) -> str:
        base = new_folder(self.spark, "delivery")
        self.write_state(base, -1)
        self.write_cards(base)
        self.write_merchants(base)
        self._write_rates(f"{base}/fx_rates")
        self._write_transactions(f"{base}/card_transactions")
        return base

    def write_state(self, base: str, snapshot: int) -> None:
        """The two feeds that deliver their whole current state."""
        s = self.staged
        s.customers[snapshot].rows.select("document").write.mode("overwrite").text(f"{base}/customers/customers.jsonl")
        accounts = s.accounts[snapshot].rows.withColumnsRenamed({"opened_on": "opened_date", "closed_on": "closed_date"})
        sinks.write_feed(accounts, f"{base}/accounts/accounts.csv", "csv")

    def write_cards(self, base: str) -> None:
        cards = self.staged.cards.withColumnsRenamed({"issued_on": "issued_date", "expires_on": "expiry_date"})
        sinks.write_feed(cards, f"{base}/cards/cards.csv", "csv")

    def write_merchants(self, base: str) -> None:
        merchants = self.staged.merchants.withColumnRenamed("first_seen_on", "first_seen_date")
        sinks.write_feed(merchants, f"{base}/merchants/merchants.parquet", "parquet")

    def _write_rates(self, path: str) -> None:
        """One JSON array per month: a few currencies for each of its days."""
        rates = self.staged.fx_rates
        arrays = rates.groupBy(F.trunc("rate_date", "month").alias("month")).agg(
            F.sort_array(F.collect_list(F.struct(*rates.columns))).alias("rates")
        )
        text = arrays.select(F.to_json("rates").alias("value"), F.col("month").alias("rate_date"))
        text.hint("rebalance", "rate_date").write.partitionBy("rate_date").text(path)

    def _write_transactions(self, path: str) -> None:
        rows = self.staged.transactions
        # Wire instants carry a zone; staged ones are the same instants in UTC.
        wire = rows.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp")).withColumn(
            "day", F.trunc(F.date_add("posted_date", 15), "month")
        )
        for version in (1, 2):
            gone = FIELDS_ADDED_IN_V2 if version == 1 else ()
            names = [n for n in RAW_TRANSACTIONS.names if n not in (*gone, "posted_date")]
            part = wire.where(F.col("feed_version") == version).select(*names, F.col("day").alias("posted_date"))
            part.hint("rebalance", "posted_date").write.mode("append").partitionBy("posted_date").parquet(path)

    @cached_property
    def _landed(self) -> tuple[str, DataFrame]:
        target = new_folder(self.spark, "landed")
        return target, lake.land(self.spark, self.raw, target, fmt="parquet")

    @property
    def lake(self) -> str:
        return self._landed[0]

    @property
    def metrics(self) -> DataFrame:
        return self._landed[1]

    def table(self, name: str) -> DataFrame:
        return feeds.scan_lake(self.spark, self.lake, name)


def transactions(d: Delivery) -> DataFrame:
    return d.table("card_transactions").withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp_ntz"))


def versions(d: Delivery) -> DataFrame:
    """What each version left in the one frame that the reader makes of both."""
    return transactions(d).groupBy("feed_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("pos_entry_mode").alias("with_entry_mode"),
        F.count("is_recurring").alias("with_recurring"),
        F.countDistinct("posted_date").alias("days"),
    )


def customers(d: Delivery) -> DataFrame:
    utc = {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "kyc_verified_at")}
    return d.table("customers").withColumns(utc)


def landed_metrics(d: Delivery) -> DataFrame:
    """Figures from footers and file status; the size in bytes is the store's own affair, so only whether it is known."""
    return d.metrics.select("feed", "rows", "partitions", (F.col("bytes") > 0).alias("has_bytes"), "verdict")


def row_conservation(d: Delivery) -> DataFrame:
    """Rows in wire form, counted by its own readers, against rows in the lake."""
    sources = {
        "customers": readers.read_customers(d.spark, f"{d.raw}/customers/customers.jsonl"),
        "accounts": readers.read_accounts(d.spark, f"{d.raw}/accounts/accounts.csv"),
        "cards": readers.read_cards(d.spark, f"{d.raw}/cards/cards.csv"),
        "merchants": readers.read_merchants(d.spark, f"{d.raw}/merchants/merchants.parquet"),
        "fx_rates": readers.read_fx_rates(d.spark, d.raw),
        "card_transactions": readers.read_transactions(d.spark, f"{d.raw}/card_transactions", "parquet"),
    }
    return lake.row_conservation(d.spark, sources, d.lake)


def contract_verdicts(d: Delivery) -> DataFrame:
    told = contracts.check_all(contracts.load_contracts(contracts.BUNDLED), readers.observe_all(d.spark, d.raw, "parquet"))
    return contracts.verdict_table(d.spark, told).select("feed", "verdict")


# ------------------------------------------------------------------ a delivery that breaks its contracts


class FaultyDelivery(Delivery):
    """The same tables with a renamed field, a field too many, and values outside the code lists.

    Every fault is arithmetic on the keys of the given rows.
    """

    def write_state(self, base: str, snapshot: int) -> None:
        s = self.staged
        people = s.customers[snapshot].rows
        number = F.substring("customer_id", 5, 9).cast("long")
        document = F.when(number % 41 == 3, F.replace("document", F.lit('"country":"GB"'), F.lit('"country":"XX"')))
        people.select(F.coalesce(document, F.col("document")).alias("document")).write.text(f"{base}/customers/customers.jsonl")
        accounts = s.accounts[snapshot].rows.withColumnsRenamed(
            {"opened_on": "opened_date", "closed_on": "closed_date", "product_code": "product"}
        )
        sinks.write_feed(accounts, f"{base}/accounts/accounts.csv", "csv")

    def write_cards(self, base: str) -> None:
        number = F.substring_index("card_id", "-", -1).cast("long")
        cards = self.staged.cards.withColumnsRenamed({"issued_on": "issued_date", "expires_on": "expiry_date"})
        odd = F.when(number % 37 == 5, "amex").otherwise(F.col("network"))
        sinks.write_feed(cards.withColumn("network", odd), f"{base}/cards/cards.csv", "csv")

    def write_merchants(self, base: str) -> None:
        number = F.substring_index("merchant_id", "-", -1).cast("long")
        merchants = self.staged.merchants.withColumnRenamed("first_seen_on", "first_seen_date")
        merchants = merchants.withColumn("country", F.when(number % 29 != 0, F.col("country")))
        sinks.write_feed(merchants.withColumn("vendor_score", number % 5), f"{base}/merchants/merchants.parquet", "parquet")

    def _write_transactions(self, path: str) -> None:
        line = F.substring_index("transaction_id", "-", -1).cast("long")
        rows = self.staged.transactions
        rows = rows.withColumn("channel", F.when((line == 7) & (F.col("mcc") == 5411), "teleport").otherwise(F.col("channel")))
        Delivery(self.spark, replace(self.staged, transactions=rows))._write_transactions(path)

    @cached_property
    def refusal(self) -> str:
        """What the gate says; nothing has been landed then."""
        target = new_folder(self.spark, "refused")
        try:
            lake.land(self.spark, self.raw, target, fmt="parquet")
        except contracts.SchemaDriftError as drift:
            return str(drift)
        return ""

    @cached_property
    def _landed(self) -> tuple[str, DataFrame]:
        target = new_folder(self.spark, "landed")
        return target, lake.land(self.spark, self.raw, target, fmt="parquet", force=True)


def faulty_verdicts(d: FaultyDelivery) -> DataFrame:
    """Every feed's verdict with its message and people, and whether the gate refused the batch."""
    told = contracts.check_all(contracts.load_contracts(contracts.BUNDLED), readers.observe_all(d.spark, d.raw, "parquet"))
    table = contracts.verdict_table(d.spark, told)
    return table.select("feed", "verdict", "message", "owner", "producer", F.lit(bool(d.refusal)).alias("refused"))


def verdict_summary(d: FaultyDelivery) -> DataFrame:
    told = contracts.check_all(contracts.load_contracts(contracts.BUNDLED), readers.observe_all(d.spark, d.raw, "parquet"))
    found = contracts.summarise(contracts.verdict_table(d.spark, told))
    return found.select("verdict", "feeds", F.array_join("names", ", ").alias("names"))


def value_rule_violations(d: FaultyDelivery) -> DataFrame:
    """The tags of the quarantine over all six feeds of the forced landing."""
    return lake.quarantined(d.spark, d.lake, [r["feed"] for r in d.metrics.select("feed").collect()])


# ------------------------------------------------------------------ deliveries that follow one another


class StateDeliveries:
    """The snapshots of the current-state feeds, delivered and merged one after another into one lake."""

    def __init__(self, spark: SparkSession, staged: Feeds) -> None:
        self.spark = spark
        self.staged = staged

    @cached_property
    def lake(self) -> str:
        target = new_folder(self.spark, "state-lake")
        wire = Delivery(self.spark, self.staged)
        for i, snapshot in enumerate(self.staged.customers):
            raw = new_folder(self.spark, "state")
            wire.write_state(raw, i)
            lake.land(self.spark, raw, target, fmt="parquet", taken_at=snapshot.taken_at)
        # The newest delivery comes a second time, which changes nothing.
        lake.land(self.spark, raw, target, fmt="parquet", taken_at=snapshot.taken_at)
        return target

    def history(self, feed: str) -> StateHistory:
        return state_history.histories(self.spark, self.lake)[feed]


def landed_versions(d: StateDeliveries) -> DataFrame:
    """Open and closed customer rows after each landing, each read from its own committed version."""
    history = d.history("customers")
    parts = []
    for number, taken_at in enumerate(history.landed(), start=1):
        closed = F.count("valid_to").alias("closed_rows")
        counted = history.read(taken_at).agg((F.count(F.lit(1)) - F.count("valid_to")).alias("open_rows"), closed)
        parts.append(counted.select(F.lit(number).alias("version"), F.lit(taken_at).alias("taken_at"), "open_rows", "closed_rows"))
    return union_all(parts)


DAYS = 60
MISSING, BURST = 45, 52


class DailyDeliveries:
    """The newest days of card transactions, landed as day partitions in two runs.

    One day never comes, one comes with every row three times. The first run holds all six feeds and the
    days before the last ten, the second the rest and no merchants.
    """

    def __init__(self, spark: SparkSession, staged: Feeds) -> None:
        self.spark = spark
        self.staged = staged

    def newest_rows(self, rates: DataFrame) -> tuple[DataFrame, dt.date]:
        """Transactions that hold the newest `DAYS` days, and the newest day.

        Rates end near the newest day, so the rows from twice as long before are made and written once, and both
        runs read them. Where they do not reach back far enough after all, the whole book is asked.
        """
        rows, newest = self.staged.transactions, F.max("posted_date")
        near = rates.agg(F.max("rate_date")).first()[0]
        if near is not None:
            kept = rows.where(F.col("posted_date") > F.lit(near - dt.timedelta(days=2 * DAYS)))
            kept, _ = write_and_reload(kept, new_folder(self.spark, "newest-days"))
            last = kept.agg(newest).first()[0]
            if last is not None and last - near >= dt.timedelta(days=-DAYS):
                return kept, last
        return rows, rows.agg(newest).first()[0]

    @cached_property
    def _runs(self) -> tuple[str, list[dt.date]]:
        raw, target = new_folder(self.spark, "daily"), new_folder(self.spark, "daily-lake")
        rates, _ = write_and_reload(self.staged.fx_rates, new_folder(self.spark, "rates"))
        rows, last = self.newest_rows(rates)
        place = F.datediff("posted_date", F.lit(last - dt.timedelta(days=DAYS - 1)))
        rows = rows.where(place >= 0).withColumn("place", place)
        rows = rows.where(F.col("place") != MISSING)
        times = F.when(F.col("place") == BURST, 3).otherwise(1)
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), times))).drop("copy")
        rows = rows.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp"))
        wire = Delivery(self.spark, replace(self.staged, fx_rates=rates))
        runs = [last - dt.timedelta(days=10), last + dt.timedelta(days=1)]
        names = [n for n in RAW_TRANSACTIONS.names if n != "posted_date"]
        for run, (low, high) in zip(runs, ((0, DAYS - 10), (DAYS - 10, DAYS)), strict=True):
            part = rows.where((F.col("place") >= low) & (F.col("place") < high)).select(*names, "posted_date")
            if run == runs[0]:
                wire.write_state(raw, -1)
                wire.write_cards(raw)
                wire.write_merchants(raw)
                wire._write_rates(f"{raw}/fx_rates")
                base = raw
            else:  # the second delivery: files are added to the transactions, the merchants are not there
                base = new_folder(self.spark, "daily")
                wire.write_state(base, -1)
                wire.write_cards(base)
                wire._write_rates(f"{base}/fx_rates")
            part.hint("rebalance", "posted_date").write.mode("append").partitionBy("posted_date").parquet(
                f"{base}/card_transactions"
            )
            lake.land(self.spark, base, target, fmt="parquet", run_date=run)
        return target, runs

    @property
    def lake(self) -> str:
        return self._runs[0]


def landed_freshness(d: DailyDeliveries) -> DataFrame:
    landed = partition_figures(d.spark, f"{d.lake}/card_transactions", "posted_date")
    return monitors.landed_freshness(landed)


def arrival_report(d: DailyDeliveries) -> DataFrame:
    """The second run against the declared calendar and the run before."""
    ledger = ArrivalLedger(d.spark, f"{d.lake}/_arrivals")
    return ledger.report(contracts.load_contracts(contracts.BUNDLED), d._runs[1][-1])
