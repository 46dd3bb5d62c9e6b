"""The staged feeds the marts are built from, and their reading from a landed lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_utc, home_date
from ledgerloom.schemas import LAKE_FLAT, LAKE_TRANSACTIONS_READ
from ledgerloom.sources import state_history


GROUP = "feed_group"


@dataclass(frozen=True)
class Snapshot:
    """A current-state feed and the UTC instant it was taken at."""

    taken_at: str
    rows: DataFrame


@dataclass(frozen=True)
class Feeds:
    transactions: DataFrame
    customers: tuple[Snapshot, ...]
    accounts: tuple[Snapshot, ...]
    cards: DataFrame
    merchants: DataFrame
    fx_rates: DataFrame
    # The lasting histories, where a lake keeps them; else they are merged from the snapshots.
    customer_history: DataFrame | None = None
    account_history: DataFrame | None = None
    # The same transactions with `GROUP`, of which every copy of an id has the same value, distributed by it.
    grouped_transactions: DataFrame | None = None


def with_auth_date(transactions: DataFrame) -> DataFrame:
    """UTC timestamps without zone, and the London date of the authorisation."""
    utc = transactions.withColumn("txn_timestamp", as_utc(transactions, "txn_timestamp"))
    return utc.withColumn("auth_date", home_date(utc, "txn_timestamp"))


def stage_customers(lake: DataFrame) -> DataFrame:
    created, verified = as_utc(lake, "created_at"), as_utc(lake, "kyc_verified_at")
    return lake.select(
        "customer_id", created.alias("onboarded_at"), F.to_date(created).alias("onboarded_on"), "segment",
        "marketing_consent", "first_name", "last_name", "date_of_birth", "email", "phone", "address_line1", "city",
        "postcode", "country", "kyc_status", verified.alias("kyc_verified_at"), "kyc_risk_band", "document",
    )


def stage_accounts(lake: DataFrame) -> DataFrame:
    return lake.select(
        "account_id", "customer_id", "product_code", "currency", "status",
        F.col("opened_date").alias("opened_on"), F.col("closed_date").alias("closed_on"), "overdraft_limit_minor",
    )


def stage_cards(lake: DataFrame) -> DataFrame:
    return lake.select(
        "card_id", "account_id", "card_type", "network",
        F.col("issued_date").alias("issued_on"), F.col("expiry_date").alias("expires_on"), "status",
    )


def stage_merchants(lake: DataFrame) -> DataFrame:
    return lake.withColumnRenamed("first_seen_date", "first_seen_on")


def stage_fx_rates(lake: DataFrame) -> DataFrame:
    return lake.withColumn("rate_to_gbp", F.col("rate_to_gbp").cast("double"))


def scan_lake(spark: SparkSession, lake: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A lake table under its declared schema, optionally only some columns of it.

    Transactions recover `posted_date` from the directory names.
    """
    schema = LAKE_TRANSACTIONS_READ if table == "card_transactions" else LAKE_FLAT[table]
    df = spark.read.schema(schema).parquet(f"{lake}/{table}")
    return df.select(*columns) if columns else df


def load(spark: SparkSession, lake: str, taken_at: str | None = None) -> Feeds:
    """The feeds as landed.

    Without `taken_at` the Type 2 histories are those that the lake's landings have built up; with it they
    start from the current state, taken at that instant.
    """
    kept = state_history.histories(spark, lake) if taken_at is None else {}
    landed = {feed: history.landed() for feed, history in kept.items()}
    if taken_at is None and not all(landed.values()):
        raise LookupError(f"{lake} keeps no history of {', '.join(f for f, done in landed.items() if not done)}")
    at = {feed: done[-1] for feed, done in landed.items()} or dict.fromkeys(state_history.WATCHED, taken_at)
    return Feeds(
        transactions=scan_lake(spark, lake, "card_transactions"),
        customers=(Snapshot(at["customers"], stage_customers(scan_lake(spark, lake, "customers"))),),
        accounts=(Snapshot(at["accounts"], stage_accounts(scan_lake(spark, lake, "accounts"))),),
        cards=stage_cards(scan_lake(spark, lake, "cards")),
        merchants=stage_merchants(scan_lake(spark, lake, "merchants")),
        fx_rates=stage_fx_rates(scan_lake(spark, lake, "fx_rates")),
        customer_history=kept["customers"].read() if kept else None,
        account_history=kept["accounts"].read() if kept else None,
    )
