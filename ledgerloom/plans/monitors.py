"""Service-level monitors and the publish gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import count_if, sum_if
from ledgerloom.operators import checks
from ledgerloom.operators.asof import daily
from ledgerloom.operators.declared import Accepted, Check, NotNull, Relationship, Unique, run
from ledgerloom.operators.rules import FLAGS
from ledgerloom.operators.scd2 import scd2_overlaps
from ledgerloom.plans import reports, spend
from ledgerloom.plans.marts import UNKNOWN
from ledgerloom.plans.warehouse import Warehouse

TRAILING_DAYS = 28
SIGMAS = 3
DOCUMENT_TOLERANCE = 0.01

# Pass-rate objectives per quality dimension.
OBJECTIVES = {
    "completeness": 0.995,
    "consistency": 0.995,
    "uniqueness": 0.999,
    "validity": 0.999,
    "accuracy": 0.999,
    "timeliness": 0.99,
}


def freshness(transactions: DataFrame) -> DataFrame:
    """Each posted day's row count against the days before it (`day_freshness`)."""
    return day_freshness(transactions.groupBy("posted_date").agg(F.count(F.lit(1)).alias("n")))


def day_freshness(daily: DataFrame) -> DataFrame:
    """`(posted_date, n)` against the mean +- 3 sigma of the 28 calendar days before each day.

    A day is sent to the 28 days that look back on it, so the history of a day is an equality
    group instead of a frame of one global window. The variance is built from integer sums.
    """
    ahead = F.sequence(F.date_add("posted_date", 1), F.date_add("posted_date", TRAILING_DAYS))
    history = (
        daily.select(F.explode(ahead).alias("posted_date"), F.col("n").alias("past"))
        .groupBy("posted_date")
        .agg(F.count(F.lit(1)).alias("days"), F.sum("past").alias("s1"), F.sum(F.col("past") * F.col("past")).alias("s2"))
    )
    days, s1, s2 = (F.col(c).cast("double") for c in ("days", "s1", "s2"))
    spread = (days * s2 - s1 * s1) / F.nullif(days * (days - 1), F.lit(0.0))
    judged = daily.join(history, "posted_date", "left").withColumns({"mean": s1 / days, "sigma": F.sqrt(spread)})
    inside = F.abs(F.col("n") - F.col("mean")) <= SIGMAS * F.col("sigma")
    return judged.select(
        "posted_date", F.col("n").alias("txn_count"), F.coalesce("days", F.lit(0)).alias("history_days"),
        F.round("mean", 6).alias("trailing_mean"), F.round("sigma", 6).alias("trailing_sigma"),
        inside.alias("within_limits"),
    )


def landed_freshness(partitions: DataFrame) -> DataFrame:
    """Freshness of the landed day partitions `(posted_date, rows)`: repeated rows count, and a day of the
    span without a partition is a row with `arrived` false."""
    span = partitions.agg(F.min("posted_date").alias("first"), F.max("posted_date").alias("last"))
    days = span.select(daily(F.col("first"), F.col("last")).alias("posted_date"))
    judged = day_freshness(partitions.select("posted_date", F.col("rows").alias("n")))
    out = days.join(judged, "posted_date", "left").withColumn("arrived", F.col("txn_count").isNotNull())
    return out.withColumn("txn_count", F.coalesce("txn_count", F.lit(0)))


def fresh_yesterday(transactions: DataFrame, run_date: Column) -> DataFrame:
    """One row: did the day before `run_date` arrive, with a plausible number of rows?"""
    due = F.date_sub(run_date, 1)
    day = freshness(transactions).where(F.col("posted_date") == due)
    arrived = F.count(F.lit(1)) > 0
    return day.agg(
        F.max(due).alias("due_date"),
        arrived.alias("arrived"),
        (arrived & F.coalesce(F.bool_and("within_limits"), F.lit(False))).alias("fresh"),
    )


def fx_coverage(w: Warehouse) -> DataFrame:
    """One row: (day, currency) pairs in use, and those with neither a rate nor a carry."""
    used = w.deduped.groupBy(F.col("posted_date").alias("rate_date"), "currency").agg(F.count(F.lit(1)).alias("n"))
    rated = w.fx_rate.where(F.col("rate_to_gbp").isNotNull()).select("rate_date", "currency", F.lit(1).alias("rated"))
    judged = used.join(rated, ["rate_date", "currency"], "left")
    return judged.agg(
        F.count(F.lit(1)).alias("pairs_in_use"),
        F.count(F.when(F.col("rated").isNull(), F.lit(1))).alias("pairs_without_rate"),
    )


def carried_forward_days(w: Warehouse) -> DataFrame:
    """Missing rate days per currency, and the transactions priced from a carried rate."""
    days = w.fx_rate.groupBy("currency").agg(F.sum(F.col("is_carried_forward").cast("bigint")).alias("carried_days"))
    rows = w.fact.groupBy(F.col("currency_key").alias("currency")).agg(
        F.sum(F.col("fx_rate_carried_forward").cast("bigint")).alias("carried_txns")
    )
    return days.join(rows, "currency", "left")


def document_count(w: Warehouse) -> DataFrame:
    documents = w.customer_document.agg(F.count(F.lit(1)).alias("n")).scalar()
    current = spend.current_customers(w).agg(F.count(F.lit(1)).alias("current_customers"))
    n, people = F.col("documents"), F.col("current_customers")
    return current.withColumn("documents", documents).select(
        "documents", "current_customers", (F.abs(n - people) <= DOCUMENT_TOLERANCE * people).alias("within_tolerance")
    )


def quality_objectives(w: Warehouse) -> DataFrame:
    pairs = [F.lit(part) for item in OBJECTIVES.items() for part in item]
    objective = F.create_map(*pairs)[F.col("dimension")]
    status = F.when(F.col("pass_rate") >= F.col("objective"), "meets").otherwise("below")
    judged = reports.dq_by_dimension(w).withColumn("objective", objective).withColumn("status", status)
    return judged.select("dimension", "objective", "pass_rate", "status")


def ledger_reconciliation(w: Warehouse, ledger: DataFrame) -> DataFrame:
    """Settled totals by posting day against the general ledger, tolerance zero."""
    booked = spend.settled(w).groupBy("posted_date").agg(F.sum("amount_minor").alias("total_minor"))
    return checks.reconcile(booked, ledger, ["posted_date"], "total_minor")


def value_at_risk(w: Warehouse) -> DataFrame:
    """Rows and absolute value behind each rule, from one scan."""
    size = F.abs("amount_gbp_minor")
    sums = []
    for code, flag in FLAGS.items():
        sums += [count_if(F.col(flag)).alias(f"{code}_rows"), sum_if(F.col(flag), size).alias(f"{code}_value")]
    pairs = [
        F.struct(
            F.lit(code).alias("defect_code"),
            F.col(f"{code}_rows").alias("rows_failed"),
            F.col(f"{code}_value").alias("value_at_risk_minor"),
        )
        for code in FLAGS
    ]
    return w.fact.agg(*sums).select(F.inline(F.array(*pairs)))


def feed_arrival(current: dict[str, DataFrame], previous: dict[str, DataFrame]) -> DataFrame:
    """Row count per feed against the run before; `arrived` is false for an empty feed."""

    def counts(feeds: dict[str, DataFrame], name: str) -> DataFrame:
        return checks.union_all(
            [df.agg(F.count(F.lit(1)).alias(name)).withColumn("feed", F.lit(feed)) for feed, df in feeds.items()]
        )

    joined = counts(current, "row_count").join(counts(previous, "previous_count"), "feed", "full_outer")
    n, before = (F.coalesce(F.col(c), F.lit(0)) for c in ("row_count", "previous_count"))
    return joined.select(
        "feed", n.alias("row_count"), before.alias("previous_count"), (n - before).alias("change"),
        (n > 0).alias("arrived"),
    )


# ------------------------------------------------------------------ binary checks


def lake_fact_reconciliation(w: Warehouse) -> DataFrame:
    """Distinct ids in the lake against fact rows: none lost, none doubled."""
    rows = w.fact.agg(F.count(F.lit(1)).alias("n")).scalar()
    lake = w.staged.agg(F.count_distinct("transaction_id").alias("lake_rows"))
    gap = (F.col("lake_rows") != F.col("fact_rows")).cast("bigint")
    return lake.withColumn("fact_rows", rows).withColumn("violations", gap)


def aggregate_reconciliation(w: Warehouse) -> DataFrame:
    """The pre-aggregate's spend against the settled fact."""
    fact = spend.settled(w).agg(F.sum("amount_gbp_minor").alias("n")).scalar()
    agg = w.agg_customer_category_month.agg(F.sum("spend_gbp_minor").alias("aggregate_minor"))
    gap = (~F.col("aggregate_minor").eqNullSafe(F.col("fact_minor"))).cast("bigint")
    return agg.withColumn("fact_minor", fact).withColumn("violations", gap)


def scd2_overlap_count(w: Warehouse) -> DataFrame:
    found = scd2_overlaps(w.dim_customer, "customer_id")
    return found.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("scd2 overlaps").alias("check"), "violations")


def fact_checks(w: Warehouse) -> DataFrame:
    """Rates present, GBP converted to itself, scores in range, foreign keys filled: one scan."""

    keys = ("customer_key", "account_key", "card_key", "merchant_key", "txn_context_key", "posted_date_key")
    tests = {
        "fact without fx rate": F.col("fx_rate_to_gbp").isNull(),
        "gbp not identical": (F.col("currency_key") == "GBP") & (F.col("amount_minor") != F.col("amount_gbp_minor")),
        "score out of range": (F.col("dq_score") < 0) | (F.col("dq_score") > 100),
    } | {f"null {key}": F.col(key).isNull() for key in keys}
    return checks.count_violations(w.fact, tests)


def null_key_counts(w: Warehouse) -> DataFrame:
    """Null foreign keys (none), and rows on the UNKNOWN members (some)."""
    keys = ("customer_key", "account_key", "card_key", "merchant_key")
    nulls = [F.count(F.when(F.col(k).isNull(), F.lit(1))).alias(f"null_{k}") for k in keys]
    unknown = [F.count(F.when(F.col(k) == UNKNOWN, F.lit(1))).alias(f"unknown_{k}") for k in keys]
    return w.fact.agg(*nulls, *unknown)


# The declared checks of the feeds and the marts.
RELATIONSHIPS = [
    Relationship("fact", "customer_key", "dim_customer", "customer_key"),
    Relationship("fact", "account_key", "dim_account", "account_key"),
    Relationship("fact", "merchant_key", "dim_merchant", "merchant_key"),
    Relationship("fact", "card_key", "dim_card", "card_key"),
    Relationship("fact", "txn_context_key", "dim_txn_context", "txn_context_key"),
    Relationship("fact", "posted_date_key", "dim_date", "date_key"),
    Relationship("accounts", "customer_id", "customers", "customer_id"),
    Relationship("cards", "account_id", "accounts", "account_id"),
]
UNIQUE = [
    Unique("deduped", "transaction_id"),
    Unique("fact", "transaction_id"),
    Unique("customers", "customer_id"),
    Unique("accounts", "account_id"),
    Unique("cards", "card_id"),
    Unique("merchants", "merchant_id"),
    Unique("dim_customer", "customer_key"),
    Unique("dim_account", "account_key"),
    Unique("dim_date", "date_key"),
    Unique("dim_txn_context", "txn_context_key"),
    Unique("dim_merchant", "merchant_key"),
    Unique("dim_card", "card_key"),
]
NOT_NULL = [
    NotNull(table, column)
    for table, columns in {
        "transactions": ("transaction_id", "currency"),
        "customers": ("customer_id",),
        "accounts": ("account_id",),
        "cards": ("card_id",),
        "merchants": ("merchant_id",),
        "fx_rates": ("rate_to_gbp",),
        "fx_daily": ("rate_to_gbp",),
        "deduped": ("transaction_id",),
        "fact": ("transaction_id", "amount_gbp_minor", "txn_context_key", "fx_rate_to_gbp", "dq_score"),
        "dim_customer": ("customer_key", "customer_id"),
        "dim_account": ("account_key", "customer_id"),
        "dim_date": ("date_key", "calendar_date"),
        "dim_txn_context": ("txn_context_key",),
        "dim_merchant": ("merchant_key",),
        "dim_card": ("card_key",),
        "agg_customer_category_month": ("spend_gbp_minor",),
        "agg_dq_scorecard": ("pass_rate",),
    }.items()
    for column in columns
]
ACCEPTED = [
    Accepted("transactions", "feed_version", (1, 2)),
    Accepted("dim_customer", "segment", ("mass", "student", "affluent", "premier", "unknown")),
    Accepted("dim_customer", "kyc_status", ("verified", "pending", "referred", "rejected", "unknown")),
]


def _checked(w: Warehouse, declared: list[Check]) -> DataFrame:
    """Only the tables that a check mentions are built and read, each once."""
    sources = {
        "transactions": lambda: w.staged,
        "customers": lambda: w.staged_customers,
        "accounts": lambda: w.staged_accounts,
        "cards": lambda: w.feeds.cards,
        "merchants": lambda: w.feeds.merchants,
        "fx_rates": lambda: w.feeds.fx_rates,
        "fx_daily": lambda: w.fx_rate,
    }
    named = {c.table for c in declared} | {c.parent for c in declared if isinstance(c, Relationship)}
    tables = {name: sources[name]() if name in sources else getattr(w, name) for name in sorted(named)}
    return run(tables, declared)


def declared_checks(w: Warehouse) -> DataFrame:
    """All declared checks in one plan."""
    return _checked(w, RELATIONSHIPS + UNIQUE + NOT_NULL + ACCEPTED)


def relationships(w: Warehouse) -> DataFrame:
    """The declared foreign keys, violations per relationship."""
    return _checked(w, RELATIONSHIPS)


def uniqueness(w: Warehouse) -> DataFrame:
    """The declared unique columns."""
    return _checked(w, UNIQUE)


def nulls(w: Warehouse) -> DataFrame:
    """The declared not-null columns."""
    return _checked(w, NOT_NULL)


def accepted(w: Warehouse) -> DataFrame:
    """The declared code lists."""
    return _checked(w, ACCEPTED)


def publish_gate(w: Warehouse) -> DataFrame:
    """The marts may be published only when every binary check counts zero."""
    parts = [
        fact_checks(w),
        scd2_overlap_count(w),
        lake_fact_reconciliation(w).select(F.lit("lake and fact differ").alias("check"), "violations"),
        aggregate_reconciliation(w).select(F.lit("aggregate and fact differ").alias("check"), "violations"),
    ]
    total = F.sum("violations")
    return checks.union_all(parts).agg(
        F.count(F.lit(1)).alias("checks_run"), total.alias("violations"), (total == 0).alias("publishable")
    )
