"""Access patterns: each defined once, answered from the lake or from a serving table."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_key
from ledgerloom.operators.reshape import top_per_group
from ledgerloom.plans import reports, spend
from ledgerloom.plans.marts import UNKNOWN
from ledgerloom.plans.warehouse import Warehouse

TOP_MERCHANTS = 20
WINDOW_DAYS = 365


class UnsupportedPattern(KeyError):
    """The store has no form of this pattern."""


@dataclass(frozen=True)
class Parameters:
    customer_id: str
    from_date: dt.date

    @property
    def from_month(self) -> str:
        return self.from_date.strftime("%Y-%m")


def busiest_customer(w: Warehouse) -> DataFrame:
    """The customer with most transactions (smallest id on a tie) and the window to ask about."""
    busy = (
        w.fact.where(F.col("customer_id") != UNKNOWN)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "customer_id")
        .limit(1)
    )
    book = w.fact.agg(F.struct(F.max("posted_date").alias("last"), F.count(F.lit(1)).alias("n")).alias("b")).scalar()
    people = w.dim_customer.where("is_current").agg(F.count(F.lit(1)).alias("n")).scalar()
    start = F.date_sub(book["last"], WINDOW_DAYS)
    return busy.select(
        "customer_id",
        start.alias("from_date"),
        month_key(start).alias("from_month"),
        book["last"].alias("max_date"),
        book["n"].alias("transactions"),
        people.alias("customers"),
    )


def pick_parameters(w: Warehouse) -> Parameters:
    """One row of `busiest_customer`, as bind values."""
    row = busiest_customer(w).first()
    return Parameters(row["customer_id"], row["from_date"])


def customer_document(w: Warehouse, p: Parameters) -> DataFrame:
    return w.customer_document.where(F.col("customer_id") == p.customer_id)


def customer_profile(w: Warehouse, p: Parameters) -> DataFrame:
    """The profile reassembled from the current dimensions, with account and card counts."""
    accounts = w.dim_account.where(F.col("is_current") & (F.col("customer_id") == p.customer_id))
    accounts = accounts.select("customer_id", "account_id")
    owned = accounts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("account_count"))
    held = w.dim_card.join(accounts, "account_id").groupBy("customer_id").agg(F.count(F.lit(1)).alias("card_count"))
    return (
        spend.current_customers(w)
        .where(F.col("customer_id") == p.customer_id)
        .join(owned, "customer_id", "left")
        .join(held, "customer_id", "left")
        .select(
            "customer_id", "segment", "kyc_status", "kyc_risk_band", "onboarded_on", "first_name", "last_name",
            "email", "city", F.lit(None).cast("string").alias("postcode"),
            F.coalesce("account_count", F.lit(0)).alias("account_count"),
            F.coalesce("card_count", F.lit(0)).alias("card_count"),
        )
    )


def customer_12m_from_fact(w: Warehouse, p: Parameters) -> DataFrame:
    """Partitions before the window are never opened: by month where the fact is kept in month
    directories, by date where it is kept in daily ones."""
    recent = w.fact_by_month.where(
        (F.col("posted_month") >= p.from_month)
        & (F.col("posted_date") >= F.lit(p.from_date))
        & (F.col("customer_id") == p.customer_id)
    )
    rows = spend.by_month(recent.join(w.context(F.col("is_settled")), "txn_context_key"))
    monthly = spend.named_month(spend.by_category(w, rows, [spend.MONTH]))
    return monthly.orderBy("month_key", "category")


def customer_12m_clustered(w: Warehouse, p: Parameters) -> DataFrame:
    """The same from the copy of the fact that is clustered by customer."""
    recent = w.fact_by_customer.where((F.col("customer_id") == p.customer_id) & (F.col("posted_date") >= F.lit(p.from_date)))
    rows = spend.by_month(recent.join(w.context(F.col("is_settled")), "txn_context_key"))
    monthly = spend.named_month(spend.by_category(w, rows, [spend.MONTH]))
    return monthly.orderBy("month_key", "category")


def customer_12m_from_agg(w: Warehouse, p: Parameters) -> DataFrame:
    """Whole months, and spend net of what does not count towards it."""
    return (
        w.customer_months.where(
            (F.col("customer_id") == p.customer_id) & (F.col("month_key") >= p.from_month)
        )
        .select("month_key", "category", "txn_count", F.col("net_spend_gbp_minor").alias("spend_minor"))
        .orderBy("month_key", "category")
    )


def category_month_all(w: Warehouse) -> DataFrame:
    rows = spend.by_month(spend.settled(w))
    monthly = spend.named_month(spend.by_category(w, rows, [spend.MONTH]))
    return monthly.orderBy("month_key", "category")


def category_month_from_agg(w: Warehouse) -> DataFrame:
    """The same answer added up from the pre-aggregate."""
    monthly = w.agg_customer_category_month.groupBy("month_key", "category").agg(
        F.sum("txn_count").alias("txn_count"), F.sum("spend_gbp_minor").alias("spend_minor")
    )
    return monthly.orderBy("month_key", "category")


def top_merchants_per_segment(w: Warehouse, n: int = TOP_MERCHANTS) -> DataFrame:
    """By merchant name, which several merchants may share.

    The fact is added up per customer and merchant before either lookup.
    """
    rows = spend.spending(w).where((F.col("merchant_key") != UNKNOWN) & (F.col("customer_id") != UNKNOWN))
    segments = spend.current_customers(w).select("customer_id", "segment")
    per_pair = rows.groupBy("customer_id", "merchant_key").agg(*spend.totals())
    per_key = per_pair.join(segments, "customer_id").groupBy("segment", "merchant_key").agg(*spend.again())
    names = w.dim_merchant.select("merchant_key", "merchant_name")
    per_name = per_key.join(names, "merchant_key").groupBy("segment", "merchant_name").agg(*spend.again())
    order = [F.col("spend_minor").desc_nulls_last(), F.col("merchant_name").asc()]
    return top_per_group(per_name, "segment", order, n, "rank").orderBy("segment", "rank")


def fx_revaluation_asof(w: Warehouse) -> DataFrame:
    """Booked at the rate as of each posting date, unrounded, against the newest rate.

    `fx_rate` holds every day of the fact, gaps carried, so "on or before" is an equality. The
    amounts are added up per (currency, day) first: the lookup sees calendar days, not rows.
    """
    daily = (
        spend.settled(w)
        .where(F.col("currency_key") != "GBP")
        .groupBy(F.col("currency_key").alias("currency"), F.col("posted_date").alias("rate_date"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_minor").alias("amount_minor"))
    )
    at_posting = w.fx_rate.select("currency", "rate_date", F.col("rate_to_gbp").alias("rate_at_posting"))
    priced = daily.join(at_posting, ["currency", "rate_date"], "left")
    then, now, amount = F.col("rate_at_posting"), F.col("rate_to_gbp"), F.col("amount_minor")
    return (
        priced.join(reports.latest_rates(w), "currency")
        .groupBy("currency")
        .agg(
            F.sum("n").alias("txn_count"),
            F.sum(amount * then).alias("booked_gbp_minor"),
            F.sum(amount * now).alias("revalued_gbp_minor"),
            F.sum(amount * (now - then)).alias("unrealised_gbp_minor"),
        )
        .orderBy("currency")
    )


def fx_revaluation_stored(w: Warehouse) -> DataFrame:
    gap = F.col("revalued_gbp_minor") - F.col("booked_gbp_minor")
    return reports.fx_totals(w).withColumn("unrealised_gbp_minor", gap).orderBy("currency")


def full_scan(w: Warehouse) -> DataFrame:
    return w.fact_by_month.agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount_minor").alias("amount_minor"))


def latest_month_scan(w: Warehouse, month: dt.date) -> DataFrame:
    """The same figures from `month` on: only its directories are opened."""
    recent = w.fact_by_month.where(
        (F.col("posted_month") >= month.strftime("%Y-%m")) & (F.col("posted_date") >= F.lit(month.replace(day=1)))
    )
    return recent.agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount_minor").alias("amount_minor"))


def aggregate_against_fact(w: Warehouse, p: Parameters) -> DataFrame:
    """One customer's months by category from both sources, side by side.

    `spend_gbp_minor` of the pre-aggregate has the fact form's definition, so `agrees` must hold
    for every whole month.
    """
    month = p.from_month
    recent = w.fact_by_month.where(
        (F.col("posted_month") >= month)
        & (F.col("posted_date") >= F.lit(p.from_date.replace(day=1)))
        & (F.col("customer_id") == p.customer_id)
    )
    rows = spend.by_month(recent.join(w.context(F.col("is_settled")), "txn_context_key"))
    left = spend.named_month(spend.by_category(w, rows, [spend.MONTH])).drop("txn_count")
    right = w.agg_customer_category_month.where(
        (F.col("customer_id") == p.customer_id) & (F.col("month_key") >= month)
    ).select("month_key", "category", F.col("spend_gbp_minor").alias("aggregate_minor"))
    both = left.withColumnRenamed("spend_minor", "fact_minor").join(right, ["month_key", "category"], "full_outer")
    return both.withColumn("agrees", F.col("fact_minor").eqNullSafe(F.col("aggregate_minor")))


@dataclass(frozen=True)
class Pattern:
    key: str
    question: str
    forms: dict[str, Callable[..., DataFrame]] = field(default_factory=dict)

    def answer(self, store: str, w: Warehouse, *args: object) -> DataFrame:
        if store not in self.forms:
            raise UnsupportedPattern(f"{store} has no form of {self.key}")
        return self.forms[store](w, *args)


PATTERNS: dict[str, Pattern] = {
    p.key: p
    for p in (
        Pattern(
            "customer_profile_lookup", "What do we hold about this customer?",
            {"document": customer_document, "serving": customer_profile},
        ),
        Pattern(
            "customer_12m_spend_by_category", "What did this customer spend, by category and month?",
            {"lake": customer_12m_from_fact, "clustered": customer_12m_clustered, "serving": customer_12m_from_agg},
        ),
        Pattern(
            "category_month_spend_all_customers", "How does the whole book split by category and month?",
            {"lake": category_month_all, "serving": category_month_from_agg},
        ),
        Pattern(
            "top_merchants_per_segment", "Which merchants lead in each segment?",
            {"lake": top_merchants_per_segment, "serving": top_merchants_per_segment},
        ),
        Pattern(
            "asof_fx_revaluation", "What is the foreign book worth at the newest rate?",
            {"lake": fx_revaluation_asof, "serving": fx_revaluation_stored},
        ),
    )
}


def pattern(key: str) -> Pattern:
    if key not in PATTERNS:
        raise UnsupportedPattern(f"no access pattern {key}")
    return PATTERNS[key]


def plan_text(df: DataFrame) -> str:
    """The physical plan as `explain("formatted")` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def files_touched(rows: DataFrame) -> DataFrame:
    """How many files a filtered scan opens: call on the scan, before any aggregate."""
    return rows.select(F.col("_metadata.file_path").alias("path")).agg(F.count_distinct("path").alias("files"))


def months_opened(w: Warehouse) -> DataFrame:
    """Month directories a full scan and a newest-month scan open: the evidence of pruning."""
    newest = w.fact.agg({"posted_date": "max"}).first()[0].strftime("%Y-%m")
    scans = {"full": w.fact_by_month, "newest month": w.fact_by_month.where(F.col("posted_month") >= newest)}
    month = F.regexp_extract("_metadata.file_path", r"posted_month=([0-9-]+)", 1)
    counts = [
        rows.select(month.alias("m")).agg(F.count_distinct("m").alias("months")).select(F.lit(scan).alias("scan"), "months")
        for scan, rows in scans.items()
    ]
    return counts[0].unionByName(counts[1])
