"""Business metrics of the glossary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_key
from ledgerloom.functions.money import count_if, pounds, ratio, sum_if
from ledgerloom.plans import spend
from ledgerloom.plans.warehouse import Warehouse

ACTIVE_DAYS = 30
DORMANT_MONTHS = 12
CARD_DORMANT_MONTHS = 6


def _is(kind: str, column: str = "txn_type") -> Column:
    return F.col(column) == kind


def active_customers(w: Warehouse, days: int = ACTIVE_DAYS) -> DataFrame:
    """Customers with a settled purchase in the trailing days up to the newest posting.

    The newest day is read from the month directories' statistics first, so only the months of the
    window are opened.
    """
    last = w.fact.agg(F.max("posted_date")).first()[0]
    if last is None:
        return w.fact.agg(F.lit(0).cast("long").alias("active_customers"))
    start = last - dt.timedelta(days=days)
    recent = w.fact_by_month.where(
        (F.col("posted_month") >= start.strftime("%Y-%m")) & (F.col("posted_date") > F.lit(start))
    )
    bought = recent.join(w.context(F.col("is_settled"), "txn_type"), "txn_context_key").where(_is("purchase"))
    return bought.agg(F.count_distinct("customer_id").alias("active_customers"))


def active_customers_daily(w: Warehouse, days: int = ACTIVE_DAYS) -> DataFrame:
    """The trailing-window answer for every day that has one, exact, from one scan of the fact.

    A day's customers are bitmaps of fixed size (32,768 customers each); a window is the OR of its days, so
    each bitmap is sent to the days that look back on it and no customer is counted again.
    """
    last = w.active_bitmaps.agg(F.max("posted_date")).scalar()
    seen_by = F.sequence(F.col("posted_date"), F.least(F.date_add("posted_date", days - 1), last))
    spread = w.active_bitmaps.select(F.explode(seen_by).alias("day"), "bucket", "bits")
    windows = spread.groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return windows.groupBy(F.col("day").alias("posted_date")).agg(F.sum(F.bitmap_count("bits")).alias("active_customers"))


def spend_net_gross(w: Warehouse) -> DataFrame:
    """Monthly gross spend, refunds (negative) and net. Settled only."""
    rows = spend.by_month(spend.settled(w, "txn_type", "counts_towards_spend"))
    amount = F.col("amount_gbp_minor")
    monthly = rows.groupBy(spend.MONTH).agg(
        sum_if(F.col("counts_towards_spend"), amount).alias("gross_spend_minor"),
        sum_if(_is("refund"), amount).alias("refund_minor"),
        F.count(F.lit(1)).alias("txn_count"),
    )
    net = F.col("gross_spend_minor") + F.col("refund_minor")
    return spend.named_month(monthly.withColumn("net_spend_minor", net))


def approval_rate(w: Warehouse) -> DataFrame:
    """Per month, 1 - declined / all attempts."""
    rows = spend.by_month(w.fact.join(w.context(F.lit(True), "status"), "txn_context_key"))
    monthly = rows.groupBy(spend.MONTH).agg(
        F.count(F.lit(1)).alias("attempts"), count_if(_is("declined", "status")).alias("declined")
    )
    rate = F.lit(1.0) - ratio(F.col("declined"), F.col("attempts"))
    return spend.named_month(monthly.withColumn("approval_rate", rate))


def average_basket(w: Warehouse) -> DataFrame:
    """Settled purchases only: no ATM withdrawals, no fees."""
    rows = spend.settled(w, "txn_type").where(_is("purchase"))
    n, total = F.count(F.lit(1)), F.sum("amount_gbp_minor")
    return rows.agg(n.alias("purchases"), pounds(ratio(total, n)).alias("avg_basket_gbp"))


def category_mix(w: Warehouse) -> DataFrame:
    """Share of each month's spend by category."""
    rows = spend.by_month(spend.spending(w))
    monthly = spend.named_month(spend.by_category(w, rows, [spend.MONTH]))
    whole = F.sum("spend_minor").over(Window.partitionBy("month_key"))
    return monthly.select(
        "month_key", "category", "spend_minor", ratio(F.col("spend_minor"), whole).alias("share")
    )


def spend_by_channel(w: Warehouse) -> DataFrame:
    rows = spend.spending(w, "channel", "is_card_not_present")
    return rows.groupBy("channel", "is_card_not_present").agg(
        F.sum("amount_gbp_minor").alias("spend_minor"), F.count(F.lit(1)).alias("txn_count")
    )


def onboarded_customers(w: Warehouse) -> DataFrame:
    verified = spend.current_customers(w).where(_is("verified", "kyc_status"))
    return verified.agg(F.count(F.lit(1)).alias("onboarded_customers"))


def date_basis_comparison(w: Warehouse) -> DataFrame:
    """Monthly spend on both dates, from one scan grouped by the pair of months."""
    posted, auth = F.trunc("posted_date", "month"), F.trunc("auth_date", "month")
    pairs = (
        spend.spending(w)
        .groupBy(posted.alias("posted"), auth.alias("auth"))
        .agg(F.sum("amount_gbp_minor").alias("minor"))
    )
    none = F.lit(0).cast("bigint")
    both = F.inline(
        F.array(
            F.struct(
                F.col("posted").alias("month"), F.col("minor").alias("posted_minor"), none.alias("auth_minor")
            ),
            F.struct(F.col("auth").alias("month"), none.alias("posted_minor"), F.col("minor").alias("auth_minor")),
        )
    )
    return (
        pairs.select(both)
        .groupBy("month")
        .agg(F.sum("posted_minor").alias("posted_basis_minor"), F.sum("auth_minor").alias("authorised_basis_minor"))
        .select(
            month_key(F.col("month")).alias("month_key"), "posted_basis_minor", "authorised_basis_minor",
            (F.col("posted_basis_minor") - F.col("authorised_basis_minor")).alias("difference_minor"),
        )
    )


def dormant_accounts(w: Warehouse, months: int = DORMANT_MONTHS, card_months: int = CARD_DORMANT_MONTHS) -> DataFrame:
    """Every account that is not closed, with both definitions of dormant as fields of its own.

    Core banking looks for any transaction in `months`; the card team for card purchases in the
    shorter `card_months`. Both are published because neither is agreed.
    """
    last = w.deduped.agg(F.max("posted_date")).scalar()
    activity = w.deduped.groupBy("account_id").agg(
        F.max("posted_date").alias("last_any"),
        F.max(F.when(_is("purchase"), F.col("posted_date"))).alias("last_card"),
    )
    joined = w.staged_accounts.where(F.col("status") != "closed").join(activity, "account_id", "left")
    joined = joined.withColumn("today", last)

    def silent(column: str, span: int) -> Column:
        return F.coalesce(F.col(column) < F.add_months("today", -span), F.lit(True))

    return joined.select(
        "account_id", "product_code",
        silent("last_any", months).alias("is_dormant_core_banking"),
        silent("last_card", card_months).alias("is_dormant_card_activity"),
    )


def dormancy(w: Warehouse, months: int = DORMANT_MONTHS, card_months: int = CARD_DORMANT_MONTHS) -> DataFrame:
    """Accounts not closed, dormant by either definition, per product."""
    return dormant_accounts(w, months, card_months).groupBy("product_code").agg(
        F.count(F.lit(1)).alias("accounts"),
        count_if(F.col("is_dormant_core_banking")).alias("dormant_core_banking"),
        count_if(F.col("is_dormant_card_activity")).alias("dormant_card_activity"),
    )


def segment_concentration(w: Warehouse) -> DataFrame:
    """Share of customers against share of spend."""
    per_segment = spend.by_segment(w, spend.spending(w), F.col("amount_gbp_minor"))
    whole = per_segment.agg(F.struct(F.sum("customers").alias("c"), F.sum("sum_0").alias("s")).alias("t")).scalar()
    return per_segment.select(
        "segment",
        "customers",
        ratio(F.col("customers"), whole["c"]).alias("customer_share"),
        ratio(F.col("sum_0"), whole["s"]).alias("spend_share"),
    )


def online_share_by_segment(w: Warehouse) -> DataFrame:
    amount = F.col("amount_gbp_minor")
    remote = F.when(F.col("is_card_not_present"), amount).otherwise(F.lit(0))
    per_segment = spend.by_segment(w, spend.spending(w, "is_card_not_present"), amount, remote)
    return per_segment.select("segment", ratio(F.col("sum_1"), F.col("sum_0")).alias("online_share"))
