"""The published reports. Each carries its question, the date it is based on and its owner."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import pounds, ratio, sum_if
from ledgerloom.functions.text import reader_label
from ledgerloom.operators.percentile import picked, rank_counts
from ledgerloom.operators.reshape import latest_per_key, top_n_other
from ledgerloom.operators.rules import LATE_AFTER_DAYS
from ledgerloom.plans import spend
from ledgerloom.plans.warehouse import Warehouse

TOP_CATEGORIES = 8


@dataclass(frozen=True)
class Report:
    key: str
    question: str
    date_basis: str
    owner: str
    build: Callable[[Warehouse], DataFrame]


def headline(w: Warehouse) -> DataFrame:
    rows, amount = spend.spending(w, "is_card_not_present"), F.col("amount_gbp_minor")
    total, n = F.sum(amount), F.count(F.lit(1))
    return rows.agg(
        pounds(total).alias("spend_gbp"),
        n.alias("txn_count"),
        F.count_distinct("customer_id").alias("active_customers"),
        pounds(ratio(total, n)).alias("avg_basket_gbp"),
        F.avg("dq_score").alias("avg_dq_score"),
        ratio(sum_if(F.col("is_card_not_present"), amount), total).alias("online_share"),
    )


def spend_by_month(w: Warehouse) -> DataFrame:
    monthly = spend.by_month(spend.spending(w)).groupBy(spend.MONTH).agg(*spend.totals())
    out = spend.named_month(monthly)
    return out.select("month_key", pounds(F.col("spend_minor")).alias("spend_gbp"), "txn_count").orderBy("month_key")


def spend_by_category(w: Warehouse) -> DataFrame:
    per_category = spend.by_category(w, spend.spending(w)).where(F.col("spend_minor") > 0)
    return per_category.select(
        "category",
        pounds(F.col("spend_minor")).alias("spend_gbp"),
        "txn_count",
        pounds(ratio(F.col("spend_minor"), F.col("txn_count"))).alias("avg_basket_gbp"),
    ).orderBy(F.col("spend_gbp").desc(), "category")


def channel_mix_by_month(w: Warehouse) -> DataFrame:
    rows, amount = spend.by_month(spend.spending(w, "is_card_not_present")), F.col("amount_gbp_minor")
    remote = F.col("is_card_not_present")
    monthly = rows.groupBy(spend.MONTH).agg(
        pounds(sum_if(~remote, amount)).alias("card_present_gbp"), pounds(sum_if(remote, amount)).alias("online_gbp")
    )
    return spend.named_month(monthly).orderBy("month_key")


def channel_mix_with_share(w: Warehouse) -> DataFrame:
    """The monthly mix with the online share; 0 in a month without spend."""
    whole = F.col("card_present_gbp") + F.col("online_gbp")
    guarded = F.when(whole == 0, F.lit(1.0)).otherwise(whole)
    return channel_mix_by_month(w).withColumn("online_share", F.col("online_gbp") / guarded)


def spend_by_segment(w: Warehouse, segment_basis: str = "current") -> DataFrame:
    """By current segment; `segment_basis="as_of"` uses the one held at the time."""
    per_segment = spend.by_segment(w, spend.spending(w), F.col("amount_gbp_minor"), as_of=segment_basis == "as_of")
    total = F.col("sum_0")
    return (
        per_segment.where(F.col("segment") != "unknown")
        .select(
            "segment",
            "customers",
            pounds(total).alias("spend_gbp"),
            pounds(ratio(total, F.col("txn_count"))).alias("avg_basket_gbp"),
            pounds(ratio(total, F.col("customers"))).alias("spend_per_customer_gbp"),
        )
        .orderBy(F.col("spend_gbp").desc(), "segment")
    )


def _pass_rate(w: Warehouse, *keys: str) -> DataFrame:
    checked, failed = F.sum("rows_checked"), F.sum("rows_failed")
    return (
        w.agg_dq_scorecard.groupBy(*keys)
        .agg(
            checked.alias("rows_checked"),
            failed.alias("rows_failed"),
            (F.lit(1.0) - ratio(failed, checked)).alias("pass_rate"),
        )
        .orderBy("pass_rate", *keys)
    )


def dq_by_dimension(w: Warehouse) -> DataFrame:
    return _pass_rate(w, "dimension")


def dq_by_defect(w: Warehouse) -> DataFrame:
    return _pass_rate(w, "defect_code", "dimension")


def status_band(rate: Column) -> Column:
    return F.when(rate >= 0.99, "good").when(rate >= 0.98, "warning").otherwise("critical")


def dq_status(w: Warehouse) -> DataFrame:
    return dq_by_dimension(w).select("dimension", "pass_rate", status_band(F.col("pass_rate")).alias("status"))


def latest_rates(w: Warehouse) -> DataFrame:
    return latest_per_key(w.fx_rate, "currency", "rate_date", "rate_to_gbp")


def fx_totals(w: Warehouse) -> DataFrame:
    """Settled foreign amounts per currency, then the newest rate.

    The rate is constant within a currency, so the integer amounts are added up first: the join
    sees one row per currency and the sum is exact.
    """
    per_currency = (
        spend.settled(w)
        .where(F.col("currency_key") != "GBP")
        .groupBy(F.col("currency_key").alias("currency"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.sum("amount_gbp_minor").alias("booked_gbp_minor"),
            F.sum("amount_minor").alias("amount_minor"),
        )
    )
    revalued = F.col("amount_minor") * F.col("rate_to_gbp")
    return per_currency.join(latest_rates(w), "currency").select(
        "currency", "txn_count", "booked_gbp_minor", revalued.alias("revalued_gbp_minor")
    )


def fx_exposure(w: Warehouse) -> DataFrame:
    booked, revalued = F.col("booked_gbp_minor"), F.col("revalued_gbp_minor")
    return (
        fx_totals(w)
        .select(
            "currency",
            "txn_count",
            F.round(pounds(booked), 2).alias("booked_gbp"),
            F.round(pounds(revalued), 2).alias("revalued_gbp"),
            F.round(pounds(revalued - booked), 2).alias("unrealised_gbp"),
        )
        .orderBy("unrealised_gbp", "currency")
    )


def posting_lag(w: Warehouse) -> DataFrame:
    """Every status. All four figures come from one histogram of (month, lag).

    A lag is a number of calendar days, so a month has few distinct ones.
    """
    lags = (
        spend.by_month(w.fact)
        .groupBy(spend.MONTH, F.col("posting_lag_days").cast("bigint").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    late = F.when(F.col("value") > LATE_AFTER_DAYS, F.col("n")).otherwise(F.lit(0))
    monthly = (
        rank_counts(lags, [spend.MONTH], 0.95)
        .groupBy(spend.MONTH)
        .agg(
            ratio(F.sum(F.col("value") * F.col("n")), F.sum(known)).alias("avg_lag_days"),
            picked().alias("p95_lag_days"),
            F.sum(late).alias("breaches"),
            F.sum("n").alias("txn_count"),
        )
    )
    return spend.named_month(monthly).orderBy("month_key")


def posting_lag_with_rate(w: Warehouse) -> DataFrame:
    return posting_lag(w).withColumn("breach_rate", ratio(F.col("breaches"), F.col("txn_count")))


def category_top_n_other(w: Warehouse, n: int = TOP_CATEGORIES) -> DataFrame:
    return top_n_other(spend_by_category(w).select("category", "spend_gbp"), "category", "spend_gbp", n)


def category_labels(w: Warehouse) -> DataFrame:
    return w.dim_merchant.select("category").distinct().withColumn("label", reader_label(F.col("category")))


def run_metadata(w: Warehouse) -> DataFrame:
    days = w.fact.agg(F.count_distinct("posted_date").alias("n")).scalar()
    return spend.spending(w).agg(
        F.max(days).alias("daily_partitions"),
        F.count(F.lit(1)).alias("txn_count"),
        F.avg("dq_score").alias("avg_dq_score"),
    )


_FINANCE, _PRODUCT, _PLATFORM = "finance@example.com", "cards-product@example.com", "data-platform@example.com"
_POSTED = "posted date"

REPORTS: dict[str, Report] = {
    r.key: r
    for r in (
        Report("headline", "How large is the book, and how good are its rows?", _POSTED, _FINANCE, headline),
        Report("spend_by_month", "Is monthly spend rising or falling?", _POSTED, _FINANCE, spend_by_month),
        Report("spend_by_category", "What kinds of merchant take the money?", _POSTED, _PRODUCT, spend_by_category),
        Report("channel_mix_by_month", "How fast does spend move online?", _POSTED, _PRODUCT, channel_mix_by_month),
        Report(
            "spend_by_segment", "How do the customer segments differ?", _POSTED, "customer-marketing@example.com",
            spend_by_segment,
        ),
        Report("dq_by_dimension", "Which quality dimension loses most rows?", _POSTED, _PLATFORM, dq_by_dimension),
        Report("dq_by_defect", "Which rule fires, for which producer?", _POSTED, _PLATFORM, dq_by_defect),
        Report(
            "fx_exposure", "What is the foreign book worth at the newest rate?", _POSTED, "treasury@example.com",
            fx_exposure,
        ),
        Report("posting_lag", "Is posting keeping to two days?", "posted and authorised", _PLATFORM, posting_lag),
    )
}
