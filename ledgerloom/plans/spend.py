"""Shared shapes of the reports: which rows count, and how they roll up.

Roll-ups count per key before they look anything up: the dimension then joins one row per key, so a
merchant or customer with a third of all rows is summed on the map side and never becomes a hot join
key. How a dimension is joined is left to Catalyst, which knows the written tables' sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_key
from ledgerloom.plans.marts import UNKNOWN, category_of
from ledgerloom.plans.warehouse import Warehouse

MONTH = "month_start"


def settled(w: Warehouse, *context: str) -> DataFrame:
    """Settled fact rows with the named context columns."""
    return w.fact.join(w.context(F.col("is_settled"), *context), "txn_context_key")


def spending(w: Warehouse, *context: str) -> DataFrame:
    """Settled rows that count towards spend: the population of the spend reports."""
    rule = F.col("is_settled") & F.col("counts_towards_spend")
    return w.fact.join(w.context(rule, *context), "txn_context_key")


def by_month(rows: DataFrame) -> DataFrame:
    """Month as a date while grouping (cheap), as text only on the result."""
    return rows.withColumn(MONTH, F.trunc("posted_date", "month"))


def named_month(df: DataFrame) -> DataFrame:
    rest = [F.col(c) for c in df.columns if c != MONTH]
    return df.select(month_key(F.col(MONTH)).alias("month_key"), *rest)


def totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("txn_count"), F.sum("amount_gbp_minor").alias("spend_minor")]


def again() -> list[Column]:
    """`totals` of rows that are totals already."""
    return [F.sum("txn_count").alias("txn_count"), F.sum("spend_minor").alias("spend_minor")]


def by_category(w: Warehouse, rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`txn_count` and `spend_minor` per category (and `keys`)."""
    per_merchant = rows.groupBy(*keys, "merchant_key").agg(*totals())
    return category_of(per_merchant, w.dim_merchant).groupBy(*keys, "category").agg(*again())


def current_customers(w: Warehouse) -> DataFrame:
    return w.dim_customer.where(F.col("is_current") & (F.col("customer_id") != UNKNOWN))


def by_segment(w: Warehouse, rows: DataFrame, *sums: Column, as_of: bool = False) -> DataFrame:
    """Per customer first, then per segment: `customers` is a plain count of customers.

    `as_of` uses the segment held at the time of each transaction instead of the current one.
    """
    names = [f"sum_{i}" for i in range(len(sums))]
    key = "customer_key" if as_of else "customer_id"
    per_key = rows.where(F.col(key) != UNKNOWN).groupBy("customer_id", *{key} - {"customer_id"})
    per_key = per_key.agg(F.count(F.lit(1)).alias("txn_count"), *[F.sum(s).alias(n) for s, n in zip(sums, names)])
    people = w.dim_customer if as_of else current_customers(w)
    joined = per_key.join(people.select(key, "segment"), key)
    return joined.groupBy("segment").agg(
        F.count_distinct("customer_id").alias("customers") if as_of else F.count(F.lit(1)).alias("customers"),
        F.sum("txn_count").alias("txn_count"),
        *[F.sum(n).alias(n) for n in names],
    )
