"""Gold export and serving copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_key
from ledgerloom.operators.checks import union_all
from ledgerloom.operators.detection import Injection
from ledgerloom.plans import monitors, spend
from ledgerloom.plans.marts import UNKNOWN
from ledgerloom.plans.publishing import current_path, publish_checked, repeated_ids, rows_conserved, tests_of
from ledgerloom.plans.warehouse import GOLD_FACT, GOLD_FLAT, GoldMarts, Warehouse
from ledgerloom.session import clustered
from ledgerloom.sources.figures import table_figures
from ledgerloom.sources.sinks import counted_write


def export_gold(w: Warehouse, gold: str, fact_partition: str = "posted_date") -> DataFrame:
    """Publish all marts under `gold`; the report has one row per table: `table, rows, bytes, partitions`.

    The fact goes into daily directories like the lake, so a date filter prunes both alike, or into
    monthly ones (`posted_month`). The marts are
    checked as written; on a violation `PublishRefused` is raised and readers keep the version before.
    """

    def write(path: str) -> None:
        for name, df in w.gold().items():
            if name != GOLD_FACT:
                counted_write(df, f"{path}/{name}")
        monthly = fact_partition == "posted_month"
        fact = w.fact_by_month if monthly else w.fact
        counted_write(fact, f"{path}/{GOLD_FACT}", fact_partition, monthly and w.months_lie_apart)

    version = publish_checked(w.spark, gold, write, lambda path: audit_gold(w, path))
    path = f"{gold}/{version.folders[0]}"
    parts = [
        table_figures(w.spark, f"{path}/{name}", fact_partition if name == GOLD_FACT else None).select(
            F.lit(name).alias("table"), "rows", "bytes", "partitions"
        )
        for name in w.gold()
    ]
    return union_all(parts)


def audit_gold(w: Warehouse, path: str) -> DataFrame:
    """`check, violations` of gold tables as written, against themselves and what they were made from."""
    written = GoldMarts(w.spark, path, published=False)
    return union_all(
        [
            tests_of(written.fact),
            repeated_ids(written.fact),
            monitors.scd2_overlap_count(written),
            monitors.aggregate_reconciliation(written).select(F.lit("aggregate and fact differ").alias("check"), "violations"),
            rows_conserved({name: getattr(written, name) for name in GOLD_FLAT}, {name: getattr(w, name) for name in GOLD_FLAT}),
        ]
    )


def scan_gold(spark: SparkSession, gold: str, table: str, *columns: str) -> DataFrame:
    """A table of the published gold layer."""
    df = spark.read.parquet(f"{current_path(spark, gold)}/{table}")
    return df.select(*columns) if columns else df


def tables(w: Warehouse) -> dict[str, DataFrame]:
    """The serving projections: current members only, columns a screen needs."""
    current_account = F.col("is_current") & (F.col("account_id") != UNKNOWN)
    no_postcode = F.lit(None).cast("string").alias("postcode")
    return {
        "dim_customer_current": spend.current_customers(w).select(
            "customer_id", "segment", "kyc_status", "kyc_risk_band", "onboarded_on", "first_name", "last_name",
            "email", "city", no_postcode,
        ),
        "dim_account_current": w.dim_account.where(current_account).select(
            "account_id", "customer_id", "product_code", "currency", "status", "opened_on"
        ),
        "dim_card": w.dim_card.select("card_key", "account_id", "card_type", "network", "status"),
        "dim_merchant": w.dim_merchant.select(
            "merchant_key", "merchant_name", "mcc", "category", "country", "is_online"
        ),
        "dim_txn_context": w.dim_txn_context,
        "fx_rate": w.fx_rate.select("rate_date", "currency", "rate_to_gbp"),
        "agg_customer_category_month": w.agg_customer_category_month.drop("avg_dq_score"),
        "fct_card_transaction": w.fact.select(
            "transaction_id", "posted_date", "auth_date", "customer_id", "account_key", "card_key", "merchant_key",
            "txn_context_key", "currency_key", "mcc", "amount_minor", "amount_gbp_minor", "fx_rate_to_gbp",
            "posting_lag_days", "dq_score",
        ),
        "customer_document": w.customer_document,
    }


# The key each serving table is looked up by, then columns that split a hot key over several files.
LOOKUP = {
    "dim_customer_current": ("customer_id",),
    "dim_account_current": ("customer_id", "account_id"),
    "agg_customer_category_month": ("customer_id", "month_key", "category"),
    "fct_card_transaction": ("customer_id", "posted_date", "transaction_id"),
    "customer_document": ("customer_id",),
}


def publish(w: Warehouse, target: str) -> None:
    """Publish the serving copies; the fact additionally in month directories.

    Checked as written, like gold; readers find them below `publishing.current_path`.
    """

    def write(path: str) -> None:
        for name, df in tables(w).items():
            keys = LOOKUP.get(name)
            out = clustered(df, keys) if keys else df.hint("rebalance")
            out.write.mode("overwrite").parquet(f"{path}/{name}")
        by_month = tables(w)[GOLD_FACT].withColumn("posted_month", month_key(F.col("posted_date")))
        counted_write(by_month, f"{path}/{GOLD_FACT}_by_month", "posted_month", w.months_lie_apart)

    def audit(path: str) -> DataFrame:
        made = tables(w)
        written = {name: w.spark.read.parquet(f"{path}/{name}") for name in made}
        monthly = w.spark.read.parquet(f"{path}/{GOLD_FACT}_by_month")
        fact = written[GOLD_FACT]
        return union_all(
            [
                tests_of(fact),
                repeated_ids(fact),
                rows_conserved(written, made),
                rows_conserved({f"{GOLD_FACT}_by_month": monthly}, {f"{GOLD_FACT}_by_month": made[GOLD_FACT]}),
            ]
        )

    publish_checked(w.spark, target, write, audit)


def month_ranges(fact: DataFrame) -> DataFrame:
    """Half-open month ranges covering the fact."""
    start = F.trunc("posted_date", "month")
    return fact.select(start.alias("month_start")).distinct().select(
        F.concat(F.lit("fct_"), F.date_format("month_start", "yyyy_MM")).alias("name"),
        "month_start",
        F.add_months("month_start", 1).alias("month_end"),
    )


def transaction_injections() -> list[Injection]:
    """Planted transaction defects at the documented rates."""
    purchase = F.col("txn_type") == "purchase"
    always = F.lit(True)
    late = {"posted_date": F.date_add("posted_date", 5)}
    return [
        Injection("D01", 0.0040, purchase, {"merchant_id": F.lit(None)}),
        Injection("D02", 0.0015, always),
        Injection("D03", 0.0020, always, {"card_id": F.lit("CRD-ORPHAN")}),
        Injection("D04", 0.0010, purchase, {"amount_minor": -F.abs("amount_minor")}),
        Injection("D05", 0.0008, always, {"mcc": F.lit(99999)}),
        Injection("D06", 0.0060, always, late),
        Injection("D07", 0.0005, always, {"amount_minor": F.col("amount_minor") * 100}),
    ]
