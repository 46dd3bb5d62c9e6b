
from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_catalog
from ledgerloom.functions.money import count_if
from ledgerloom.operators import checks, detection, rules
from ledgerloom.operators.asof import asof_join
from ledgerloom.operators.percentile import grouped_percentile
from ledgerloom.plans import metrics, monitors, patterns, reports, serving, spend
from ledgerloom.plans.publishing import PublishRefused, current_path
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.session import new_folder
from ledgerloom.sources import driver_delivery, driver_feeds, readers, sinks
from ledgerloom.sources.contracts import customer_value_rules
from ledgerloom.sources.driver_delivery import DailyDeliveries, Delivery, FaultyDelivery, StateDeliveries
from ledgerloom.sources.figures import partition_figures
from ledgerloom.sources.versions import VersionedTable

try:  # the training-data operators are optional: their folder and the pipeline can be absent
    import corpus_pipeline
    from ledgerloom.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in {"corpus_pipeline", "ledgerloom.llm"}:
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

_warehouses: dict[tuple[str, str], Warehouse] = {}
_deliveries: dict[tuple[str, str, type], Any] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The marts of one data folder, shared by the queries of one Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, driver_feeds.load(spark, sf_dir))
    return _warehouses[key]


def delivery(spark: SparkSession, sf_dir: str, kind: type = Delivery) -> Any:
    """The tables of one data folder delivered in wire form and landed, once in a Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _deliveries:
        _deliveries[key] = kind(spark, warehouse(spark, sf_dir).feeds)
    return _deliveries[key]


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Year-9999 sentinels as text: they overflow nanosecond timestamps in pandas."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _with_parameters(answer: Callable[..., DataFrame]) -> Callable[[Warehouse], DataFrame]:
    return lambda w: answer(w, patterns.pick_parameters(w))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


def fx_asof_rows(w: Warehouse) -> DataFrame:
    """Each transaction with the newest published rate at its posting date, gaps included."""
    left = w.deduped.select("transaction_id", "currency", "posted_date")
    return asof_join(left, w.feeds.fx_rates, "currency", "posted_date", "rate_date", "rate_to_gbp", "rate_at_posting")


def customer_feed_rules(w: Warehouse) -> DataFrame:
    tests = rules.feed_rules_customers()
    return w.staged_customers.agg(
        F.count(F.lit(1)).alias("rows_checked"), *[count_if(test).alias(code) for code, test in tests.items()]
    )


def detection_recall_precision(w: Warehouse) -> DataFrame:
    return detection.detection_quality(
        detection.flagged_rows(w.fact, rules.FLAGS), driver_feeds.defect_ledger(w.deduped)
    )


def detection_flat_threshold(w: Warehouse) -> DataFrame:
    """The retired flat range check against the category-relative rule, for unit slips."""
    both = {"flat": "flat", "relative": "dq_implausible_amount"}
    judged = w.fact.withColumn("flat", F.abs("amount_minor") > rules.FLAT_LIMIT_MINOR)
    slips = driver_feeds.defect_ledger(w.deduped).where(F.col("defect_code") == "D07")
    truth = slips.select("transaction_id", F.explode(F.array(*[F.lit(c) for c in both])).alias("defect_code"))
    return detection.detection_quality(detection.flagged_rows(judged, both), truth)


def undetected_value(w: Warehouse) -> DataFrame:
    ledger = driver_feeds.defect_ledger(w.deduped)
    return detection.undetected_value(w.fact, ledger, "D07", "dq_implausible_amount", "amount_gbp_minor")


def scorecard_against_ledger(w: Warehouse) -> DataFrame:
    failed = w.agg_dq_scorecard.groupBy("defect_code").agg(F.sum("rows_failed").alias("n"))
    planted = driver_feeds.defect_ledger(w.deduped).groupBy("defect_code").agg(F.count(F.lit(1)).alias("n"))
    return checks.reconcile(failed, planted, ["defect_code"], "n")


def inject_defects(w: Warehouse) -> DataFrame:
    """The ledger of defects planted into clean customers-facing columns at fixed rates."""
    _, ledger = detection.inject_defects(w.deduped, "transaction_id", serving.transaction_injections(), seed=7)
    return ledger


def inject_defects_feed(w: Warehouse) -> DataFrame:
    dirty, _ = detection.inject_defects(w.deduped, "transaction_id", serving.transaction_injections(), seed=7)
    return dirty.groupBy("txn_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("merchant_id").alias("with_merchant"),
        F.sum("amount_minor").alias("amount_minor"),
        count_if(F.col("mcc") == 99999).alias("bad_mcc"),
    )


def nearest_rank_lag(w: Warehouse) -> DataFrame:
    rows = w.fact.select(F.trunc("posted_date", "month").alias(spend.MONTH), "posting_lag_days")
    p95 = grouped_percentile(
        rows, [spend.MONTH], "posting_lag_days", 0.95, "p95_lag_days", method="nearest", few_groups=True
    )
    return spend.named_month(p95)


def newest_month_scan(w: Warehouse) -> DataFrame:
    last = w.fact.agg(F.max("posted_date")).first()[0]
    return patterns.latest_month_scan(w, last)


def fresh_yesterday(w: Warehouse) -> DataFrame:
    """A run on the day after the newest posted date of the book, whichever that is."""
    newest = w.deduped.agg(F.max("posted_date")).scalar()
    return monitors.fresh_yesterday(w.deduped, F.date_add(newest, 1))


def feed_arrival(w: Warehouse) -> DataFrame:
    def run(i: int) -> dict[str, DataFrame]:
        return {"customers": w.feeds.customers[i].rows, "accounts": w.feeds.accounts[i].rows}

    return monitors.feed_arrival(run(-1), run(-2))


def publish_audit(w: Warehouse) -> DataFrame:
    """Two attempts to publish gold: the marts, then the marts with one day loaded twice; what readers see after each."""

    class Overlapping(Warehouse):
        """One day of the fact twice; every other mart as it is."""

    twice = Overlapping(w.spark, w.feeds)
    w.gold()
    first_day = w.fact.agg(F.min("posted_date")).scalar()
    doubled = w.fact_by_month.unionByName(w.fact_by_month.where(F.col("posted_date") == first_day))
    twice.__dict__.update(w.__dict__ | {"fact_by_month": doubled, "fact": doubled.drop("posted_month")})
    target = new_folder(w.spark, "gold")
    parts = []
    for attempt, marts in (("clean", w), ("overlapping load", twice)):
        refused: dict[str, int] = {}
        try:
            serving.export_gold(marts, target, fact_partition="posted_month")
        except PublishRefused as refusal:
            refused = refusal.violated
        version = VersionedTable(w.spark, target).current().number
        seen = serving.scan_gold(w.spark, target, "fct_card_transaction").agg(F.count(F.lit(1)).alias("fact_rows"))
        told = (F.lit(attempt).alias("attempt"), F.lit(not refused).alias("published"), F.lit(version).alias("version"))
        parts.append(seen.select(*told, F.lit(", ".join(sorted(refused))).alias("violated"), "fact_rows"))
    return checks.union_all(parts)


def gold_report(w: Warehouse) -> DataFrame:
    """What publishing all marts wrote, by file footers and file status."""
    report = serving.export_gold(w, new_folder(w.spark, "gold"), fact_partition="posted_month")
    return report.select("table", "rows", "partitions", (F.col("bytes") > 0).alias("has_bytes"))


def serving_months(w: Warehouse) -> DataFrame:
    """The month directories of the published serving fact, which readers reach through the pointer."""
    target = new_folder(w.spark, "serving")
    serving.publish(w, target)
    path = f"{current_path(w.spark, target)}/fct_card_transaction_by_month"
    months = partition_figures(w.spark, path, "posted_month")
    loaded = F.lit(sinks.is_loaded(w.spark, path) and not sinks.is_loaded(w.spark, f"{target}/nothing"))
    return months.select(F.col("posted_month").cast("string").alias("posted_month"), "rows", loaded.alias("loaded"))


def report_csv(w: Warehouse) -> DataFrame:
    """A report written as CSV with a header, and read back."""
    path = new_folder(w.spark, "report")
    sinks.write_csv(reports.dq_by_dimension(w), path)
    back = w.spark.read.csv(path, header=True)
    return back.select(
        "dimension", *[F.col(c).cast("long").alias(c) for c in ("rows_checked", "rows_failed")],
        F.col("pass_rate").cast("double").alias("pass_rate"),
    )


def defect_ledger_written(w: Warehouse) -> DataFrame:
    path = new_folder(w.spark, "ledger")
    sinks.write_ledger(driver_feeds.defect_ledger(w.deduped), path)
    return w.spark.read.parquet(path)


_FLAGS = list(rules.FLAGS.values())
_WATCHED = ["segment", "kyc_status", "kyc_risk_band"]

_BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # feeds and their reduction
    "stg_transactions": lambda w: w.staged,
    "stg_customers": lambda w: w.staged_customers,
    "stg_accounts": lambda w: w.staged_accounts,
    "stg_cards": lambda w: w.feeds.cards,
    "stg_merchants": lambda w: w.feeds.merchants,
    "stg_fx_rates": lambda w: w.feeds.fx_rates,
    "dedupe_latest": lambda w: w.deduped,
    "fx_dense_asof": lambda w: w.fx_rate,
    "fx_asof_join": fx_asof_rows,
    # row quality
    "mcc_median": lambda w: w.medians,
    "rules_flags": lambda w: w.scored.select("transaction_id", *_FLAGS),
    "dq_score": lambda w: w.scored.select("transaction_id", "posting_lag_days", "dq_score"),
    "dq_scorecard": lambda w: w.agg_dq_scorecard,
    "customer_feed_rules": customer_feed_rules,
    "contract_value_rules": lambda w: customer_value_rules(w.staged_customers),
    # history and the star
    "scd2_merge_customers": lambda w: w.customer_history.select("customer_id", *_WATCHED, "valid_from", "valid_to"),
    "scd2_merge_accounts": lambda w: w.account_history.select(
        "account_id", "product_code", "status", "closed_on", "valid_from", "valid_to"
    ),
    "dim_customer": lambda w: _as_text(w.dim_customer, "valid_from", "valid_to"),
    "dim_account": lambda w: _as_text(w.dim_account, "valid_from", "valid_to"),
    "dim_card": lambda w: _as_text(w.dim_card, "expires_on"),
    "dim_merchant": lambda w: w.dim_merchant,
    "dim_currency": lambda w: w.dim_currency,
    "dim_date": lambda w: w.dim_date,
    "dim_txn_context": lambda w: w.dim_txn_context,
    "customer_documents": lambda w: w.customer_document,
    "fact": lambda w: w.fact,
    "agg_customer_category_month": lambda w: w.agg_customer_category_month,
    # reports
    "headline": reports.headline,
    "spend_by_month": reports.spend_by_month,
    "spend_by_category": reports.spend_by_category,
    "category_top_n_other": lambda w: _rounded(reports.category_top_n_other(w, n=4), "spend_gbp"),
    "category_labels": reports.category_labels,
    "channel_mix_by_month": reports.channel_mix_by_month,
    "channel_online_share": lambda w: reports.channel_mix_with_share(w).select(
        "month_key", F.round("online_share", 9).alias("online_share")
    ),
    "spend_by_segment": reports.spend_by_segment,
    "spend_by_segment_as_of": lambda w: reports.spend_by_segment(w, "as_of"),
    "dq_by_dimension": reports.dq_by_dimension,
    "dq_by_defect": reports.dq_by_defect,
    "dq_status": reports.dq_status,
    "fx_exposure": reports.fx_exposure,
    "posting_lag": reports.posting_lag,
    "posting_lag_breach_rate": lambda w: reports.posting_lag_with_rate(w).select("month_key", "breach_rate"),
    "posting_lag_nearest_rank": nearest_rank_lag,
    "run_metadata": reports.run_metadata,
    # access patterns
    "month_ranges": lambda w: serving.month_ranges(w.fact),
    "customer_document": _with_parameters(patterns.customer_document),
    "customer_profile": _with_parameters(patterns.customer_profile),
    "customer_12m_from_fact": _with_parameters(patterns.customer_12m_from_fact),
    "customer_12m_clustered": _with_parameters(patterns.customer_12m_clustered),
    "customer_12m_from_agg": _with_parameters(patterns.customer_12m_from_agg),
    "aggregate_against_fact": _with_parameters(patterns.aggregate_against_fact),
    "category_month_all": patterns.category_month_all,
    "category_month_from_agg": patterns.category_month_from_agg,
    "top_merchants_per_segment": patterns.top_merchants_per_segment,
    "fx_revaluation_asof": lambda w: _rounded(
        patterns.fx_revaluation_asof(w), "booked_gbp_minor", "revalued_gbp_minor", "unrealised_gbp_minor"
    ),
    "fx_revaluation_stored": lambda w: _rounded(
        patterns.fx_revaluation_stored(w), "revalued_gbp_minor", "unrealised_gbp_minor"
    ),
    "busiest_customer": patterns.busiest_customer,
    "full_scan": patterns.full_scan,
    "partition_month_scan": newest_month_scan,
    "partition_months_opened": patterns.months_opened,
    "serving_customers": lambda w: serving.tables(w)["dim_customer_current"],
    "serving_accounts": lambda w: serving.tables(w)["dim_account_current"],
    # detection quality
    "detection_recall_precision": detection_recall_precision,
    "detection_flat_threshold": detection_flat_threshold,
    "undetected_value": undetected_value,
    "scorecard_against_ledger": scorecard_against_ledger,
    "inject_defects": inject_defects,
    "inject_defects_feed": inject_defects_feed,
    # checks and monitors
    "reconcile_lake_fact": monitors.lake_fact_reconciliation,
    "aggregate_agrees": monitors.aggregate_reconciliation,
    "scd2_overlaps": monitors.scd2_overlap_count,
    "fact_checks": monitors.fact_checks,
    "null_key_counts": monitors.null_key_counts,
    "relationships_violations": monitors.relationships,
    "unique_violations": monitors.uniqueness,
    "not_null_violations": monitors.nulls,
    "accepted_values_violations": monitors.accepted,
    "feed_unique_violations": lambda w: checks.unique(w.staged, "transactions", ["transaction_id"]),
    "ledger_reconciliation": lambda w: monitors.ledger_reconciliation(w, driver_feeds.general_ledger(w.deduped)),
    "value_at_risk": monitors.value_at_risk,
    "freshness_3sigma": lambda w: monitors.freshness(w.deduped),
    "fresh_yesterday": fresh_yesterday,
    "fx_coverage": monitors.fx_coverage,
    "carried_forward_days": monitors.carried_forward_days,
    "document_count": monitors.document_count,
    "quality_objectives": monitors.quality_objectives,
    "feed_arrival": feed_arrival,
    "declared_checks": monitors.declared_checks,
    "publish_audit": publish_audit,
    "gold_report": gold_report,
    "serving_months": serving_months,
    "report_csv": report_csv,
    "defect_ledger_written": defect_ledger_written,
    "publish_gate": monitors.publish_gate,
    # business metrics
    "active_customers_30d": metrics.active_customers,
    "active_customers_daily": metrics.active_customers_daily,
    "spend_net_gross": metrics.spend_net_gross,
    "approval_rate": metrics.approval_rate,
    "average_basket": metrics.average_basket,
    "category_mix": metrics.category_mix,
    "spend_by_channel": metrics.spend_by_channel,
    "onboarded_customers": metrics.onboarded_customers,
    "date_basis_comparison": metrics.date_basis_comparison,
    "dormancy": metrics.dormancy,
    "dormant_accounts": metrics.dormant_accounts,
    "segment_concentration": metrics.segment_concentration,
    "online_share_by_segment": metrics.online_share_by_segment,
}

_INGEST: dict[str, Callable[[Delivery], DataFrame]] = {
    "ingest_customers": driver_delivery.customers,
    "ingest_accounts": lambda d: d.table("accounts"),
    "ingest_cards": lambda d: d.table("cards"),
    "ingest_merchants": lambda d: d.table("merchants"),
    "ingest_fx_rates": lambda d: d.table("fx_rates"),
    "ingest_transactions": driver_delivery.transactions,
    "evolve_union": driver_delivery.versions,
    "landed_metrics": driver_delivery.landed_metrics,
    "row_conservation": driver_delivery.row_conservation,
    "contract_verdicts": driver_delivery.contract_verdicts,
    "landed_partitions": lambda d: readers.partition_dates(d.spark, f"{d.lake}/card_transactions"),
}

_OTHER_DELIVERIES: dict[str, tuple[type, Callable[[Any], DataFrame]]] = {
    "contract_verdicts_faulty": (FaultyDelivery, driver_delivery.faulty_verdicts),
    "contract_summary_faulty": (FaultyDelivery, driver_delivery.verdict_summary),
    "value_rule_violations": (FaultyDelivery, driver_delivery.value_rule_violations),
    "history_from_lake_customers": (
        StateDeliveries,
        lambda d: d.history("customers").read().select("customer_id", *_WATCHED, "valid_from", "valid_to"),
    ),
    "history_from_lake_accounts": (
        StateDeliveries,
        lambda d: d.history("accounts").read().select(
            "account_id", "product_code", "status", "closed_on", "valid_from", "valid_to"
        ),
    ),
    "history_versions": (StateDeliveries, driver_delivery.landed_versions),
    "freshness_landed": (DailyDeliveries, driver_delivery.landed_freshness),
    "feed_arrival_ledger": (DailyDeliveries, driver_delivery.arrival_report),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: spend by category and month over the whole book."""
    return patterns.category_month_all(warehouse(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Warehouse], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(warehouse(spark, sf_dir))

    def bind_ingest(build: Callable[[Any], DataFrame], kind: type = Delivery) -> Query:
        return lambda spark, sf_dir: build(delivery(spark, sf_dir, kind))

    registered = {name: bind(build) for name, build in _BUILDERS.items()}
    registered |= {name: bind_ingest(build) for name, build in _INGEST.items()}
    registered |= {name: bind_ingest(build, kind) for name, (kind, build) in _OTHER_DELIVERIES.items()}
    if llm_queries:
        registered |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return registered


def oracle_sql() -> dict[str, str]:
    own = {**_BUILDERS, **_INGEST, **_OTHER_DELIVERIES}
    statements = {name: oracle_catalog.statement(sql) for name, sql in oracle_catalog.QUERIES.items() if name in own}
    if llm_queries:
        statements |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements
