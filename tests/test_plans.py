"""Plan shapes, skew paths, serving copies and the pattern registry."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import asof, reshape, scd2
from ledgerloom.plans import marts, metrics, patterns, publishing, reports, serving, spend
from ledgerloom.plans.warehouse import GoldMarts, Warehouse
from ledgerloom.session import build_session, new_folder, shared_folder
from ledgerloom.sources import sinks
from tests.conftest import SF_DIR

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", [*entry._BUILDERS, *entry._INGEST])
def test_no_query_plans_a_cross_join_or_python(spark, name):
    text = patterns.plan_text(entry.queries()[name](spark, SF_DIR))
    assert not [bad for bad in BAD if bad in text]


def test_month_filter_opens_few_files(spark, w):
    rows = w.fact_by_month.where(F.col("posted_month") == "1998-05")
    assert "PartitionFilters: [isnotnull(posted_month" in patterns.plan_text(rows)
    assert patterns.files_touched(rows).first()["files"] == 1
    assert patterns.files_touched(w.fact_by_month).first()["files"] > 50


def test_two_column_question_reads_two_columns(spark, w):
    text = patterns.plan_text(patterns.full_scan(w))
    assert "ReadSchema: struct<amount_minor:bigint>" in text


def test_customer_lookup_is_pushed_to_the_scan(spark, w):
    p = patterns.pick_parameters(w)
    text = patterns.plan_text(patterns.customer_document(w, p))
    assert "EqualTo(customer_id" in text and "Exchange" not in text


def test_top_k_is_cut_before_the_shuffle(spark, w):
    assert patterns.plan_text(patterns.top_merchants_per_segment(w)).count("WindowGroupLimit") >= 2


def test_scorecard_scans_the_fact_once(spark, w):
    text = patterns.plan_text(marts.agg_dq_scorecard(w.fact))
    assert text.count("(1) Scan parquet") >= 1 and "Scan parquet" not in text.split("(2)")[-1].split("(1) Scan")[0]
    assert text.count("Location: InMemoryFileIndex") == 1


def test_large_merchant_dimension_gives_the_same_answers(spark, w, monkeypatch):
    """With the broadcast check failing, rows are counted per key before the join."""
    def answers():
        return [
            patterns.category_month_all(w).collect(),
            patterns.top_merchants_per_segment(w).collect(),
            sorted(reports.spend_by_category(w).collect()),
            sorted(metrics.category_mix(w).collect()),
        ]

    small = answers()
    context = w.context(F.col("is_settled"), "counts_towards_spend", "is_card_not_present")
    agg = marts.agg_customer_category_month(w.fact, context, w.dim_merchant, True)
    monkeypatch.setattr(Warehouse, "broadcastable", lambda self, name: False)
    assert answers() == small
    big = marts.agg_customer_category_month(w.fact, context, w.dim_merchant, False)
    assert big.exceptAll(agg).count() == 0 and agg.exceptAll(big).count() == 0


def test_fact_without_broadcasts_is_the_same(spark, w):
    """The shuffled form of every lookup, as a cluster-sized dimension would force it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = marts.fact(w.scored, w.fx_rate, w.account_timeline, w.dim_txn_context)
        text = patterns.plan_text(shuffled)
        assert text.count("SortMergeJoin") >= 4
        assert not [bad for bad in BAD if bad in text]
        assert shuffled.exceptAll(w.fact).count() == 0 and w.fact.exceptAll(shuffled).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_are_split_by_the_skew_join(spark, tmp_path):
    """A third of all rows on one account or card: AQE splits its partition, the result stays whole."""
    overrides = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in overrides}
    try:
        for key, value in overrides.items():
            spark.conf.set(key, value)
        n = 300_000
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).cast("string")
        left = spark.range(n).select(key.alias("acc"), F.lit("2026-01-15").cast("timestamp_ntz").alias("at"), "id")
        dim = spark.range(1000).select(
            F.col("id").cast("string").alias("account_id"), F.lit("2026-01-01").cast("timestamp_ntz").alias("valid_from"),
            F.lit("2026-02-01").cast("timestamp_ntz").alias("valid_to"), F.lit("x").alias("key"),
        )
        joined = scd2.scd2_join(left, dim, "acc", "account_id", "at")
        assert joined.where("key is not null").select("id").distinct().count() == n
        dim.select("account_id").write.parquet(str(tmp_path / "known"))
        known = spark.read.parquet(str(tmp_path / "known"))
        present = reshape.presence_flag(left, "acc", known, "account_id", "missing")
        assert present.where("not missing").count() == n
        for result in (joined, present):
            tasks = result.select(F.spark_partition_id().alias("p"), "acc").where("acc = '0'")
            seen = tasks.rdd.map(lambda r: r["p"]).distinct().count()
            assert seen > 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_asof_is_an_equality_join(spark, w):
    left = w.deduped.select("transaction_id", "currency", "posted_date")
    joined = asof.asof_join(left, w.feeds.fx_rates, "currency", "posted_date", "rate_date", "rate_to_gbp", "r")
    text = patterns.plan_text(joined)
    assert not [bad for bad in BAD if bad in text]


def test_dense_grid_needs_no_cross_join(spark, w):
    text = patterns.plan_text(marts.fx_daily(w.feeds.fx_rates, w.deduped))
    assert not [bad for bad in BAD if bad in text]


# ------------------------------------------------------------------ registries


def test_reports_name_their_question_and_owner():
    assert len(reports.REPORTS) == 9
    assert all(r.question and r.date_basis and "@" in r.owner for r in reports.REPORTS.values())


def test_unsupported_forms_are_named(w):
    with pytest.raises(patterns.UnsupportedPattern, match="document"):
        patterns.pattern("category_month_spend_all_customers").answer("document", w)
    with pytest.raises(patterns.UnsupportedPattern, match="nothing"):
        patterns.pattern("nothing")


def test_patterns_answer_from_each_store(w):
    p = patterns.pick_parameters(w)
    for found in patterns.PATTERNS.values():
        for store in found.forms:
            args = [p] if found.key.startswith("customer") else []
            assert found.answer(store, w, *args).count() > 0


def test_headline_is_the_sum_of_its_months(w):
    head = reports.headline(w).first()
    months = reports.spend_by_month(w).agg(F.sum("spend_gbp"), F.sum("txn_count")).first()
    assert head["spend_gbp"] == pytest.approx(months[0]) and head["txn_count"] == months[1]


def test_channel_mix_share_of_an_empty_month(spark):
    class Quiet:
        pass

    frame = spark.createDataFrame([("2026-01", 0.0, 0.0), ("2026-02", 3.0, 1.0)], "month_key string, card_present_gbp double, online_gbp double")
    original = reports.channel_mix_by_month
    try:
        reports.channel_mix_by_month = lambda w: frame
        out = dict(reports.channel_mix_with_share(Quiet()).select("month_key", "online_share").collect())
    finally:
        reports.channel_mix_by_month = original
    assert out == {"2026-01": 0.0, "2026-02": 0.25}


def test_status_bands(spark):
    df = spark.createDataFrame([(0.995,), (0.99,), (0.985,), (0.97,)], "r double")
    assert [r[0] for r in df.select(reports.status_band(F.col("r"))).collect()] == ["good", "good", "warning", "critical"]


def test_segment_by_time_differs_from_segment_today(w):
    now = {r["segment"]: r["spend_gbp"] for r in reports.spend_by_segment(w).collect()}
    then = {r["segment"]: r["spend_gbp"] for r in reports.spend_by_segment(w, "as_of").collect()}
    assert now.keys() == then.keys() and now != then


# ------------------------------------------------------------------ gold and serving


@pytest.fixture(scope="module")
def small(spark, w):
    """The warehouse with the fact cut to a few days, so that daily directories stay few, and its aggregates made anew."""
    class Few(Warehouse):
        pass

    few = Few(spark, w.feeds)
    days = [dt.date(1998, 5, d) for d in range(1, 8)]
    of_fact = ("fact", "fact_by_month", "agg_customer_category_month", "agg_dq_scorecard", "customer_months")
    few.__dict__.update({k: v for k, v in w.__dict__.items() if k not in of_fact})
    few.__dict__["fact_by_month"] = w.fact_by_month.where(F.col("posted_date").isin(days))
    few.__dict__["fact"] = few.fact_by_month.drop("posted_month")
    return few


def test_gold_export_reports_rows_and_partitions(spark, small, tmp_path):
    report = {r["table"]: r for r in serving.export_gold(small, str(tmp_path / "gold")).collect()}
    assert len(report) == 11
    n = small.fact.count()
    assert report["fct_card_transaction"]["rows"] == n
    assert report["fct_card_transaction"]["partitions"] == small.fact.select("posted_date").distinct().count()
    for name in ("dim_customer", "agg_dq_scorecard"):
        assert report[name]["rows"] == serving.scan_gold(spark, str(tmp_path / "gold"), name).count()
    fact = serving.scan_gold(spark, str(tmp_path / "gold"), "fct_card_transaction", "posted_date", "amount_minor")
    one = fact.where(F.col("posted_date") == F.lit(dt.date(1998, 5, 2)))
    assert "PartitionFilters: [isnotnull(posted_date" in patterns.plan_text(one)
    # exporting again replaces, never doubles
    serving.export_gold(small, str(tmp_path / "gold"))
    assert serving.scan_gold(spark, str(tmp_path / "gold"), "fct_card_transaction").count() == n


def test_reports_run_on_the_exported_gold(spark, small, tmp_path):
    gold = str(tmp_path / "gold")
    serving.export_gold(small, gold)
    marts_again = GoldMarts(spark, gold)
    p = patterns.pick_parameters(small)
    assert patterns.pick_parameters(marts_again) == p
    for report in reports.REPORTS.values():
        assert report.build(marts_again).collect() == report.build(small).collect(), report.key
    for build in (patterns.category_month_all, patterns.top_merchants_per_segment, patterns.fx_revaluation_stored):
        assert build(marts_again).collect() == build(small).collect()
    recent = patterns.customer_12m_from_fact(marts_again, p)
    assert recent.collect() == patterns.customer_12m_from_fact(small, p).collect()
    assert "PartitionFilters: [isnotnull(posted_date" in patterns.plan_text(recent)
    assert sorted(metrics.category_mix(marts_again).collect()) == sorted(metrics.category_mix(small).collect())
    with pytest.raises(LookupError):
        marts_again.staged


def test_serving_copies(spark, small, tmp_path):
    serving.publish(small, str(tmp_path / "serving"))
    found = Path(publishing.current_path(spark, str(tmp_path / "serving")))
    for name, df in serving.tables(small).items():
        assert spark.read.parquet(str(found / name)).count() == df.count()
    people = spark.read.parquet(str(found / "dim_customer_current"))
    assert people.where("customer_id = 'UNKNOWN' or postcode is not null").count() == 0
    months = list((found / "fct_card_transaction_by_month").glob("posted_month=*"))
    assert [m.name for m in months] == ["posted_month=1998-05"]


def test_clustering_spreads_a_hot_customer(spark):
    from ledgerloom.session import clustered

    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"), "id")
    out = clustered(df, ("c", "id")).select(F.spark_partition_id().alias("p"), "c").where("c = 'hot'")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep the tiny ranges apart
        assert out.select("p").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_loaded_means_reachable_and_not_empty(spark, tmp_path):
    assert not sinks.is_loaded(spark, str(tmp_path / "none"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    spark.range(1).write.parquet(str(tmp_path / "full"))
    assert not sinks.is_loaded(spark, str(tmp_path / "empty"))
    assert sinks.is_loaded(spark, str(tmp_path / "full"))


def test_reports_write_csv(spark, w, tmp_path):
    sinks.write_csv(reports.dq_by_dimension(w), str(tmp_path / "dq"))
    back = spark.read.csv(str(tmp_path / "dq"), header=True)
    assert back.columns == ["dimension", "rows_checked", "rows_failed", "pass_rate"] and back.count() == 6


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert build_session() is not None


def test_parameterised_sql_ignores_extra_names(spark, w):
    w.fact.createOrReplaceTempView("fact_view")
    p = patterns.pick_parameters(w)
    bag = {"customer_id": p.customer_id, "from_date": p.from_date, "unused": 1}
    n = spark.sql("SELECT count(*) AS n FROM fact_view WHERE customer_id = :customer_id", args=bag).first()["n"]
    assert n == w.fact.where(F.col("customer_id") == p.customer_id).count()


def test_by_segment_counts_each_customer_once(w):
    rows = spend.spending(w)
    total = spend.by_segment(w, rows, F.col("amount_gbp_minor")).agg(F.sum("customers")).first()[0]
    known = rows.join(spend.current_customers(w), "customer_id").select("customer_id").distinct().count()
    assert total == known


def test_fresh_yesterday_asks_for_the_newest_day_of_the_book(w):
    from types import SimpleNamespace

    book = w.deduped.where(F.col("posted_date") < dt.date(1997, 3, 8))
    row = entry.fresh_yesterday(SimpleNamespace(deduped=book)).first()
    assert row["due_date"] == dt.date(1997, 3, 7)
    assert row["arrived"]


def test_copies_are_found_where_the_lines_lie(spark, w):
    """The whole staged row is never shuffled by its id; the lines are, by order, while they are narrow."""
    text = patterns.plan_text(marts.deduped(w.feeds.grouped_transactions))
    assert "hashpartitioning(l_orderkey" in text
    assert "hashpartitioning(feed_group" not in text and "hashpartitioning(key_hash" not in text
    assert "transaction_id" not in "".join(line for line in text.splitlines() if "Exchange" in line)
    plain = marts.deduped(w.feeds.transactions)
    assert plain.columns == w.deduped.columns
    assert plain.exceptAll(w.deduped).count() == 0 and w.deduped.exceptAll(plain).count() == 0


def test_cards_of_other_accounts_and_rows_without_account(w):
    """The one join on the account answers what the joins by card and by account do."""
    n = F.xxhash64("transaction_id")
    rows = w.deduped.withColumns({
        "account_id": F.when(n % 5 != 0, F.col("account_id")),
        "card_id": F.when(n % 7 == 0, F.lit("CRD-2")).when(n % 11 != 0, F.col("card_id")),
    })
    plain = marts.fact(marts.scored(rows, w.card_ids, w.medians), w.fx_rate, w.account_timeline, w.dim_txn_context)
    lookup = marts.account_lookup(rows, w.card_ids, w.account_timeline)
    lean = marts.fact_measures(marts.fact_keys(rows, lookup, w.dim_txn_context), w.medians, w.fx_rate)
    assert plain.where("account_key = 'UNKNOWN' and not dq_orphan_card").count() > 100
    assert lean.columns == plain.columns
    assert lean.exceptAll(plain).count() == 0 and plain.exceptAll(lean).count() == 0
