from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, money, text
from ledgerloom.operators import checks, detection, rules
from ledgerloom.plans import marts, monitors
from ledgerloom.sources.feeds import with_auth_date

D = dt.date.fromisoformat
SCHEMA = (
    "transaction_id string, card_id string, merchant_id string, txn_type string, amount_minor bigint, mcc int, "
    "posted_date date, auth_date date, was_duplicated boolean"
)


def scored(spark, *data, medians=((5411, 1000.0),)):
    cards = spark.createDataFrame([("c",)], "card_id string")
    typical = spark.createDataFrame(list(medians), "mcc int, median_amount_minor double")
    out = rules.apply_rules(spark.createDataFrame(list(data), SCHEMA), cards, typical)
    return {r["transaction_id"]: r for r in out.collect()}


def test_flags_thresholds_and_score(spark):
    day, late = D("2026-01-01"), D("2026-01-04")
    out = scored(
        spark,
        ("ok", "c", "m", "purchase", 40_000, 5411, D("2026-01-03"), day, False),
        ("over", "c", "m", "purchase", 40_001, 5411, day, day, False),
        ("default", "c", "m", "purchase", 2_000_001, 5812, day, day, False),
        ("all", "x", None, "purchase", -9_000_000, 99999, late, day, True),
        ("refund", "c", None, "refund", -10, 5411, day, day, False),
        ("undated", "c", "m", "purchase", 10, 5411, day, None, False),
    )
    assert out["ok"]["dq_score"] == 100 and out["ok"]["posting_lag_days"] == 2
    assert out["over"]["dq_implausible_amount"] and out["over"]["dq_score"] == 80
    assert out["default"]["dq_implausible_amount"]
    assert all(out["all"][flag] for flag in rules.FLAGS.values()) and out["all"]["dq_score"] == 5
    assert out["refund"]["dq_score"] == 100
    assert out["undated"]["dq_late_posting"] is None and out["undated"]["dq_score"] == 0
    assert len(out) == 6


def test_detection_quality_and_missed_value(spark):
    fact = spark.createDataFrame(
        [("a", True, 100), ("b", True, 200), ("c", False, 300), ("d", False, 400)],
        "transaction_id string, bad boolean, amount bigint",
    )
    ledger = spark.createDataFrame([("a", "D1"), ("c", "D1"), ("c", "D1"), ("d", "D2")], "transaction_id string, defect_code string")
    flagged = detection.flagged_rows(fact, {"D1": "bad"})
    out = {r["defect_code"]: tuple(r)[1:] for r in detection.detection_quality(flagged, ledger).collect()}
    assert out == {"D1": (2, 2, 1, 0.5, 0.5), "D2": (1, 0, 0, 0.0, 0.0)}
    missed = detection.undetected_value(fact, ledger, "D1", "bad", "amount").first()
    assert tuple(missed) == (2, 1, 3.0)


def test_injection_is_recorded_and_repeatable(spark):
    feed = spark.range(20_000).select(F.col("id").cast("string").alias("key"), F.lit(5).cast("bigint").alias("v"))
    plan = [
        detection.Injection("X", 0.1, F.col("id_even"), {"v": F.lit(-1)}),
        detection.Injection("TWICE", 0.05, F.lit(True)),
    ]
    feed = feed.withColumn("id_even", F.col("key").cast("int") % 2 == 0)
    dirty, ledger = detection.inject_defects(feed, "key", plan, seed=3)
    counts = {r["defect_code"]: r["count"] for r in ledger.groupBy("defect_code").count().collect()}
    assert 800 < counts["X"] < 1200 and 800 < counts["TWICE"] < 1200
    assert dirty.count() == 20_000 + counts["TWICE"]
    assert dirty.where("v = -1").select("key").distinct().count() == counts["X"]
    again, _ = detection.inject_defects(feed.repartition(3), "key", plan, seed=3)
    assert again.exceptAll(dirty).count() == 0
    other, _ = detection.inject_defects(feed, "key", plan, seed=4)
    assert other.exceptAll(dirty).count() > 0


def test_floors_on_the_planted_feed(spark, w):
    import __spark_entry__ as entry

    out = {r["defect_code"]: r for r in entry.detection_recall_precision(w).collect()}
    for code in ("D01", "D03", "D04", "D05", "D06"):
        assert out[code]["recall"] == 1.0 and out[code]["precision"] == 1.0, code
    assert out["D07"]["injected"] > 0


def test_london_date_around_midnight(spark):
    when = [dt.datetime(2026, 6, 10, 23, 30), dt.datetime(2026, 1, 10, 23, 30)]
    df = with_auth_date(spark.createDataFrame([(t,) for t in when], "txn_timestamp timestamp_ntz"))
    assert [r["auth_date"] for r in df.orderBy("txn_timestamp").collect()] == [D("2026-01-10"), D("2026-06-11")]


def test_london_date_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp '2026-06-10 23:30:00 UTC' AS txn_timestamp")
        row = with_auth_date(df).select(F.col("txn_timestamp").cast("string").alias("t"), "auth_date").first()
        assert tuple(row) == ("2026-06-10 23:30:00", D("2026-06-11"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dim_date_edges(spark):
    posted = spark.createDataFrame([(D("2026-03-01"),), (D("2026-06-30"),)], "posted_date date")
    out = {r["calendar_date"]: r for r in marts.dim_date(posted).collect()}
    assert len(out) == 366 and min(out) == D("2026-01-01") and max(out) == D("2027-01-01")
    assert out[D("2026-04-05")]["uk_fiscal_year"] == 2025 and out[D("2026-04-06")]["uk_fiscal_year"] == 2026
    assert out[D("2027-01-01")]["iso_week"] == 53 and out[D("2027-01-01")]["day_name"] == "Friday"
    assert out[D("2026-06-06")]["is_weekend"] and out[D("2026-06-06")]["iso_day_of_week"] == 6
    assert out[D("2026-06-08")]["iso_day_of_week"] == 1 and out[D("2026-06-08")]["date_key"] == 20260608


def test_conversion_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 0.5), (-5, 0.5), (7, 1.0)], "a bigint, r double")
    assert [r[0] for r in df.select(money.convert(F.col("a"), F.col("r"))).collect()] == [3, -3, 7]


@pytest.mark.parametrize(
    ("code", "label"),
    [("unknown", "ATM, fees and unmatched"), ("eating_out", "Eating out"), ("misc_retail", "Other retail"), ("fuel", "Fuel")],
)
def test_reader_label(spark, code, label):
    assert spark.range(1).select(text.reader_label(F.lit(code))).first()[0] == label


def test_postcodes(spark):
    df = spark.createDataFrame([("SW1A 1AA",), ("M1 1AE",), ("m11ae",), ("12345",)], "p string")
    assert [r[0] for r in df.select(text.postcode_ok(F.col("p"))).collect()] == [True, True, False, False]
    assert df.select(text.squash(F.col("p"))).first()[0] == "sw1a1aa"


def test_date_keys(spark):
    df = spark.createDataFrame([(D("2026-02-03"),)], "d date")
    assert tuple(df.select(dates.date_key(F.col("d")), dates.month_key(F.col("d"))).first()) == (20260203, "2026-02")


def test_reconcile_treats_a_missing_side_as_a_difference(spark):
    left = spark.createDataFrame([(1, 10), (2, 20)], "k int, t bigint")
    right = spark.createDataFrame([(1, 10), (3, 5)], "k int, t bigint")
    out = {r["k"]: (r["difference"], r["agrees"]) for r in checks.reconcile(left, right, ["k"], "t").collect()}
    assert out == {1: (0, True), 2: (20, False), 3: (-5, False)}


def test_generic_checks_count(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    parent = spark.createDataFrame([("b",)], "p string")
    assert checks.not_null(df, "t", ["k", "v"]).collect() == [("t.k not null", 1), ("t.v not null", 0)]
    assert checks.unique(df, "t", ["k"]).first()["violations"] == 1
    assert checks.accepted_values(df, "t", "v", [1, 2]).first()["violations"] == 1
    assert checks.relationship(df, "k", parent, "p", "fk").first()["violations"] == 2


def test_freshness_uses_calendar_days(spark):
    days = [(D("2026-01-01") + dt.timedelta(days=i // 10),) for i in range(300)] + [(D("2026-01-31"),)] * 50
    out = monitors.freshness(spark.createDataFrame(days, "posted_date date")).orderBy("posted_date").collect()
    assert out[0]["history_days"] == 0 and out[0]["within_limits"] is None
    assert out[-1]["txn_count"] == 50 and out[-1]["history_days"] == 28 and out[-1]["within_limits"] is False
    assert out[-2]["within_limits"] is True


def test_publish_gate_closes_on_a_violation(spark, w):
    assert monitors.publish_gate(w).first()["publishable"]
    broken = w.fact.limit(100).withColumn("fx_rate_to_gbp", F.lit(None).cast("double"))

    class Broken:
        fact = broken

    found = {r["check"]: r["violations"] for r in monitors.fact_checks(Broken).collect()}
    assert found["fact without fx rate"] == 100


def test_feed_arrival(spark):
    one, two = spark.range(1), spark.range(2)
    out = {r["feed"]: tuple(r)[1:] for r in monitors.feed_arrival({"a": two, "b": one.limit(0)}, {"a": one}).collect()}
    assert out == {"a": (2, 1, 1, True), "b": (0, 0, 0, False)}
