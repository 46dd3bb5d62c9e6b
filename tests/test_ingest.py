"""Five wire formats, contract gate, landing and schema evolution, on files written here.

Transactions are delivered as Parquet: the Avro package is not part of this image.
"""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.schemas import LAKE_MERCHANTS, LAKE_TRANSACTIONS, RAW_TRANSACTIONS
from ledgerloom.sources import contracts, feeds, lake, readers, sinks

CUSTOMERS = [
    {
        "customer_id": "CUS-000000001", "created_at": "2026-01-01T09:30:00Z", "segment": "mass", "marketing_consent": True,
        "profile": {"first_name": "Ann", "last_name": "Lee", "date_of_birth": "1990-02-03", "email": "a@example.com", "phone": None},
        "address": {"line1": "1 Road", "line2": None, "city": "Leeds", "postcode": "LS1 1AA", "country": "GB"},
        "kyc": {"status": "verified", "verified_at": "2026-01-02T00:00:00Z", "risk_band": "low"},
    },
    {
        "customer_id": "CUS-000000002", "created_at": "2026-01-01T10:00:00Z", "segment": "premier", "marketing_consent": False,
        "profile": {"first_name": "Bo", "last_name": "Ray", "date_of_birth": "not a date", "email": "b@example.com", "phone": "07"},
        "address": {"line1": "2 Road", "line2": "Flat", "city": "York", "postcode": "YO1 1AA", "country": "GB"},
        "kyc": {"status": "pending", "verified_at": "soon", "risk_band": "high"},
    },
]


def line(document):
    return json.dumps(document, separators=(",", ":"))


def transaction(i, day, **change):
    base = dict(
        transaction_id=f"TXN-{i}", card_id="CRD-1", account_id="ACC-1", merchant_id="MER-1",
        txn_timestamp=dt.datetime.fromisoformat(f"{day}T12:00:00+00:00"), posted_date=dt.date.fromisoformat(day),
        amount_minor=1000 + i, currency="GBP", mcc=5411, auth_code="A1", txn_type="purchase", channel="contactless",
        status="settled", pos_entry_mode="07", is_recurring=False,
    )
    return base | change


def deliver(spark, raw: Path, fmt="parquet"):
    """A small delivery in every format: v1 on the first day, v2 on the second."""
    for folder in ("customers", "accounts", "cards", "merchants"):
        (raw / folder).mkdir(parents=True)
    (raw / "customers/customers.jsonl").write_text("\n".join(line(c) for c in CUSTOMERS) + "\n\n")
    (raw / "accounts/accounts.csv").write_text(
        # not in contract order: columns are bound by name
        "customer_id,account_id,product_code,currency,status,opened_date,closed_date,overdraft_limit_minor\n"
        "CUS-000000001,ACC-1,CURRENT,GBP,open,2026-01-01,,0\n"
        "CUS-000000002,NA,SAVER,GBP,closed,2026-01-01,never,5000\n"
    )
    (raw / "cards/cards.csv").write_text(
        "card_id,account_id,card_type,network,issued_date,expiry_date,status\n"
        "CRD-1,ACC-1,debit,visa,2026-01-01,2029-01-01,active\nCRD-2,NA,debit,visa,2026-01-01,2029-01-01,active\n"
    )
    merchants = spark.createDataFrame(
        [("MER-1", "Shop", 5411, "groceries", "GB", False, dt.date(2020, 1, 1))], LAKE_MERCHANTS
    )
    merchants.coalesce(1).write.parquet(str(raw / "merchants/merchants.parquet"))
    for day, rate in (("2026-06-01", 0.85), ("2026-06-02", 0.86)):
        folder = raw / f"fx_rates/rate_date={day}"
        folder.mkdir(parents=True)
        body = [
            {"rate_date": day, "currency": c, "rate_to_gbp": r, "source": "t"} for c, r in (("GBP", 1.0), ("EUR", rate))
        ]
        (folder / "rates.json").write_text(json.dumps(body, indent=1))
    days = {
        "2026-06-01": ([transaction(1, "2026-06-01"), transaction(2, "2026-06-01", merchant_id=None)], True),
        "2026-06-02": (
            [transaction(3, "2026-06-02", currency="EUR"), transaction(3, "2026-06-02", currency="EUR"),
             transaction(4, "2026-06-02", card_id="CRD-9")], False,
        ),
    }
    for day, (rows, first_version) in days.items():
        df = spark.createDataFrame(rows, RAW_TRANSACTIONS)
        if first_version:
            df = df.drop("pos_entry_mode", "is_recurring")
        sinks.write_feed(df.coalesce(1), str(raw / f"card_transactions/posted_date={day}"), fmt)
    return raw


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return deliver(spark, tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def landed(spark, raw, tmp_path_factory):
    target = tmp_path_factory.mktemp("lake")
    return target, lake.land(spark, str(raw), str(target), fmt="parquet")


def test_observation_sees_field_names_only(spark, raw):
    seen = readers.observe_all(spark, str(raw), "parquet")
    assert sorted(seen) == ["accounts", "card_transactions", "cards", "customers", "fx_rates", "merchants"]
    assert seen["customers"] == set(CUSTOMERS[0])
    assert seen["fx_rates"] == {"rate_date", "currency", "rate_to_gbp", "source"}
    # the newest partition is the one looked at
    assert {"pos_entry_mode", "is_recurring"} <= seen["card_transactions"]


def test_absent_feeds_are_absent_and_empty_files_have_no_fields(spark, tmp_path):
    assert readers.observe_all(spark, str(tmp_path), "parquet") == {}
    (tmp_path / "empty.jsonl").write_text("")
    assert readers.observe_jsonl(spark, str(tmp_path / "empty.jsonl")) == frozenset()
    (tmp_path / "empty.json").write_text("[]")
    assert readers.observe_json_array(spark, str(tmp_path / "empty.json")) == frozenset()


def test_customers_flatten_and_keep_their_document(spark, raw):
    df = readers.read_customers(spark, f"{raw}/customers/customers.jsonl")
    ann, bo = df.orderBy("customer_id").collect()
    assert ann["first_name"] == "Ann" and ann["date_of_birth"] == dt.date(1990, 2, 3) and ann["address_line2"] is None
    assert bo["date_of_birth"] is None and bo["kyc_verified_at"] is None and bo["kyc_status"] == "pending"
    assert json.loads(ann["document"]) == CUSTOMERS[0]
    assert df.select(F.col("created_at").cast("string")).first()[0] == "2026-01-01 09:30:00"


def test_a_bad_creation_time_fails_the_read(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text(line(CUSTOMERS[0] | {"created_at": "yesterday"}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_customers(spark, str(path)).collect()


def test_csv_feeds_bind_by_name_and_differ_in_null_tokens(spark, raw):
    accounts = readers.read_accounts(spark, f"{raw}/accounts/accounts.csv").orderBy("customer_id").collect()
    assert [a["account_id"] for a in accounts] == ["ACC-1", "NA"]
    assert [a["closed_date"] for a in accounts] == [None, None]
    assert accounts[1]["overdraft_limit_minor"] == 5000
    cards = readers.read_cards(spark, f"{raw}/cards/cards.csv").orderBy("card_id").collect()
    assert [c["account_id"] for c in cards] == ["ACC-1", None]


def test_mixed_history_is_one_shape(spark, raw):
    df = readers.read_transactions(spark, f"{raw}/card_transactions", "parquet")
    assert df.columns == [*LAKE_TRANSACTIONS.names, "posted_date"]
    got = {(r["feed_version"], r["pos_entry_mode"], r["is_recurring"]) for r in df.collect()}
    assert got == {(1, None, None), (2, "07", False)}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_files_of_both_versions_share_a_day(spark, tmp_path, fmt):
    base = tmp_path / "card_transactions"
    day = base / "posted_date=2026-06-03"
    both = spark.createDataFrame([transaction(7, "2026-06-03")], RAW_TRANSACTIONS)
    sinks.write_feed(both.drop("pos_entry_mode", "is_recurring").coalesce(1), str(tmp_path / "old"), fmt)
    sinks.write_feed(both.coalesce(1), str(tmp_path / "new"), fmt)
    day.mkdir(parents=True)
    for part in ("old", "new"):
        (file,) = [f for f in (tmp_path / part).iterdir() if f.suffix == f".{fmt}"]
        (day / f"{part} file.{fmt}").write_bytes(file.read_bytes())
    got = readers.read_transactions(spark, str(base), fmt).select("feed_version", "pos_entry_mode", "is_recurring")
    assert sorted(map(tuple, got.collect())) == [(1, None, None), (2, "07", False)]


def test_json_history_reads_the_same(spark, raw, tmp_path):
    other = deliver(spark, tmp_path / "raw", "json")
    as_json = readers.read_transactions(spark, f"{other}/card_transactions", "json")
    as_parquet = readers.read_transactions(spark, f"{raw}/card_transactions", "parquet")
    assert as_json.exceptAll(as_parquet).count() == 0 and as_json.count() == 5


def test_avro_without_its_package_says_which(spark, raw):
    with pytest.raises(RuntimeError, match="spark-avro"):
        readers.writer_fields(spark, f"{raw}/card_transactions", "avro")


def test_landing_conserves_rows_and_reports_them(spark, raw, landed):
    target, metrics = landed
    out = {r["feed"]: (r["rows"], r["partitions"], r["verdict"]) for r in metrics.collect()}
    assert out["card_transactions"] == (5, 2, "compatible")
    assert out["fx_rates"] == (4, None, "compatible")
    kept = spark.read.json(f"{target}/_ingest")
    assert kept.count() == 6
    sources = {"customers": readers.read_customers(spark, f"{raw}/customers/customers.jsonl"),
               "card_transactions": readers.read_transactions(spark, f"{raw}/card_transactions", "parquet")}
    assert {r["lost"] for r in lake.row_conservation(spark, sources, str(target)).collect()} == {0}


def test_partition_key_lives_in_the_path_only(spark, landed):
    target, _ = landed
    files = list((target / "card_transactions").glob("posted_date=2026-06-02/*.parquet"))
    assert files and "posted_date" not in spark.read.parquet(str(files[0])).columns
    days = readers.partition_dates(spark, f"{target}/card_transactions").collect()
    assert [r["day"] for r in days] == [dt.date(2026, 6, 1), dt.date(2026, 6, 2)]
    narrow = feeds.scan_lake(spark, str(target), "card_transactions", ["transaction_id", "posted_date"])
    assert narrow.columns == ["transaction_id", "posted_date"]


def test_a_broken_feed_lands_nothing(spark, tmp_path):
    raw = deliver(spark, tmp_path / "raw")
    cards = raw / "cards/cards.csv"
    cards.write_text(cards.read_text().replace("network", "card_network"))
    with pytest.raises(contracts.SchemaDriftError, match="network"):
        lake.land(spark, str(raw), str(tmp_path / "lake"), fmt="parquet")
    assert not (tmp_path / "lake").exists()
    # forced, it lands: the promised column is null and the verdict is on record
    metrics = lake.land(spark, str(raw), str(tmp_path / "lake"), fmt="parquet", force=True)
    assert metrics.where("verdict = 'breaking'").first()["feed"] == "cards"
    assert feeds.scan_lake(spark, str(tmp_path / "lake"), "cards").where("network is not null").count() == 0


def test_an_additional_field_lands(spark, tmp_path):
    raw = deliver(spark, tmp_path / "raw")
    cards = raw / "cards/cards.csv"
    head, *rest = cards.read_text().splitlines()
    cards.write_text("\n".join([head + ",score", *[r + ",1" for r in rest]]))
    metrics = lake.land(spark, str(raw), str(tmp_path / "lake"), fmt="parquet")
    assert metrics.where("feed = 'cards'").first()["verdict"] == "additive"


def test_landed_lake_builds_the_marts(spark, landed):
    target, _ = landed
    w = Warehouse(spark, feeds.load(spark, str(target), "2026-06-03 00:00:00"))
    fact = {r["transaction_id"]: r for r in w.fact.collect()}
    assert sorted(fact) == ["TXN-1", "TXN-2", "TXN-3", "TXN-4"]
    assert fact["TXN-3"]["dq_duplicated"] and fact["TXN-3"]["amount_gbp_minor"] == round(1003 * 0.86)
    assert fact["TXN-2"]["dq_missing_merchant"] and fact["TXN-2"]["merchant_key"] == "UNKNOWN"
    assert fact["TXN-4"]["dq_orphan_card"] and fact["TXN-4"]["card_key"] == "UNKNOWN"
    assert {r["customer_id"] for r in fact.values()} == {"CUS-000000001"}


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_feeds_write_in_their_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    sinks.write_feed(df, str(tmp_path / "out"), fmt)
    back = spark.read.option("header", True).schema("k string, v int").format(fmt).load(str(tmp_path / "out"))
    assert sorted(back.collect()) == sorted(df.collect())


def test_ledger_write_counts(spark, tmp_path):
    ledger = spark.createDataFrame([("D01", "t1"), ("D03", "t2")], "defect_code string, transaction_id string")
    assert sinks.write_ledger(ledger, str(tmp_path / "defects")) == 2
    assert spark.read.parquet(str(tmp_path / "defects")).columns == ["transaction_id", "defect_code"]


def test_a_hot_day_is_written_as_several_files(spark, tmp_path):
    overrides = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in overrides}
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-01")).otherwise(F.date_add(F.lit("2026-02-01").cast("date"), (F.col("id") % 5).cast("int")))
        .cast("date").alias("posted_date"), F.md5(F.col("id").cast("string")).alias("v"),
    )
    try:
        for key, value in overrides.items():
            spark.conf.set(key, value)
        assert sinks.counted_write(df, str(tmp_path / "t"), "posted_date") == 200_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(list((tmp_path / "t/posted_date=2026-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_landing_again_replaces_only_the_delivered_days(spark, tmp_path):
    days = spark.createDataFrame([(dt.date(2026, 1, 1), 1), (dt.date(2026, 1, 2), 2)], "posted_date date, v int")
    sinks.counted_write(days, str(tmp_path / "t"), "posted_date")
    sinks.counted_write(days.where("v = 2").withColumn("v", F.lit(20)), str(tmp_path / "t"), "posted_date")
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 20]


def test_arranged_days_are_written_without_a_shuffle(spark, tmp_path):
    days = spark.range(40_000).select(
        F.col("id").alias("v"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("posted_date")
    )
    sinks.counted_write(days, str(tmp_path / "raw"), "posted_date")
    delivered = spark.read.parquet(str(tmp_path / "raw"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("arranged", "arranged")
    try:
        assert sinks.counted_write(delivered, str(tmp_path / "t"), "posted_date", arranged=True) == 40_000
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for job in tracker.getJobIdsForGroup("arranged") for s in tracker.getJobInfo(job).stageIds]
    assert len(stages) == 1
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= len(list((tmp_path / "raw").rglob("*.parquet")))
    landed = spark.read.parquet(str(tmp_path / "t"))
    assert landed.exceptAll(days).count() == 0 and landed.count() == 40_000
