"""Versioned tables, lasting history, gated publishing, the file index, figures, arrivals and quarantine."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import declared, scd2
from ledgerloom.plans import metrics, monitors, publishing, serving
from ledgerloom.plans.patterns import plan_text
from ledgerloom.plans.warehouse import GoldMarts, Warehouse
from ledgerloom.schemas import RAW_TRANSACTIONS
from ledgerloom.sources import contracts, driver_delivery, feeds, figures, lake, readers, sinks
from ledgerloom.sources.arrivals import ArrivalLedger, calendar
from ledgerloom.sources.file_index import FileIndex
from ledgerloom.sources.state_history import OutOfOrder, StateHistory
from ledgerloom.sources.versions import CommitConflict, VersionedTable
from tests.test_ingest import deliver, transaction


@pytest.fixture
def quick(spark):
    """Few files for tiny tables."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


# ------------------------------------------------------------------ versions


def test_versions_appear_whole_and_in_order(quick, tmp_path):
    table = VersionedTable(quick, str(tmp_path / "t"))
    assert table.current() is None and table.versions() == []
    with pytest.raises(LookupError):
        table.read()
    table.write(quick.range(3), {"why": "first"})
    staged = table.new_folder()
    quick.range(100).write.parquet(table.path(staged))
    assert table.read().count() == 3  # staged rows are nobody's yet
    table.append(quick.range(3, 5))
    assert table.read().count() == 5
    assert [v.number for v in table.versions()] == [1, 2]
    assert table.read(table.versions()[0]).count() == 3
    assert table.versions()[0].note == {"why": "first"}
    assert table.vacuum(keep=2) == [staged.split("/")[1]]
    assert table.read().count() == 5


def test_the_second_of_two_writers_is_refused(quick, tmp_path):
    table = VersionedTable(quick, str(tmp_path / "t"))
    seen = table.write(quick.range(1))
    folder = table.new_folder()
    quick.range(2).write.parquet(table.path(folder))
    table.append(quick.range(9, 10))
    with pytest.raises(CommitConflict):
        table.commit([folder], schema=quick.range(0).schema, after=seen)
    assert table.read().count() == 2


def test_a_half_written_commit_is_no_version(quick, tmp_path):
    table = VersionedTable(quick, str(tmp_path / "t"))
    table.write(quick.range(1))
    (tmp_path / "t/commits/000002.json").write_text('{"folders": [')
    assert table.current().number == 1 and len(table.versions()) == 1


# ------------------------------------------------------------------ history


STATE = "id string, level string, note string"


def test_history_lasts_over_three_sessions(quick, tmp_path):
    base = str(tmp_path / "h")
    deliveries = {
        "2026-01-01 00:00:00": [("a", "low", "1"), ("b", "low", "1"), ("c", "low", "1")],
        "2026-02-01 00:00:00": [("a", "high", "2"), ("b", "low", "2")],
        "2026-03-01 00:00:00": [("a", "high", "3"), ("b", "low", "3"), ("c", "low", "3")],
    }
    for taken_at, rows in deliveries.items():
        session = quick.newSession()
        session.conf.set("spark.sql.shuffle.partitions", "2")
        StateHistory(session, base, "id", ["level"]).land(session.createDataFrame(rows, STATE), taken_at)
    history = StateHistory(quick, base, "id", ["level"])
    n = len(history.table.versions())
    history.land(quick.createDataFrame([], STATE), "2026-03-01 00:00:00")  # landed before: nothing happens
    assert len(history.table.versions()) == n == 3
    text = lambda c: F.col(c).cast("string").alias(c)
    got = {tuple(r) for r in history.read().select("id", "level", "note", text("valid_from"), text("valid_to")).collect()}
    jan, feb, mar = deliveries
    assert got == {
        ("a", "low", "1", jan, feb), ("a", "high", "2", feb, None), ("b", "low", "1", jan, None),
        ("c", "low", "1", jan, feb), ("c", "low", "3", mar, None),
    }
    assert history.read(feb).count() == 4 and history.read(feb).where("valid_to is null").count() == 2
    with pytest.raises(OutOfOrder):
        history.land(quick.createDataFrame([], STATE), "2026-02-15 00:00:00")
    # closed rows are kept where they were first written
    first, second, third = history.table.versions()
    assert set(second.note["closed"]) < set(third.folders)


def test_merged_history_equals_the_one_of_all_snapshots(quick, w, tmp_path):
    history = StateHistory(quick, str(tmp_path / "h"), "customer_id", ["segment", "kyc_status", "kyc_risk_band"])
    for snapshot in w.feeds.customers:
        history.land(snapshot.rows, snapshot.taken_at)
    names = ["customer_id", "segment", "valid_from", "valid_to"]
    assert sorted(map(repr, history.read().select(*names).collect())) == sorted(map(repr, w.customer_history.select(*names).collect()))


def test_a_lake_with_history_builds_its_marts(quick, tmp_path):
    raw, target = deliver(quick, tmp_path / "raw"), str(tmp_path / "lake")
    lake.land(quick, str(raw), target, fmt="parquet", taken_at="2026-06-02 06:00:00")
    people = [json.loads(x) for x in (raw / "customers/customers.jsonl").read_text().splitlines() if x]
    people[0]["segment"] = "affluent"
    (raw / "customers/customers.jsonl").write_text("\n".join(json.dumps(p) for p in people))
    lake.land(quick, str(raw), target, fmt="parquet", taken_at="2026-06-03 06:00:00")
    w = Warehouse(quick, feeds.load(quick, target))
    versions = w.dim_customer.where("customer_id = 'CUS-000000001'").orderBy("version_number").collect()
    assert [(v["segment"], v["is_current"]) for v in versions] == [("mass", False), ("affluent", True)]
    assert w.fact.count() == 4
    assert scd2.scd2_overlaps(w.dim_customer, "customer_id").count() == 0
    with pytest.raises(LookupError):
        feeds.load(quick, str(tmp_path / "nothing"))


# ------------------------------------------------------------------ publishing


def test_a_violation_leaves_readers_on_the_version_before(quick, tmp_path):
    target = str(tmp_path / "p")
    audit = lambda path: quick.read.parquet(path).select(F.lit("negative").alias("check"), (F.col("id") < 0).cast("long").alias("violations")).groupBy("check").agg(F.sum("violations").alias("violations"))
    with pytest.raises(LookupError):
        publishing.current_path(quick, target)
    publishing.publish_checked(quick, target, quick.range(3).write.parquet, audit)
    before = publishing.current_path(quick, target)
    with pytest.raises(publishing.PublishRefused, match="negative: 2") as refused:
        publishing.publish_checked(quick, target, quick.range(-2, 3).write.parquet, audit)
    assert refused.value.violated == {"negative": 2}
    assert publishing.current_path(quick, target) == before
    publishing.publish_checked(quick, target, quick.range(4).write.parquet, audit)
    assert quick.read.parquet(publishing.current_path(quick, target)).count() == 4


def test_gold_and_serving_are_refused_on_a_violation(quick, w, tmp_path):
    class Few(Warehouse):
        pass

    few = Few(quick, w.feeds)
    w.gold()
    day = F.col("posted_date") == F.lit(dt.date(1998, 5, 2))
    rows = w.fact_by_month.where(day).withColumn("fx_rate_to_gbp", F.lit(None).cast("double"))
    few.__dict__.update(w.__dict__ | {"fact_by_month": rows, "fact": rows.drop("posted_month")})
    for publish in (serving.export_gold, serving.publish):
        with pytest.raises(publishing.PublishRefused, match="fact without fx rate"):
            publish(few, str(tmp_path / publish.__name__))
        with pytest.raises(LookupError):
            publishing.current_path(quick, str(tmp_path / publish.__name__))
    with pytest.raises(LookupError):
        GoldMarts(quick, str(tmp_path / "export_gold"))


# ------------------------------------------------------------------ files


def test_a_second_landing_opens_the_new_files_only(quick, tmp_path):
    raw, target = deliver(quick, tmp_path / "raw"), str(tmp_path / "lake")
    base = f"{raw}/card_transactions"
    opened = []

    def look(path):
        opened.append(path)
        return readers.writer_version(quick, path, "parquet")

    index = FileIndex(quick, f"{target}/_files")
    first = index.changes(base, look)
    assert len(opened) == first.opened == 2 and len(first.days) == 2
    first.commit()
    again = index.changes(base, look)
    assert len(opened) == 2 and again.days == [] and again.opened == 0
    again.commit()
    assert len(index.table.versions()) == 1
    new = quick.createDataFrame([transaction(9, "2026-06-03")], RAW_TRANSACTIONS)
    sinks.write_feed(new.coalesce(1), f"{base}/posted_date=2026-06-03", "parquet")
    third = index.changes(base, look)
    assert len(opened) == 3 and third.days == [dt.date(2026, 6, 3)]
    third.commit()
    # a file that vanishes from a delivered day has the day landed again, without opening anything
    (gone,) = (raw / "card_transactions/posted_date=2026-06-02").glob("*.parquet")
    sinks.write_feed(new.coalesce(1), f"{base}/posted_date=2026-06-02", "parquet")
    fourth = index.changes(base, look)
    assert not gone.exists() and fourth.days == [dt.date(2026, 6, 2)] and len(opened) == 4


def test_landing_again_lands_the_changed_days_only(quick, tmp_path):
    raw, target = deliver(quick, tmp_path / "raw"), tmp_path / "lake"
    lake.land(quick, str(raw), str(target), fmt="parquet")
    files = {p: p.stat().st_mtime_ns for p in (target / "card_transactions").rglob("*.parquet")}
    new = quick.createDataFrame([transaction(9, "2026-06-03")], RAW_TRANSACTIONS)
    sinks.write_feed(new.coalesce(1), str(raw / "card_transactions/posted_date=2026-06-03"), "parquet")
    told = {r["feed"]: r for r in lake.land(quick, str(raw), str(target), fmt="parquet").collect()}
    assert (told["card_transactions"]["rows"], told["card_transactions"]["partitions"]) == (6, 3)
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in files.items())


def test_figures_come_from_footers(quick, tmp_path):
    df = quick.range(1000).withColumn("day", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    df.hint("rebalance", "day").write.partitionBy("day").parquet(str(tmp_path / "t"))
    size = sum(p.stat().st_size for p in (tmp_path / "t").rglob("*.parquet"))
    told = figures.table_figures(quick, str(tmp_path / "t"), "day").first()
    assert (told["rows"], told["bytes"], told["partitions"]) == (1000, size, 3)
    per_day = figures.partition_figures(quick, str(tmp_path / "t"), "day").collect()
    assert sum(r["rows"] for r in per_day) == 1000 and sum(r["bytes"] for r in per_day) == size
    assert "ReadSchema: struct<>" in plan_text(figures.file_figures(quick, str(tmp_path / "t")))


# ------------------------------------------------------------------ arrivals and quarantine


def test_what_did_not_come_is_a_row(quick, tmp_path):
    register = contracts.load_contracts()
    assert {r["feed"]: r["weekday"] for r in calendar(quick, register).collect()}["merchants"] == 1
    ledger = ArrivalLedger(quick, str(tmp_path / "a"))
    run = lambda *rows: quick.createDataFrame(rows, "feed string, rows long, bytes long")
    monday = dt.date(2026, 6, 1)
    ledger.record(monday, run(("cards", 5, 10), ("merchants", 7, 10)))
    ledger.record(monday + dt.timedelta(days=7), run(("cards", 6, 10)))
    ledger.record(monday + dt.timedelta(days=7), run(("cards", 8, 10)))  # told anew
    report = {r["feed"]: r for r in ledger.report(register, monday + dt.timedelta(days=7)).collect()}
    assert len(report) == 6
    assert (report["cards"]["row_count"], report["cards"]["change"], report["cards"]["status"]) == (8, 3, "arrived")
    assert (report["merchants"]["previous_count"], report["merchants"]["status"]) == (7, "absent")
    later = {r["feed"]: r["status"] for r in ledger.report(register, monday + dt.timedelta(days=8)).collect()}
    assert later["merchants"] == "not due" and later["cards"] == "absent"


def test_rows_that_break_a_rule_land_and_are_tagged(quick, tmp_path):
    raw, target = deliver(quick, tmp_path / "raw"), str(tmp_path / "lake")
    cards = raw / "cards/cards.csv"
    cards.write_text(cards.read_text().replace("visa", "amex", 1))
    bad = quick.createDataFrame([transaction(9, "2026-06-03", channel="pigeon", currency=None)], RAW_TRANSACTIONS)
    sinks.write_feed(bad.coalesce(1), str(raw / "card_transactions/posted_date=2026-06-03"), "parquet")
    feeds_landed = [r["feed"] for r in lake.land(quick, str(raw), target, fmt="parquet").select("feed").collect()]
    assert len(feeds_landed) == 6 and feeds.scan_lake(quick, target, "cards").count() == 2
    found = {(r["feed"], r["check"]): r["violations"] for r in lake.quarantined(quick, target, feeds_landed).collect()}
    assert found[("cards", "network enum")] == 1 and found[("cards", "account_id required")] == 1
    assert found[("card_transactions", "channel enum")] == 1 and found[("card_transactions", "currency required")] == 1
    tagged = quick.read.parquet(f"{target}/_quarantine/card_transactions").first()
    assert tagged["record_key"] == "TXN-9" and sorted(tagged["broken"]) == ["channel enum", "currency required"]


def test_documents_are_parsed_once_for_all_rules(quick, tmp_path):
    rows = quick.createDataFrame([('{"customer_id":"CUS-000000001"}',), ("broken",), (None,)], "document string")
    rows.write.parquet(str(tmp_path / "customers"))
    rules, key = contracts.feed_rules(contracts.BUNDLED, "customers")
    broken = contracts.broken_rows(lake._in_contract_shape(quick, str(tmp_path), "customers"), rules, key)
    assert plan_text(broken).count("from_json(") == 1
    found = sorted((r["record_key"], "customer_id required" in r["broken"]) for r in broken.collect())
    assert found == [("", True), ("", True), ("CUS-000000001", False)]


def test_newest_days_are_made_once(w):
    daily = driver_delivery.DailyDeliveries(w.spark, w.feeds)
    newest = w.feeds.transactions.agg(F.max("posted_date")).first()[0]
    days = F.datediff(F.lit(newest), "posted_date") < driver_delivery.DAYS
    expected = w.feeds.transactions.where(days).count()
    rates = w.feeds.fx_rates
    rows, last = daily.newest_rows(rates)
    assert last == newest and rows.where(days).count() == expected and "Join" not in plan_text(rows)
    # Rates that go on long after the newest day: the written rows do not hold all of the newest days.
    for ahead in (driver_delivery.DAYS + 40, 10 * driver_delivery.DAYS):
        rows, last = daily.newest_rows(rates.withColumn("rate_date", F.date_add("rate_date", ahead)))
        assert last == newest and rows.where(days).count() == expected


def test_flat_feeds_are_landed_without_a_shuffle(quick, tmp_path, monkeypatch):
    plans, write = [], sinks.counted_write
    monkeypatch.setattr(lake, "counted_write", lambda df, path, *a, **k: plans.append((path, k)) or write(df, path, *a, **k))
    lake.land(quick, str(deliver(quick, tmp_path / "raw")), str(tmp_path / "lake"), fmt="parquet")
    flat = [k for path, k in plans if not path.endswith("card_transactions")]
    assert len(flat) == 5 and all(k == {"arranged": True} for k in flat)


# ------------------------------------------------------------------ checks and windows


def test_declared_checks_count_in_one_pass(quick, w):
    child = quick.createDataFrame([("a", 1), ("a", 2), (None, 3), ("z", 9)], "k string, v int")
    parent = quick.createDataFrame([("a",), ("b",)], "p string")
    found = declared.run(
        {"t": child, "u": parent},
        [
            declared.NotNull("t", "k"), declared.NotNull("t", "v"), declared.Unique("t", "k"), declared.Unique("u", "p"),
            declared.Accepted("t", "v", (1, 2, 3)), declared.Relationship("t", "k", "u", "p"),
        ],
    )
    assert dict(map(tuple, found.collect())) == {
        "t.k not null": 1, "t.v not null": 0, "t.k unique": 1, "u.p unique": 0, "t.v accepted values": 1, "t.k": 1,
    }
    w.gold()
    plan = monitors.declared_checks(w)._jdf.queryExecution().optimizedPlan().toString()
    # The fact is the only table with this column; it is scanned once for all its checks.
    assert sum("Relation" in line and "fx_rate_carried_forward" in line for line in plan.splitlines()) <= 1


def test_daily_actives_end_at_the_trailing_answer(w):
    one = metrics.active_customers(w).first()["active_customers"]
    days = metrics.active_customers_daily(w)
    last = w.fact.agg(F.max("posted_date")).first()[0]
    found = days.where(F.col("posted_date") == F.lit(last)).collect()
    assert (found[0]["active_customers"] if found else 0) == one
    assert days.agg(F.max("active_customers")).first()[0] >= one


def test_a_customer_lookup_reads_few_files(spark, w, monkeypatch):
    from ledgerloom.plans import patterns

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep the tiny ranges apart
    try:
        copy = w._keep_clustered("fact_by_customer_test", w.fact, "customer_id", "posted_date", "transaction_id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    p = patterns.pick_parameters(w)
    spread = copy.select(F.col("_metadata.file_path").alias("f"), "customer_id").groupBy("f").agg(
        F.min("customer_id").alias("low"), F.max("customer_id").alias("high")
    )
    holding = spread.where((F.col("low") <= p.customer_id) & (F.col("high") >= p.customer_id)).count()
    assert holding <= 2 < spread.count()
    assert "PushedFilters: [IsNotNull(customer_id), IsNotNull(posted_date), EqualTo(customer_id" in plan_text(
        copy.where((F.col("customer_id") == p.customer_id) & (F.col("posted_date") >= F.lit(p.from_date)))
    )
    monkeypatch.setitem(w.__dict__, "fact_by_customer", copy)
    assert patterns.customer_12m_clustered(w, p).collect() == patterns.customer_12m_from_fact(w, p).collect()
