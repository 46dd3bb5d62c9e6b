from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import asof, reshape, scd2
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.percentile import grouped_percentile, picked, rank_counts, value_counts

D = dt.date.fromisoformat
ORDER = [("at", "desc"), ("version", "desc"), ("amount", "asc")]


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ------------------------------------------------------------------ dedupe


def copies(spark, data):
    return spark.createDataFrame(data, "id string, at timestamp_ntz, version tinyint, amount bigint, note string")


def test_dedupe_keeps_the_latest_and_flags_it(spark):
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    df = copies(spark, [
        ("a", t1, 1, 5, "old"), ("a", t2, 1, 5, "new"),
        ("b", t1, 1, 7, "once"),
        ("c", t1, 1, 9, "same"), ("c", t1, 1, 9, "same"),
        ("d", t1, 1, 9, "v1"), ("d", t1, 2, 9, "v2"),
        ("e", t1, 1, 8, "dear"), ("e", t1, 1, 3, "cheap"),
        ("f", None, 1, 1, "no time"), ("f", t1, 1, 1, "time"),
    ])
    out = {r["id"]: (r["note"], r["was_duplicated"]) for r in dedupe_latest(df, ["id"], ORDER).collect()}
    assert out == {
        "a": ("new", True), "b": ("once", False), "c": ("same", True), "d": ("v2", True), "e": ("cheap", True),
        "f": ("time", True),
    }


def test_dedupe_settles_ties_without_regard_to_partitioning(spark):
    t = dt.datetime(2026, 1, 1)
    df = copies(spark, [("a", t, 1, 5, note) for note in "zyxw"])
    for n in (1, 2, 4):
        assert dedupe_latest(df.repartition(n), ["id"], ORDER).first()["note"] == "w"


def test_dedupe_collapses_a_hot_key_before_the_shuffle(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("v")
    )
    out = dedupe_latest(df, ["key"], [("v", "desc")])
    assert out.where("key = 'hot'").first().asDict() == {"key": "hot", "v": 59_997, "was_duplicated": True}
    assert out.count() == 40_001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_dedupe_refuses_descending_text(spark):
    with pytest.raises(ValueError, match="note"):
        dedupe_latest(copies(spark, []), ["id"], [("note", "desc")])


# ------------------------------------------------------------------ percentile


def linear(values, q):
    values = sorted(values)
    pos = (len(values) - 1) * q
    low = math.floor(pos)
    return values[low] + (values[math.ceil(pos)] - values[low]) * (pos - low)


def nearest(values, q):
    values = sorted(values)
    return values[min(len(values) - 1, round(q * (len(values) - 1)))]


@pytest.mark.parametrize(("method", "expected"), [("linear", linear), ("nearest", nearest)])
def test_percentile_matches_brute_force(spark, method, expected):
    rng = random.Random(5)
    groups = {
        "one": [7],
        "two": [1, 2],
        "repeats": [3] * 50 + [4] * 50,
        "negative": [rng.randint(-10**6, 10**6) for _ in range(301)],
        "wide": [int(10 ** rng.uniform(0, 15)) for _ in range(400)],
        "small": [rng.randint(-3, 20) for _ in range(200)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v bigint")
    for q in (0.0, 0.25, 0.5, 0.95, 1.0):
        out = dict(rows(grouped_percentile(df, ["g"], "v", q, "p", method=method)))
        assert out.keys() == groups.keys()
        for g, values in groups.items():
            assert out[g] == pytest.approx(expected(values, q), rel=1e-12), (g, q)
        ranked = rank_counts(value_counts(df, ["g"], "v"), ["g"], q, method)
        assert dict(rows(ranked.groupBy("g").agg(picked()))) == out


def test_percentile_of_fractions_and_decimals(spark):
    rng = random.Random(6)
    values = [round(rng.uniform(-5, 5), rng.randint(0, 6)) for _ in range(200)] + [1.5, 2.5, 3.5, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = df.select(F.expr("percentile(v, 0.5)")).first()[0]
    assert grouped_percentile(df, [], "v", 0.5, "p").first()[0] == pytest.approx(exact)
    cents = spark.createDataFrame([("1.50",), ("2.25",), ("3.75",), ("4.00",)], "v string").select(F.col("v").cast("decimal(9,2)"))
    assert grouped_percentile(cents, [], "v", 0.5, "p").first()[0] == pytest.approx(3.0)


def test_null_values_are_ranked_nowhere(spark):
    counts = spark.createDataFrame([("g", 1, 1), ("g", None, 50), ("g", 3, 1), ("none", None, 2)], "g string, value bigint, n bigint")
    out = dict(rows(rank_counts(counts, ["g"], 0.5).groupBy("g").agg(picked())))
    assert out == {"g": 2.0, "none": None}


def test_percentile_of_nothing_and_of_everything(spark):
    empty = spark.createDataFrame([], "g string, v bigint")
    assert grouped_percentile(empty, ["g"], "v", 0.5, "p").count() == 0
    df = spark.range(1001).withColumnRenamed("id", "v")
    assert rows(grouped_percentile(df, [], "v", 0.5, "p")) == [(500.0,)]


# ------------------------------------------------------------------ as-of


RATES = [
    (D("2026-01-02"), "EUR", 0.8), (D("2026-01-05"), "EUR", 0.9), (D("2026-01-01"), "GBP", 1.0),
    (D("2026-01-03"), "USD", 0.7),
]


def rates(spark):
    return spark.createDataFrame(RATES, "day date, ccy string, rate double")


def bounds(spark, first, last):
    df = spark.createDataFrame([(D(first),), (D(last),)], "d date")
    return asof.date_bounds(df, "d")


def test_dense_daily_fills_gaps_and_leaves_a_leading_gap(spark):
    out = asof.dense_daily(rates(spark), bounds(spark, "2026-01-01", "2026-01-06"), "ccy", "day", "rate")
    eur = [(r["rate"], r["is_carried_forward"]) for r in out.where("ccy = 'EUR'").orderBy("day").collect()]
    assert eur == [(None, True), (0.8, False), (0.8, True), (0.8, True), (0.9, False), (0.9, True)]
    assert {r["rate"] for r in out.where("ccy = 'GBP'").collect()} == {1.0}
    assert out.count() == 18


def test_dense_daily_does_not_look_before_the_span_unless_seeded(spark):
    span = bounds(spark, "2026-01-03", "2026-01-04")
    plain = asof.dense_daily(rates(spark), span, "ccy", "day", "rate")
    seeded = asof.dense_daily(rates(spark), span, "ccy", "day", "rate", seed_before=True)
    assert [r["rate"] for r in plain.where("ccy = 'EUR'").orderBy("day").collect()] == [None, None]
    assert [r["rate"] for r in seeded.where("ccy = 'EUR'").orderBy("day").collect()] == [0.8, 0.8]
    assert seeded.count() == 6


def test_asof_join_matches_brute_force(spark):
    asked = [(i, c, D("2025-12-30") + dt.timedelta(days=n)) for i, (c, n) in enumerate(
        (c, n) for c in ("EUR", "GBP", "USD", "XXX") for n in range(14))]
    asked.append((99, "EUR", None))
    left = spark.createDataFrame(asked, "id int, ccy string, on date")
    out = {r["id"]: r["got"] for r in asof.asof_join(left, rates(spark), "ccy", "on", "day", "rate", "got").collect()}
    for i, c, on in asked:
        known = [(d, r) for d, cc, r in RATES if on is not None and cc == c and d <= on]
        assert out[i] == (max(known)[1] if known else None), (c, on)
    assert len(out) == len(asked)


# ------------------------------------------------------------------ SCD2


T1, T2, T3 = "2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"
AT = {t: dt.datetime.fromisoformat(t) for t in (T1, T2, T3)}


def people(spark, *data):
    return spark.createDataFrame(list(data), "id string, tier string, phone string")


def test_scd2_merge_covers_every_transition(spark):
    first = people(spark, ("same", "a", "1"), ("moved", "a", "1"), ("phone", "a", "1"), ("gone", "a", "1"), ("null", None, "1"))
    second = people(spark, ("same", "a", "1"), ("moved", "b", "1"), ("phone", "a", "2"), ("new", "a", "1"), ("null", None, "1"))
    third = people(spark, ("same", "a", "1"), ("moved", "b", "1"), ("phone", "a", "2"), ("new", "a", "1"), ("gone", "c", "1"))
    history = scd2.scd2_start(first, F.lit(T1))
    for source, at in ((second, T2), (third, T3)):
        history = scd2.scd2_merge(history, source, "id", ["tier"], F.lit(at))
    got = rows(history.select("id", "tier", "phone", "valid_from", "valid_to"), "id", "valid_from")
    a1, a2, a3 = AT[T1], AT[T2], AT[T3]
    assert got == [
        ("gone", "a", "1", a1, a2), ("gone", "c", "1", a3, None),
        ("moved", "a", "1", a1, a2), ("moved", "b", "1", a2, None),
        ("new", "a", "1", a2, None),
        ("null", None, "1", a1, a3),
        ("phone", "a", "1", a1, None),
        ("same", "a", "1", a1, None),
    ]


def versions(spark, data, key):
    return spark.createDataFrame(data, f"{key}_key string, {key} string, {'link' if key == 'acc' else 'x'} string, "
                                       "valid_from timestamp_ntz, valid_to timestamp_ntz")


def test_versions_backdate_only_the_first(spark):
    history = scd2.scd2_merge(
        scd2.scd2_start(people(spark, ("p", "a", "1")), F.lit(T1)), people(spark, ("p", "b", "1")), "id", ["tier"], F.lit(T2)
    )
    out = scd2.scd2_versions(history, "id", "key", F.lit("2020-05-05").cast("date"))
    got = rows(out.select("valid_from", "valid_to", "is_current", "version_number"), "version_number")
    assert got == [
        (dt.datetime(2020, 5, 5), AT[T2], False, 1),
        (AT[T2], dt.datetime(9999, 12, 31), True, 2),
    ]
    assert out.select("key").distinct().count() == 2


def test_lookup_is_closed_at_the_start_and_open_at_the_end(spark):
    dim = spark.createDataFrame([("p", "v1", AT[T1], AT[T2]), ("p", "v2", AT[T2], AT[T3])],
                                "id string, key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    left = spark.createDataFrame([(AT[T1],), (AT[T2],), (AT[T3],), (dt.datetime(2025, 1, 1),)], "at timestamp_ntz")
    left = left.withColumn("who", F.lit("p"))
    out = dict(rows(scd2.scd2_join(left, dim, "who", "id", "at").select("at", "key")))
    assert out == {AT[T1]: "v1", AT[T2]: "v2", AT[T3]: None, dt.datetime(2025, 1, 1): None}


def test_chain_equals_two_lookups(spark):
    rng = random.Random(3)
    day = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(days=n)

    def spans(prefix, n, link):
        out = []
        for i in range(n):
            start, k = rng.randint(0, 40), 0
            for _ in range(rng.randint(0, 3)):
                end = start + rng.randint(1, 30)
                out.append((f"{prefix}{i}v{k}", f"{prefix}{i}", link(i), day(start), day(end)))
                start, k = end + rng.choice([0, 0, 5]), k + 1
        return out

    shape = "string, {} string, {} string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    accounts = spark.createDataFrame(spans("a", 30, lambda i: f"c{i % 12}"), "account_key " + shape.format("account_id", "customer_id"))
    customers = spark.createDataFrame(spans("c", 10, lambda i: "x"), "customer_key " + shape.format("customer_id", "other"))
    asked = spark.createDataFrame([(f"a{rng.randint(0, 30)}", day(rng.randint(-5, 130))) for _ in range(500)],
                                  "acc string, at timestamp_ntz")
    once = scd2.scd2_join(asked, accounts, "acc", "account_id", "at")
    twice = scd2.scd2_join(once, customers.drop("other"), "customer_id", "customer_id", "at")
    expected = [r["customer_key"] for r in twice.select("acc", "at", "account_key", "customer_key").orderBy("acc", "at").collect()]

    timeline = scd2.scd2_chain(accounts, customers, "account_key", "customer_id", "customer_key")
    got = scd2.scd2_join(asked, timeline, "acc", "account_id", "at").orderBy("acc", "at").collect()
    assert [r["customer_key"] for r in got] == expected
    assert any(expected) and not all(expected)


def test_overlaps_are_found(spark):
    dim = spark.createDataFrame(
        [("p", AT[T1], AT[T3]), ("p", AT[T2], AT[T3]), ("q", AT[T1], AT[T2]), ("q", AT[T2], AT[T3])],
        "id string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    assert rows(scd2.scd2_overlaps(dim, "id")) == [("p", 1)]


# ------------------------------------------------------------------ reshape


@pytest.mark.parametrize(("labels", "expected"), [(3, 3), (8, 8), (12, 9)])
def test_top_n_other(spark, labels, expected):
    df = spark.createDataFrame([(f"c{i:02}", float(i)) for i in range(labels)], "label string, v double")
    out = dict(rows(reshape.top_n_other(df, "label", "v", 8)))
    assert len(out) == expected
    assert sum(out.values()) == sum(range(labels))
    assert ("Other" in out) == (labels > 8)


def test_top_per_group_breaks_ties_by_the_given_order(spark):
    df = spark.createDataFrame([("s", n, 5) for n in "dcba"] + [("t", "z", 1)], "g string, n string, v int")
    out = reshape.top_per_group(df, "g", [F.col("v").desc(), F.col("n")], 2, "rank")
    assert rows(out.select("g", "n", "rank"), "g", "rank") == [("s", "a", 1), ("s", "b", 2), ("t", "z", 1)]


def test_junk_dimension_and_unknown(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", "x")], "p string, q string")
    dim = reshape.junk_dimension(df, ["p", "q"], "k")
    assert rows(dim, "k") == [(1, "a", "y"), (2, "b", "x")]
    full = reshape.with_unknown(dim, {"k": -1, "p": "unknown", "q": None})
    assert rows(full, "k")[0] == (-1, "unknown", None)


def test_count_flags_counts_null_as_checked_only(spark):
    df = spark.createDataFrame([(1, True, None), (1, False, True), (2, True, True)], "d int, a boolean, b boolean")
    out = rows(reshape.count_flags(df, "d", {"A": "a", "B": "b"}), "d", "defect_code")
    assert out == [(1, 2, "A", 1), (1, 2, "B", 1), (2, 1, "A", 1), (2, 1, "B", 1)]


def test_presence_keeps_all_rows(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    known = spark.createDataFrame([("a",), ("c",)], "kk string")
    out = reshape.presence_flag(left, "k", known, "kk", "missing")
    assert sorted((r["k"] or "", r["missing"]) for r in out.collect()) == [("", True), ("a", False), ("a", False), ("b", True)]
