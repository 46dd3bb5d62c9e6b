"""The test tables reshaped as the five feeds, so that every plan runs on given data.

Ids and defects are arithmetic on the table keys; nothing is drawn at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import ntz
from ledgerloom.functions.text import padded_id
from ledgerloom.operators.asof import daily
from ledgerloom.sources.feeds import GROUP, Feeds, Snapshot

FIRST_SNAPSHOT = "1995-06-01 00:00:00"
SECOND_SNAPSHOT = "1998-07-01 00:00:00"
THIRD_SNAPSHOT = "1998-12-01 00:00:00"
VERSION_2_FROM = "1999-01-01"

MCC_BY_TYPE = {
    "MEDIUM": (5411, "groceries"),
    "STANDARD": (5812, "eating_out"),
    "LARGE": (5732, "electronics"),
    "PROMO": (4816, "digital_services"),
    "SMALL": (5912, "pharmacy"),
    "ECONOMY": (7011, "hotels"),
}
# channel and its point-of-service entry mode
CHANNEL_BY_PRIORITY = {
    "1-URGENT": ("chip_and_pin", "05"),
    "2-HIGH": ("contactless", "07"),
    "3-MEDIUM": ("ecommerce", "81"),
    "4-NOT SPECIFIED": ("atm", "05"),
    "5-LOW": ("mail_order", "01"),
}
# millionths of a pound per unit
RATE_BASES = {"GBP": 1_000_000, "EUR": 855_000, "USD": 790_000, "SEK": 73_000, "AED": 215_000, "JPY": 5_200}
SEGMENTS = {"MACHINERY": "affluent", "AUTOMOBILE": "premier", "FURNITURE": "student"}


def _pick(column: str, mapping: dict[str, object], otherwise: object = None) -> Column:
    items = list(mapping.items())
    out = F.when(F.col(column) == items[0][0], F.lit(items[0][1]))
    for value, result in items[1:]:
        out = out.when(F.col(column) == value, F.lit(result))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def _row_number_key() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _posted_date() -> Column:
    k = F.col("k")
    lag = F.when(k % 167 == 0, 3 + k % 18).otherwise(k % 3)
    return F.date_add(F.to_date("l_shipdate"), lag.cast("int"))


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core when the input is one small file of one row group.

    A scan with at least as many splits as cores, which any large input has, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def transactions(spark: SparkSession, sf_dir: str, grouped: bool = False) -> DataFrame:
    """Card transactions as staged input: lineitem with its order and part.

    `grouped` adds `GROUP`, the order, which every copy of a transaction shares. The lines are then distributed
    by it last and while they are narrow, so that copies can be found where they lie.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", (F.col("l_suppkey") % 10).alias("supplier"), "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("minor"), "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type")
    k = F.col("k")
    lines = lines if grouped else _spread(lines, "l_orderkey", "l_linenumber")
    of_part = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    of_part = of_part.repartition("l_orderkey") if grouped else of_part
    joined = of_part.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("k", _row_number_key())
    supplier = F.col("supplier")
    kind = (
        F.when(F.col("l_returnflag") == "R", "refund")
        .when((F.col("l_returnflag") == "N") & (supplier == 0), "atm_withdrawal")
        .when((F.col("l_returnflag") == "N") & (supplier == 1), "fee")
        .otherwise("purchase")
    )
    typed = joined.withColumns({"txn_type": kind, "posted_date": _posted_date()})
    purchase = F.col("txn_type") == "purchase"
    negative = (F.col("txn_type") == "refund") | (purchase & (k % 997 == 0))
    share = F.col("o_custkey") % 100
    status_p = F.when(k % 4 == 0, "declined").when(k % 4 == 1, "reversed").otherwise("settled")
    version = F.when(F.col("posted_date") < F.lit(VERSION_2_FROM).cast("date"), 1).otherwise(2).cast("tinyint")
    typed = typed.withColumns(
        {
            "feed_version": version,
            "mcc": F.when(k % 1249 == 0, 99999).otherwise(_pick("p_type", {t: m for t, (m, _) in MCC_BY_TYPE.items()})),
        }
    )
    newer = F.col("feed_version") == 2
    return typed.select(
        F.concat(padded_id("TXN-", F.col("l_orderkey"), 10), F.lit("-"), F.col("l_linenumber")).alias("transaction_id"),
        F.when(k % 499 == 0, "CRD-ORPHAN").otherwise(F.concat(F.lit("CRD-"), F.col("o_custkey"))).alias("card_id"),
        F.concat(F.lit("ACC-"), F.col("o_custkey")).alias("account_id"),
        F.when(F.col("txn_type").isin("atm_withdrawal", "fee") | (purchase & (k % 251 == 0)), None)
        .otherwise(F.concat(F.lit("MER-"), F.col("l_partkey")))
        .alias("merchant_id"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_partkey") % 24)).alias("txn_timestamp"),
        "posted_date",
        (
            F.col("minor")
            * F.when(negative, -1).otherwise(1)
            * F.when(k % 1999 == 0, 100).otherwise(1)
        ).alias("amount_minor"),
        F.when(share < 70, "GBP").when(share < 82, "EUR").when(share < 92, "USD").when(share < 95, "SEK")
        .when(share < 98, "AED").otherwise("JPY").alias("currency"),
        "mcc",
        F.when(F.col("txn_type") == "fee", None)
        .otherwise(padded_id("A", k % 100000, 5)).alias("auth_code"),
        "txn_type",
        _pick("o_orderpriority", {p: c for p, (c, _) in CHANNEL_BY_PRIORITY.items()}).alias("channel"),
        F.when(F.col("o_orderstatus") == "F", "settled")
        .when(F.col("o_orderstatus") == "P", status_p)
        .when(F.col("l_linestatus") == "F", "settled")
        .otherwise("authorised")
        .alias("status"),
        F.when(newer, _pick("o_orderpriority", {p: m for p, (_, m) in CHANNEL_BY_PRIORITY.items()}))
        .alias("pos_entry_mode"),
        F.when(newer, (F.col("mcc") == 4816) & (k % 5 < 3)).alias("is_recurring"),
        "feed_version",
        *([F.col("l_orderkey").alias(GROUP)] if grouped else []),
    )


def _line_key(transaction_id: Column) -> Column:
    """`k` recovered from an id TXN-<10 digits>-<line>."""
    order, line = F.substring(transaction_id, 5, 10), F.substring_index(transaction_id, "-", -1)
    return order.cast("bigint") * 8 + line.cast("bigint")


def defect_ledger(deduped: DataFrame) -> DataFrame:
    """The planted defects, per surviving transaction."""
    k, purchase = _line_key(F.col("transaction_id")), F.col("txn_type") == "purchase"
    planted = {
        "D01": purchase & (k % 251 == 0),
        "D03": k % 499 == 0,
        "D04": purchase & (k % 997 == 0),
        "D05": k % 1249 == 0,
        "D06": k % 167 == 0,
        "D07": k % 1999 == 0,
    }
    codes = F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in planted.items()]))
    return deduped.select("transaction_id", F.explode(codes).alias("defect_code"))


def general_ledger(deduped: DataFrame) -> DataFrame:
    """Independent daily totals: settled amounts as the ledger holds them, without unit slips."""
    slipped = _line_key(F.col("transaction_id")) % 1999 == 0
    amount = F.when(slipped, F.call_function("div", F.col("amount_minor"), F.lit(100))).otherwise(F.col("amount_minor"))
    return (
        deduped.where(F.col("status") == "settled")
        .groupBy("posted_date")
        .agg(F.sum(amount).alias("total_minor"))
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.concat(F.lit("MER-"), F.col("p_partkey")).alias("merchant_id"),
        F.col("p_name").alias("merchant_name"),
        _pick("p_type", {t: m for t, (m, _) in MCC_BY_TYPE.items()}).alias("mcc"),
        _pick("p_type", {t: c for t, (_, c) in MCC_BY_TYPE.items()}).alias("category"),
        F.when(F.col("p_size") % 8 == 0, "FR").otherwise("GB").alias("country"),
        (F.col("p_partkey") % 3 == 0).alias("is_online"),
        F.lit("1994-01-01").cast("date").alias("first_seen_on"),
    )


def _iso(ts: Column) -> Column:
    return F.concat(F.regexp_replace(ts.cast("string"), " ", "T"), F.lit("Z"))


def customers(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """Staged customers as the onboarding feed showed them at one snapshot.

    Some join after the first, some are missing from the second and return; the third has all.
    """
    c = F.col("c_custkey")
    people = _spread(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_custkey").where({1: c % 89 != 1, 2: c % 97 != 5}.get(snapshot, F.lit(True)))
    segment = _pick("c_mktsegment", SEGMENTS, "mass")
    if snapshot >= 2:
        segment = F.when(c % 10 == 3, "premier").otherwise(segment)
    joined_at = ntz("1995-01-01 00:00:00") + F.make_dt_interval(days=c % 300)
    base = people.select(
        padded_id("CUS-", c, 9).alias("customer_id"),
        joined_at.alias("onboarded_at"),
        F.to_date(joined_at).alias("onboarded_on"),
        segment.alias("segment"),
        (c % 2 == 0).alias("marketing_consent"),
        F.lit("Customer").alias("first_name"),
        F.lpad(c.cast("string"), 9, "0").alias("last_name"),
        F.date_add(F.lit("1960-01-01").cast("date"), (c % 10000).cast("int")).alias("date_of_birth"),
        F.concat(F.lit("customer"), c, F.lit("@example.com")).alias("email"),
        F.when(c % 4 != 0, padded_id("07", c, 9)).alias("phone"),
        F.concat(c, F.lit(" High Street")).alias("address_line1"),
        F.concat(F.lit("City "), F.col("c_nationkey")).alias("city"),
        F.when(c % 111 == 3, "ab12cd").otherwise(F.concat(F.lit("AB"), c % 10, F.lit(" 2CD"))).alias("postcode"),
        F.lit("GB").alias("country"),
        F.when(c % 50 == 7, "pending").otherwise("verified").alias("kyc_status"),
        F.when((c % 50 != 7) & (c % 167 != 9), joined_at + F.make_dt_interval(days=F.lit(1))).alias("kyc_verified_at"),
        F.when(c % 33 == 0, "high").otherwise("low").alias("kyc_risk_band"),
    )
    nested = F.struct(
        "customer_id",
        _iso(F.col("onboarded_at")).alias("created_at"),
        "segment",
        "marketing_consent",
        F.struct(
            "first_name", "last_name", F.col("date_of_birth").cast("string").alias("date_of_birth"), "email", "phone"
        ).alias("profile"),
        F.struct(F.col("address_line1").alias("line1"), "city", "postcode", "country").alias("address"),
        F.struct(
            F.col("kyc_status").alias("status"),
            _iso(F.col("kyc_verified_at")).alias("verified_at"),
            F.col("kyc_risk_band").alias("risk_band"),
        ).alias("kyc"),
    )
    return base.withColumn("document", F.to_json(nested, {"ignoreNullFields": "false"}))


def accounts(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """Staged accounts at one snapshot: products change, some vanish and return, some are closed."""
    c = F.col("c_custkey")
    product = F.when(c % 5 == 0, "SAVER").otherwise("CURRENT")
    if snapshot >= 2:
        product = F.when(c % 13 == 4, "PREMIER").otherwise(product)
    opened = F.date_add(F.lit("1995-01-01").cast("date"), (c % 300).cast("int"))
    shut = (c % 17 == 2) & F.lit(snapshot == 3)
    there = _spread(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_custkey").where(c % 101 != 7 if snapshot == 2 else F.lit(True))
    return there.select(
        F.concat(F.lit("ACC-"), c).alias("account_id"),
        padded_id("CUS-", c, 9).alias("customer_id"),
        product.alias("product_code"),
        F.when(c % 23 == 9, "EUR").otherwise("GBP").alias("currency"),
        F.when(shut, "closed").otherwise("open").alias("status"),
        opened.alias("opened_on"),
        F.when(shut, F.date_add(opened, 1200)).when(c % 61 == 0, F.date_add(opened, 1000)).alias("closed_on"),
        (c % 5 * 10000).alias("overdraft_limit_minor"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return _spread(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_custkey").select(
        F.concat(F.lit("CRD-"), c).alias("card_id"),
        F.concat(F.lit("ACC-"), c).alias("account_id"),
        F.when(c % 7 == 0, "credit").otherwise("debit").alias("card_type"),
        F.when(c % 2 == 0, "visa").otherwise("mastercard").alias("network"),
        F.lit("1995-01-01").cast("date").alias("issued_on"),
        F.lit("2005-01-01").cast("date").alias("expires_on"),
        F.lit("active").alias("status"),
    )


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rates: every day of the feed but each 29th."""
    posted = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_shipdate", _row_number_key().alias("k"))
    span = posted.select(_posted_date().alias("d")).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    days = span.select("first", daily(F.col("first"), F.col("last")).alias("rate_date"))
    offset = F.datediff("rate_date", "first")
    table = F.create_map(*[F.lit(x) for item in RATE_BASES.items() for x in item])
    micro = F.call_function("div", F.col("base") * (1000 + (F.col("off") * 7) % 11 - 5) + 500, F.lit(1000))
    micro = F.when(F.col("currency") == "GBP", F.lit(1_000_000)).otherwise(micro)
    return (
        days.select("rate_date", offset.alias("off"))
        .where((F.col("off") == 0) | (F.col("off") % 29 != 0))
        .select("rate_date", "off", F.explode(table).alias("currency", "base"))
        .select("rate_date", "currency", (micro / F.lit(1e6)).alias("rate_to_gbp"), F.lit("treasury").alias("source"))
    )


def load(spark: SparkSession, sf_dir: str) -> Feeds:
    taken = {1: FIRST_SNAPSHOT, 2: SECOND_SNAPSHOT, 3: THIRD_SNAPSHOT}
    return Feeds(
        transactions=transactions(spark, sf_dir),
        customers=tuple(Snapshot(at, customers(spark, sf_dir, n)) for n, at in taken.items()),
        accounts=tuple(Snapshot(at, accounts(spark, sf_dir, n)) for n, at in taken.items()),
        cards=cards(spark, sf_dir),
        merchants=merchants(spark, sf_dir),
        fx_rates=fx_rates(spark, sf_dir),
        grouped_transactions=transactions(spark, sf_dir, grouped=True),
    )
