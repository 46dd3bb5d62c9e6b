"""The star schema as functions of the staged feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates
from ledgerloom.functions.dates import BEGINNING, OPEN_END, home_date
from ledgerloom.functions.money import convert, sum_if
from ledgerloom.operators import asof, reshape, rules, scd2
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.sources.feeds import GROUP, Snapshot, with_auth_date
from ledgerloom.sources.state_history import WATCHED

UNKNOWN = "UNKNOWN"

# The total order that decides which copy of a transaction survives.
COPY_ORDER = (
    ("txn_timestamp", "desc"),
    ("feed_version", "desc"),
    ("amount_minor", "asc"),
    ("merchant_id", "asc"),
    ("posted_date", "asc"),
)
WATCHED_CUSTOMER = WATCHED["customers"][1]
WATCHED_ACCOUNT = WATCHED["accounts"][1]


def deduped(transactions: DataFrame) -> DataFrame:
    """One row per transaction id across all dates, copies flagged."""
    staged = with_auth_date(transactions)
    within = [GROUP] if GROUP in staged.columns else []
    return dedupe_latest(staged, ["transaction_id"], COPY_ORDER, within=within)


def fx_daily(fx_rates: DataFrame, transactions: DataFrame) -> DataFrame:
    bounds = asof.date_bounds(transactions, "posted_date")
    return asof.dense_daily(fx_rates, bounds, "currency", "rate_date", "rate_to_gbp")


def scored(transactions: DataFrame, cards: DataFrame, medians: DataFrame) -> DataFrame:
    return rules.apply_rules(transactions, cards, medians)


def history(snapshots: tuple[Snapshot, ...], key: str, watched: tuple[str, ...]) -> DataFrame:
    first, *later = snapshots
    out = scd2.scd2_start(first.rows, F.lit(first.taken_at))
    for snapshot in later:
        out = scd2.scd2_merge(out, snapshot.rows, key, watched, F.lit(snapshot.taken_at))
    return out


def dim_customer(customer_history: DataFrame) -> DataFrame:
    versions = scd2.scd2_versions(customer_history, "customer_id", "customer_key", F.col("onboarded_at"))
    chosen = versions.select(
        "customer_key", "customer_id", "segment", "kyc_status", "kyc_risk_band", "marketing_consent", "onboarded_on",
        "city", "country", "first_name", "last_name", "email", "valid_from", "valid_to", "is_current",
        "version_number",
    )
    member = dict.fromkeys(("customer_key", "customer_id"), UNKNOWN)
    member |= dict.fromkeys(
        ("segment", "kyc_status", "kyc_risk_band", "city", "country", "first_name", "last_name", "email"), "unknown"
    )
    member |= {"marketing_consent": False, "onboarded_on": BEGINNING[:10]}
    return reshape.with_unknown(chosen, member | _always())


def dim_account(account_history: DataFrame) -> DataFrame:
    versions = scd2.scd2_versions(account_history, "account_id", "account_key", F.col("opened_on"))
    chosen = versions.select(
        "account_key", "account_id", "customer_id", "product_code", "currency", "status", "opened_on", "closed_on",
        "overdraft_limit_minor", rules.open_with_closed_date().alias("dq_open_with_closed_date"), "valid_from",
        "valid_to", "is_current", "version_number",
    )
    member = dict.fromkeys(("account_key", "account_id", "customer_id"), UNKNOWN)
    member |= dict.fromkeys(("product_code", "currency", "status"), "unknown")
    member |= {"opened_on": BEGINNING[:10], "closed_on": None}
    member |= {"overdraft_limit_minor": 0, "dq_open_with_closed_date": False}
    return reshape.with_unknown(chosen, member | _always())


def _always() -> dict[str, object]:
    return {"valid_from": BEGINNING, "valid_to": OPEN_END, "is_current": True, "version_number": 1}


def dim_card(cards: DataFrame) -> DataFrame:
    chosen = cards.select(F.col("card_id").alias("card_key"), *cards.columns)
    member = dict.fromkeys(("card_key", "card_id", "account_id"), UNKNOWN)
    member |= dict.fromkeys(("card_type", "network", "status"), "unknown")
    return reshape.with_unknown(chosen, member | {"issued_on": BEGINNING[:10], "expires_on": OPEN_END[:10]})


def dim_merchant(merchants: DataFrame) -> DataFrame:
    """Vendor key and (still empty) acquirer key side by side."""
    chosen = merchants.select(
        F.col("merchant_id").alias("merchant_key"),
        F.col("merchant_id").alias("vendor_merchant_id"),
        F.lit(None).cast("string").alias("acquirer_merchant_id"),
        "merchant_name", "mcc", "category", "country", "is_online", "first_seen_on",
    )
    member = {"merchant_key": UNKNOWN, "vendor_merchant_id": UNKNOWN, "acquirer_merchant_id": None}
    member |= {"merchant_name": "No merchant", "mcc": 0, "category": "unknown", "country": "ZZ"}
    return reshape.with_unknown(chosen, member | {"is_online": False, "first_seen_on": BEGINNING[:10]})


def dim_currency(fx: DataFrame) -> DataFrame:
    code = F.col("currency")
    return fx.select("currency").distinct().select(
        code.alias("currency_key"), code.alias("currency_code"), (code == "GBP").alias("is_reporting_currency")
    )


def dim_date(transactions: DataFrame) -> DataFrame:
    """Whole calendar years around the posted dates, plus the 1 January that follows."""
    span = transactions.agg(
        F.trunc(F.min("posted_date"), "year").alias("first"),
        F.add_months(F.trunc(F.max("posted_date"), "year"), 12).alias("last"),
    )
    d = F.col("calendar_date")
    return span.select(asof.daily(F.col("first"), F.col("last")).alias("calendar_date")).select(
        dates.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("calendar_year"),
        F.month(d).alias("calendar_month"),
        dates.month_key(d).alias("calendar_month_key"),
        F.quarter(d).alias("calendar_quarter"),
        F.dayofmonth(d).alias("day_of_month"),
        dates.iso_weekday(d).alias("iso_day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("iso_week"),
        (dates.iso_weekday(d) >= 6).alias("is_weekend"),
        dates.uk_fiscal_year(d).alias("uk_fiscal_year"),
    )


def dim_txn_context(transactions: DataFrame) -> DataFrame:
    numbered = reshape.junk_dimension(transactions, ["txn_type", "channel", "status"], "txn_context_key")
    return numbered.withColumns(
        {
            "is_settled": F.col("status") == "settled",
            "is_card_not_present": F.col("channel").isin("ecommerce", "mail_order"),
            "counts_towards_spend": F.col("txn_type").isin("purchase", "atm_withdrawal"),
        }
    )


def customer_document(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "document")


def account_timeline(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Account versions cut where their customer's version changes (see `scd2_chain`)."""
    return scd2.scd2_chain(
        accounts.select("account_key", "account_id", "customer_id", "valid_from", "valid_to"),
        customers, "account_key", "customer_id", "customer_key",
    )


def fact(
    scored_rows: DataFrame, fx: DataFrame, timeline: DataFrame, context: DataFrame
) -> DataFrame:
    """One row per transaction, Type 2 keys and the GBP amount resolved at load.

    Every lookup is a left equi-join to a written table, so Catalyst sees its size: small ones
    are broadcast, larger ones shuffle and AQE splits hot keys.
    """
    owned = scd2.scd2_join(_priced(scored_rows, fx), timeline, "account_id", "account_id", "txn_timestamp")
    named = _in_context(owned, context)
    return _fact_columns(named.withColumn("card_key", F.when(~F.col("dq_orphan_card"), F.col("card_id"))))


def _owner() -> Column:
    """The account; for a row without one a name that no account has, so that its card is still looked up."""
    return F.coalesce("account_id", F.concat(F.lit("\u0000"), F.col("card_id")))


def account_lookup(transactions: DataFrame, cards: DataFrame, timeline: DataFrame) -> DataFrame:
    """`owner, pieces, cards`: the timeline of each account, and which of the cards used with it are known.

    One join on the account then answers what would take a second shuffle of the transactions, by card. A card
    is looked up for each distinct pair of account and card, whichever account it was issued to. The keys are
    md5 in hex and travel as half as many bytes. `cards` has distinct ids.
    """
    used = transactions.select(_owner().alias("owner"), "card_id").distinct()
    known = used.join(cards.select("card_id"), "card_id", "left_semi")
    piece = F.struct(
        "valid_from", "valid_to", "customer_id", F.unhex("customer_key").alias("customer_key"),
        F.unhex("account_key").alias("account_key"),
    )
    pieces = timeline.groupBy(F.col("account_id").alias("owner")).agg(F.collect_list(piece).alias("pieces"))
    return pieces.join(known.groupBy("owner").agg(F.collect_list("card_id").alias("cards")), "owner", "full_outer")


def fact_keys(transactions: DataFrame, lookup: DataFrame, context: DataFrame) -> DataFrame:
    """What a fact row needs from the large tables, and from its transaction; `fact_measures` adds the rest.

    The only shuffle is by account, on rows as narrow as they can be.
    """
    narrow = _in_context(transactions, context).select(
        "transaction_id", _owner().alias("owner"), "card_id", "merchant_id", "txn_timestamp", "posted_date",
        "amount_minor", "currency", "mcc", "txn_type", "txn_context_key", "feed_version", "was_duplicated",
    )
    at = F.col("txn_timestamp")
    valid = F.filter("pieces", lambda piece: (piece["valid_from"] <= at) & (at < piece["valid_to"]))
    found = narrow.join(lookup, "owner", "left").select(
        *[c for c in narrow.columns if c not in ("owner", "card_id")],
        F.when(F.array_contains("cards", F.col("card_id")), F.col("card_id")).alias("card_key"),
        F.explode_outer(valid).alias("piece"),
    )
    return found.select(
        *[c for c in found.columns if c != "piece"], "piece.customer_id", "piece.customer_key", "piece.account_key"
    )


def fact_measures(keys: DataFrame, medians: DataFrame, fx: DataFrame) -> DataFrame:
    """The fact from `fact_keys`: everything that the row itself and small tables tell."""
    rows = keys.withColumns(
        {
            "auth_date": home_date(keys, "txn_timestamp"),
            "card_unknown": F.col("card_key").isNull(),
            "customer_key": F.lower(F.hex("customer_key")),
            "account_key": F.lower(F.hex("account_key")),
        }
    )
    return _fact_columns(_priced(rules.judge(rows, medians), fx))


def _priced(rows: DataFrame, fx: DataFrame) -> DataFrame:
    rates = fx.select(
        F.col("rate_date").alias("posted_date"), "currency", F.col("rate_to_gbp").alias("fx_rate_to_gbp"),
        F.col("is_carried_forward").alias("fx_rate_carried_forward"),
    )
    return rows.join(rates, ["posted_date", "currency"], "left")


def _in_context(rows: DataFrame, context: DataFrame) -> DataFrame:
    names = ["txn_type", "channel", "status"]
    return rows.join(context.select(*names, "txn_context_key"), names, "left")


def _fact_columns(rows: DataFrame) -> DataFrame:
    def or_unknown(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(UNKNOWN))

    return rows.select(
        "transaction_id",
        dates.date_key(F.col("posted_date")).alias("posted_date_key"),
        dates.date_key(F.col("auth_date")).alias("auth_date_key"),
        "posted_date", "auth_date", "txn_timestamp",
        or_unknown("customer_key").alias("customer_key"),
        or_unknown("account_key").alias("account_key"),
        or_unknown("customer_id").alias("customer_id"),
        or_unknown("card_key").alias("card_key"),
        or_unknown("merchant_id").alias("merchant_key"),
        "txn_context_key",
        F.col("currency").alias("currency_key"),
        "mcc", "amount_minor",
        convert(F.col("amount_minor"), F.col("fx_rate_to_gbp")).alias("amount_gbp_minor"),
        "fx_rate_to_gbp", "fx_rate_carried_forward", "posting_lag_days", "dq_score",
        *rules.FLAGS.values(),
        "feed_version",
    )


def category_of(rows: DataFrame, merchants: DataFrame, small: bool = False) -> DataFrame:
    """`category` by merchant key, `unknown` when there is none. `small`: checked to be broadcastable."""
    lookup = merchants.select("merchant_key", "category")
    joined = rows.join(F.broadcast(lookup) if small else lookup, "merchant_key", "left")
    return joined.withColumn("category", F.coalesce("category", F.lit("unknown")))


def agg_customer_category_month(
    fact_rows: DataFrame, settled_context: DataFrame, merchants: DataFrame, small_merchants: bool
) -> DataFrame:
    """Customer x month x category, settled only.

    A small merchant dimension is broadcast and one aggregate does it all. A large one would
    have to be shuffled against the fact, so rows are then counted per merchant first: the join
    meets each (customer, month, merchant) once, and neither a busy merchant nor the UNKNOWN one
    is a hot key.
    """
    amount = F.col("amount_gbp_minor")
    keys = ("customer_id", "month_start")
    settled = fact_rows.join(settled_context, "txn_context_key")
    settled = settled.withColumn("month_start", F.trunc("posted_date", "month"))
    first = {
        "txn_count": F.count(F.lit(1)),
        "spend_gbp_minor": F.sum(amount),
        "net_spend_gbp_minor": sum_if(F.col("counts_towards_spend"), amount),
        "online_spend_gbp_minor": sum_if(F.col("is_card_not_present"), amount),
        "score_total": F.sum("dq_score"),
    }
    sums = [value.alias(name) for name, value in first.items()]
    if small_merchants:
        totals = category_of(settled, merchants, small=True).groupBy(*keys, "category").agg(*sums)
    else:
        narrow = settled.groupBy(*keys, "merchant_key").agg(*sums)
        again = [F.sum(name).alias(name) for name in first]
        totals = category_of(narrow, merchants).groupBy(*keys, "category").agg(*again)
    return totals.select(
        "customer_id", dates.month_key(F.col("month_start")).alias("month_key"), "category",
        "txn_count", "spend_gbp_minor", "net_spend_gbp_minor", "online_spend_gbp_minor",
        (F.col("score_total") / F.col("txn_count")).alias("avg_dq_score"),
    )


def agg_dq_scorecard(fact_rows: DataFrame) -> DataFrame:
    counted = reshape.count_flags(fact_rows, "posted_date", rules.FLAGS)
    return counted.select(
        "posted_date", "defect_code", rules.dimension_of(F.col("defect_code")).alias("dimension"),
        "rows_checked", "rows_failed",
        (F.lit(1.0) - F.col("rows_failed") / F.col("rows_checked").cast("double")).alias("pass_rate"),
    )
