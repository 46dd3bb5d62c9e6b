"""Row-quality rules as data: flag columns, penalties and the 0..100 score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import postcode_ok
from ledgerloom.operators.percentile import grouped_percentile
from ledgerloom.operators.reshape import presence_flag


@dataclass(frozen=True)
class Rule:
    code: str
    flag: str
    dimension: str
    penalty: int
    test: Callable[[], Column]


# Fixed values of the rule set.
MCC_LOW, MCC_HIGH = 1000, 9999
LATE_AFTER_DAYS = 2
MEDIAN_MULTIPLE = 40
MEDIAN_DEFAULT_MINOR = 50000
FLAT_LIMIT_MINOR = 5_000_000  # the retired range check: more than 50,000 pounds


def _purchase() -> Column:
    return F.col("txn_type") == "purchase"


def posting_lag() -> Column:
    return F.datediff("posted_date", "auth_date")


RULES: tuple[Rule, ...] = (
    Rule("D01", "dq_missing_merchant", "completeness", 20, lambda: _purchase() & F.col("merchant_id").isNull()),
    Rule("D02", "dq_duplicated", "uniqueness", 5, lambda: F.col("was_duplicated")),
    Rule("D03", "dq_orphan_card", "consistency", 20, lambda: F.col("card_unknown")),
    Rule("D04", "dq_negative_purchase", "validity", 20, lambda: _purchase() & (F.col("amount_minor") < 0)),
    Rule("D05", "dq_bad_mcc", "validity", 5, lambda: ~F.col("mcc").between(MCC_LOW, MCC_HIGH)),
    Rule("D06", "dq_late_posting", "timeliness", 5, lambda: posting_lag() > LATE_AFTER_DAYS),
    Rule(
        "D07",
        "dq_implausible_amount",
        "accuracy",
        20,
        lambda: F.abs("amount_minor") > MEDIAN_MULTIPLE * F.coalesce("median_amount_minor", F.lit(MEDIAN_DEFAULT_MINOR)),
    ),
)
FLAGS = {rule.code: rule.flag for rule in RULES}
DIMENSIONS = {rule.code: rule.dimension for rule in RULES}


def dimension_of(code: Column) -> Column:
    pairs = [F.lit(part) for item in DIMENSIONS.items() for part in item]
    return F.create_map(*pairs)[code]


def category_medians(transactions: DataFrame) -> DataFrame:
    """`mcc`, `median_amount_minor` over well-formed purchases: at most 9,000 rows by the filter."""
    purchases = transactions.where(_purchase() & F.col("mcc").between(MCC_LOW, MCC_HIGH)).select(
        "mcc", F.abs("amount_minor").alias("size_minor")
    )
    return grouped_percentile(purchases, ["mcc"], "size_minor", 0.5, "median_amount_minor", few_groups=True)


def score() -> Column:
    """100 less the penalty of each failed rule, at least 0. A null flag makes it 0."""
    left = F.lit(100)
    for rule in RULES:
        left = left - F.lit(rule.penalty) * F.col(rule.flag).cast("int")
    return F.greatest(F.lit(0), left)


def apply_rules(transactions: DataFrame, cards: DataFrame, medians: DataFrame) -> DataFrame:
    """Flags, `posting_lag_days` and `dq_score`. Bad rows stay, flagged. `cards` has distinct ids.

    The medians are at most 9,000 rows (integers 1000..9999), hence the broadcast.
    """
    return judge(presence_flag(transactions, "card_id", cards, "card_id", "card_unknown"), medians)


def judge(known: DataFrame, medians: DataFrame) -> DataFrame:
    """`apply_rules` for rows that already say whether their card is unknown (`card_unknown`)."""
    typical = F.broadcast(medians.withColumnRenamed("mcc", "median_mcc"))
    joined = known.join(typical, F.col("mcc") == F.col("median_mcc"), "left")
    return (
        joined.withColumns({rule.flag: rule.test() for rule in RULES})
        .withColumns({"posting_lag_days": posting_lag(), "dq_score": score()})
        .drop("card_unknown", "median_mcc", "median_amount_minor")
    )


def feed_rules_customers() -> dict[str, Column]:
    """Rules declared for customers but scored nowhere in the fact."""
    return {
        "D08": ~postcode_ok(F.col("postcode")),
        "D09": (F.col("kyc_status") == "verified") & F.col("kyc_verified_at").isNull(),
    }


def open_with_closed_date() -> Column:
    """D10."""
    return (F.col("status") == "open") & F.col("closed_on").isNotNull()
