"""How good a rule is, measured against a ledger of known defects; and defect injection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import ratio_or_zero


def flagged_rows(fact: DataFrame, flags: Mapping[str, str], key: str = "transaction_id") -> DataFrame:
    """`key`, `defect_code` of every failed rule: one scan, only failing rows multiply."""
    failed = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(code)) for code, flag in flags.items()]))
    return fact.select(key, failed.alias("failed")).where(F.size("failed") > 0).select(
        key, F.explode("failed").alias("defect_code")
    )


def detection_quality(flagged: DataFrame, ledger: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Per code: injected, flagged, true_positives, recall, precision (0 when undefined).

    Truth and findings are stacked and aggregated by (code, id), so no join is needed and every
    code is measured in the same pass.
    """
    stacked = (
        ledger.select("defect_code", key, F.lit(1).alias("truth"), F.lit(0).alias("found"))
        .unionByName(flagged.select("defect_code", key, F.lit(0).alias("truth"), F.lit(1).alias("found")))
        .groupBy("defect_code", key)
        .agg(F.max("truth").alias("truth"), F.max("found").alias("found"))
    )
    counts = stacked.groupBy("defect_code").agg(
        F.sum("truth").cast("bigint").alias("injected"),
        F.sum("found").cast("bigint").alias("flagged"),
        F.sum(F.col("truth") * F.col("found")).cast("bigint").alias("true_positives"),
    )
    hits = F.col("true_positives")
    return counts.withColumns(
        {"recall": ratio_or_zero(hits, F.col("injected")), "precision": ratio_or_zero(hits, F.col("flagged"))}
    )


def undetected_value(fact: DataFrame, ledger: DataFrame, code: str, flag: str, amount: str) -> DataFrame:
    """One row: injected defects of `code`, those the rule missed, and their value in pounds."""
    truth = ledger.where(F.col("defect_code") == code).select("transaction_id").distinct()
    injected = truth.agg(F.count(F.lit(1)).alias("n")).scalar()
    missed = ~F.col(flag)
    return fact.join(truth, "transaction_id").agg(
        F.max(injected).alias("injected"),
        F.count(F.when(missed, F.lit(1))).alias("missed_rows"),
        (F.coalesce(F.sum(F.when(missed, F.col(amount))), F.lit(0)) / F.lit(100.0)).alias("missed_value_gbp"),
    )


@dataclass(frozen=True)
class Injection:
    """One defect to plant: where it may go, how often, and what it changes.

    `changes` maps column -> new value; an injection without changes emits the row twice.
    """

    code: str
    rate: float
    where: Column
    changes: Mapping[str, Column] = field(default_factory=dict)


_SLOTS = 1_000_000


def inject_defects(
    df: DataFrame, key: str, injections: list[Injection], seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(feed with defects, ledger). A row is hit when a hash of its key and the code falls below
    the rate, so the same seed hits the same rows whatever the partitioning."""

    def hit(item: Injection) -> Column:
        digest = F.md5(F.concat_ws("|", F.col(key), F.lit(item.code), F.lit(str(seed))))
        slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % _SLOTS
        return item.where & (slot < int(round(item.rate * _SLOTS)))

    marks = {f"hit_{item.code}": F.coalesce(hit(item), F.lit(False)) for item in injections}
    marked = df.withColumns(marks)
    ledger = flagged_rows(marked, {item.code: f"hit_{item.code}" for item in injections}, key)

    dirty = marked
    for item in injections:
        for column, value in item.changes.items():
            changed = F.when(F.col(f"hit_{item.code}"), value).otherwise(F.col(column))
            dirty = dirty.withColumn(column, changed.cast(df.schema[column].dataType))
    repeats = F.lit(1)
    for item in injections:
        if not item.changes:
            repeats = repeats + F.col(f"hit_{item.code}").cast("int")
    dirty = dirty.withColumn("copy", F.explode(F.array_repeat(F.lit(0), repeats)))
    return dirty.select(*df.columns), ledger
