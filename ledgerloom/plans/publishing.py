"""Write, audit, publish: a set of tables becomes readable only when what was written passes its checks.

The tables of one publication are written into a folder that no reader knows, the checks read them back
from there, and the pointer moves when none is violated. A refused publication leaves the readers on the
version they had; its folder stays for inspection until `vacuum`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.money import count_if
from ledgerloom.operators import checks
from ledgerloom.sources.versions import Version, VersionedTable


class PublishRefused(RuntimeError):
    """The written tables violate a check; nothing was published."""

    def __init__(self, violated: Mapping[str, int]) -> None:
        super().__init__("; ".join(f"{check}: {n}" for check, n in violated.items()))
        self.violated = dict(violated)


def current_path(spark: SparkSession, target: str) -> str:
    """The folder of the published version."""
    table = VersionedTable(spark, target)
    version = table.current()
    if version is None:
        raise LookupError(f"nothing has been published under {target}")
    return table.path(version.folders[0])


def publish_checked(
    spark: SparkSession,
    target: str,
    write: Callable[[str], None],
    audit: Callable[[str], DataFrame],
) -> Version:
    """`write` fills a folder, `audit` reads it and counts `check, violations`; both get its path."""
    table = VersionedTable(spark, target)
    before = table.current()
    folder = table.new_folder()
    write(table.path(folder))
    # One row a declared check.
    found = {r["check"]: int(r["violations"] or 0) for r in audit(table.path(folder)).collect()}
    violated = {check: n for check, n in found.items() if n}
    if violated:
        raise PublishRefused(violated)
    return table.commit([folder], {"checks": sorted(found)}, after=before)


def rows_conserved(written: Mapping[str, DataFrame], expected: Mapping[str, DataFrame]) -> DataFrame:
    """Per table, by how many rows the written one differs from the one it was made from."""
    parts = []
    for name, df in expected.items():
        both = df.select(F.lit(1).alias("side")).unionByName(written[name].select(F.lit(-1).alias("side")))
        gap = F.abs(F.coalesce(F.sum("side"), F.lit(0)))
        parts.append(both.agg(gap.alias("violations")).select(F.lit(f"{name} rows conserved").alias("check"), "violations"))
    return checks.union_all(parts)


def tests_of(fact: DataFrame) -> DataFrame:
    """The row tests of the fact that the columns of a copy allow."""
    keys = ("customer_key", "customer_id", "account_key", "card_key", "merchant_key", "txn_context_key", "posted_date_key")
    gbp = (F.col("currency_key") == "GBP") & (F.col("amount_minor") != F.col("amount_gbp_minor"))
    tests = {
        "fact without fx rate": F.col("fx_rate_to_gbp").isNull(),
        "gbp not identical": gbp,
        "score out of range": (F.col("dq_score") < 0) | (F.col("dq_score") > 100),
    } | {f"null {key}": F.col(key).isNull() for key in keys if key in fact.columns}
    return checks.count_violations(fact, tests)


def repeated_ids(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(count_if(F.col("n") > 1).alias("violations")).select(
        F.lit("transaction repeated").alias("check"), "violations"
    )
