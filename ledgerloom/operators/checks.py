"""Table tests that return one row of violation counts each, and reconciliations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import count_if


def _row(df: DataFrame, check: str, violations: Column) -> DataFrame:
    return df.agg(violations.cast("bigint").alias("violations")).select(F.lit(check).alias("check"), "violations")


def count_violations(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """`check`, `violations` for each row test, all counted in one pass."""
    counts = df.agg(*[count_if(test).alias(f"test_{i}") for i, test in enumerate(tests.values())])
    pairs = [
        F.struct(F.lit(name).alias("check"), F.col(f"test_{i}").alias("violations")) for i, name in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return count_violations(df, {f"{table}.{c} not null": F.col(c).isNull() for c in columns})


def unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Number of key values held by more than one row (nulls are not compared)."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _row(repeated, f"{table}.{'+'.join(columns)} unique", F.count(F.lit(1)))


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[object]) -> DataFrame:
    return _row(df, f"{table}.{column} accepted values", count_if(~F.col(column).isin(*values)))


def relationship(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    """Child rows without a parent; null keys pass.

    The child is counted per key before the anti join, so a key held by a third of the rows
    enters the join once.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("k"))
    keys = keys.agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(F.col(parent_key).alias("k")), "k", "left_anti")
    return _row(orphans, check, F.coalesce(F.sum("n"), F.lit(0)))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Full outer comparison of two sets of totals: both sides, the difference, and the verdict.

    Written as union + aggregate, which needs one shuffle and treats a missing side as absent.
    """
    a = left.select(*keys, F.col(measure).alias("left_total"), F.lit(None).cast("bigint").alias("right_total"))
    b = right.select(*keys, F.lit(None).cast("bigint").alias("left_total"), F.col(measure).alias("right_total"))
    both = a.unionByName(b).groupBy(*keys).agg(
        F.sum("left_total").alias("left_total"), F.sum("right_total").alias("right_total")
    )
    gap = F.coalesce("left_total", F.lit(0)) - F.coalesce("right_total", F.lit(0))
    agrees = F.col("left_total").eqNullSafe(F.col("right_total"))
    return both.withColumns({"difference": gap, "agrees": agrees})
