"""Small relational reshapes used by several plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The value on the latest `order` of each key: a hash aggregate, no sort."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first `n` rows of each group. Spark cuts each map task to `n` per group (WindowGroupLimit)."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def top_n_other(df: DataFrame, label: str, value: str, n: int, other: str = "Other") -> DataFrame:
    """The `n` largest labels kept, the rest folded into one row.

    The kept labels come from a distributed top-k, so they are at most `n` rows to broadcast.
    """
    head = df.orderBy(F.col(value).desc_nulls_last(), F.col(label).asc()).limit(n)
    kept = head.select(F.col(label).alias("kept_label"))
    named = F.when(F.col("kept_label").isNotNull(), F.col(label)).otherwise(F.lit(other))
    return (
        df.join(F.broadcast(kept), F.col(label) == F.col("kept_label"), "left")
        .groupBy(named.alias(label))
        .agg(F.sum(value).alias(value))
    )


def junk_dimension(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Number the distinct combinations of a few code columns, in order.

    The codes are closed enumerations of the feed contract (at most 80 combinations here), and
    only the distinct combinations reach the numbering window.
    """
    order = Window.orderBy(*columns)
    return df.select(*columns).distinct().select(F.row_number().over(order).alias(key), *columns)


def with_unknown(df: DataFrame, member: Mapping[str, Any]) -> DataFrame:
    """Add the UNKNOWN member that unmatched keys land on."""
    row = df.sparkSession.range(1).select(
        *[F.lit(member[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row)


def count_flags(df: DataFrame, by: str, flags: Mapping[str, str], code: str = "defect_code") -> DataFrame:
    """Rows checked and failed per `by` and flag, from one scan.

    The flags are summed first and unpivoted after, so the fact is never multiplied by the number
    of rules.
    """
    sums = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.sum(F.col(column).cast("bigint")).alias(name) for name, column in flags.items()],
    )
    return sums.unpivot([by, "rows_checked"], list(flags), code, "rows_failed")


def presence_flag(left: DataFrame, key: str, known: DataFrame, known_key: str, flag: str) -> DataFrame:
    """All left rows, `flag` true when the key is not in `known`, whose keys must be distinct.

    Deduplicating `known` inside this plan would put an aggregate under the join, and AQE splits
    a hot key only where both sides come straight from a shuffle.
    """
    keys = known.select(F.col(known_key).alias("known_key"))
    joined = left.join(keys, left[key] == keys["known_key"], "left")
    return joined.withColumn(flag, F.col("known_key").isNull()).drop("known_key")
