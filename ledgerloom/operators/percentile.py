"""Exact grouped percentiles without holding a group in one task.

`percentile()` keeps every distinct value of a group in one aggregation buffer, which for a hot
group grows with the data. Selection by histogram stays exact with bounded state:

1. count each (group, value): partial aggregation collapses repeats before the shuffle;
2. add the counts up into log-linear bins, at most about 10^5 per group whatever the row count;
3. find the one or two bins that hold the wanted ranks, and rank only the values inside them.

A bin is at most 1/1024 of its own value wide, so step 3 is bounded too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS_KEPT = 11


def _bin_floor(value: Column) -> Column:
    """Lowest value of the bin that holds the integer `value`; monotone in `value`."""
    drop = F.greatest(F.length(F.bin(F.abs(value))) - _BITS_KEPT, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def _whole(df: DataFrame, value: str) -> Column:
    """An integer that never falls as the value rises: integers as they are, others in steps of 1/1024.

    It only chooses the bin; values inside a bin are ranked as they are.
    """
    if isinstance(df.schema[value].dataType, T.IntegralType):
        return F.col(value).cast("bigint")
    bound = float(1 << 60)
    return F.floor(F.least(F.greatest(F.col(value).cast("double") * 1024, F.lit(-bound)), F.lit(bound)))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    kept = F.col(value).cast("bigint") if isinstance(df.schema[value].dataType, T.IntegralType) else F.col(value)
    return df.where(F.col(value).isNotNull()).groupBy(*keys, kept.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _ranks(total: Column, fraction: float, method: str) -> dict[str, Column]:
    """The two ranks to interpolate between, and how far along."""
    position = (total - 1) * F.lit(float(fraction))
    if method == "nearest":
        low = high = F.rint(position)
        weight = F.lit(0.0)
    else:
        low, high = F.floor(position), F.ceil(position)
        weight = position - low
    return {"low_rank": low.cast("bigint"), "high_rank": high.cast("bigint"), "weight": weight}


def picked() -> Column:
    """Aggregate of ranked values (`value`, `first`, `last` and the ranks): the percentile."""

    def at(rank: str) -> Column:
        return F.max(F.when(F.col(rank).between(F.col("first"), F.col("last")), F.col("value")))

    low, high = at("low_rank").cast("double"), at("high_rank").cast("double")
    return low + (high - low) * F.max("weight")


def _over(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))


def _upto(group: WindowSpec, order: Column) -> WindowSpec:
    return group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rank_counts(counts: DataFrame, keys: Sequence[str], fraction: float, method: str = "linear") -> DataFrame:
    """A histogram (`keys`, `value`, `n`) made ready for `picked`.

    For groups with a bounded number of distinct values: one window per group. Null values are
    ranked last and never counted.
    """
    known = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(F.lit(0))
    last = F.sum(known).over(_upto(_over(keys), F.col("value").asc_nulls_last())) - 1
    return (
        counts.withColumns({"total": F.sum(known).over(_over(keys)), "last": last})
        .withColumn("first", F.col("last") - known + 1)
        .withColumns(_ranks(F.col("total"), fraction, method))
    )


def grouped_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fraction: float,
    out: str,
    method: str = "linear",
    few_groups: bool = False,
) -> DataFrame:
    """`keys` + `out`: the exact `fraction` percentile of a numeric column.

    method      "linear" interpolates between neighbours; "nearest" rounds the rank half to even.
    few_groups  the caller knows a bound on the number of groups, so the bins looked for
                (two per group) may be broadcast.
    """
    counts = value_counts(df, keys, value).withColumn("bin", _bin_floor(_whole(df.select(F.col(value).alias("value")), "value")))
    bins = counts.groupBy(*keys, "bin").agg(F.sum("n").alias("bin_n"))
    before = F.sum("bin_n").over(_upto(_over(keys), F.col("bin"))) - F.col("bin_n")
    here = [F.col(r).between(F.col("before"), F.col("before") + F.col("bin_n") - 1) for r in ("low_rank", "high_rank")]
    wanted = (
        bins.withColumns({"total": F.sum("bin_n").over(_over(keys)), "before": before})
        .withColumns(_ranks(F.col("total"), fraction, method))
        .where(here[0] | here[1])
        .drop("bin_n", "total")
    )
    if few_groups:
        wanted = F.broadcast(wanted)

    inside = _upto(_over([*keys, "bin"]), F.col("value"))
    ranked = (
        _null_safe_join(counts, wanted, [*keys, "bin"])
        .withColumn("last", F.col("before") + F.sum("n").over(inside) - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    return ranked.groupBy(*keys).agg(picked().alias(out))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"{k}__r"]) for k in keys]
    return left.join(renamed, on).drop(*[f"{k}__r" for k in keys])
