"""As-of lookup of daily observations, planned as equi-joins.

A correlated `<= date order by date desc limit 1` becomes a nested-loop join. Filling the small
side (keys x calendar days) instead turns the lookup into an equality on (key, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def date_bounds(df: DataFrame, date: str) -> DataFrame:
    """One row: the first and last `date`."""
    return df.agg(F.struct(F.min(date).alias("first"), F.max(date).alias("last")).alias("bounds"))


def daily(first: Column, last: Column) -> Column:
    """One row per day, both ends included."""
    return F.explode(F.sequence(first, last, F.expr("interval 1 day")))


def dense_daily(
    observations: DataFrame,
    bounds: DataFrame,
    key: str,
    date: str,
    value: str,
    flag: str = "is_carried_forward",
    seed_before: bool = False,
) -> DataFrame:
    """Every day in `bounds` for every key, the last known value carried over missing days.

    Days before a key's first observation stay null. With `seed_before`, an observation older
    than the first day may seed the fill. The bounds enter as a scalar subquery, so the grid
    needs no cross join; each key's window holds one row per calendar day.
    """
    span = bounds.scalar()
    first = span["first"]
    if seed_before:
        oldest = observations.agg(F.min(date)).scalar()
        first = F.least(first, oldest)
    grid = observations.select(key).distinct().select(key, daily(first, span["last"]).alias(date))
    seen = observations.select(key, date, value)
    upto = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = grid.join(seen, [key, date], "left").select(
        date,
        key,
        F.last(value, ignorenulls=True).over(upto).alias(value),
        F.col(value).isNull().alias(flag),
    )
    if seed_before:
        filled = filled.where(F.col(date) >= bounds.scalar()["first"])
    return filled


def asof_join(
    left: DataFrame, observations: DataFrame, key: str, left_date: str, date: str, value: str, out: str
) -> DataFrame:
    """Left rows with the latest `value` observed on or before their date; null if none.

    Each observation is stretched over the days it is the latest one for, up to the last day any
    key was observed; later left rows look that day up. Only the small side is ever measured.
    """
    last_day = observations.agg(F.max(date)).scalar()
    following = F.lead(date).over(Window.partitionBy(key).orderBy(date))
    until = F.coalesce(F.date_sub(following, 1), last_day)
    stretched = (
        observations.select(key, date, value, until.alias("until"))
        .where(F.col("until") >= F.col(date))
        .select(
            F.col(key).alias("asof_key"), daily(F.col(date), F.col("until")).alias("asof_day"), F.col(value).alias(out)
        )
    )
    asked = left.withColumn("asked_day", F.when(F.col(left_date) > last_day, last_day).otherwise(F.col(left_date)))
    on = (asked[key] == stretched["asof_key"]) & (asked["asked_day"] == stretched["asof_day"])
    return asked.join(stretched, on, "left").drop("asof_key", "asof_day", "asked_day")
