"""Money and ratio columns. Money is integer minor units until the last projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pounds(minor: Column) -> Column:
    return minor / F.lit(100.0)


def convert(amount_minor: Column, rate: Column) -> Column:
    """Whole pence, half away from zero."""
    return F.round(amount_minor * rate).cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    """Null, not an error, when the denominator is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))
