"""Calendar and time-zone columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOME_ZONE = "Europe/London"
OPEN_END = "9999-12-31 00:00:00"
BEGINNING = "1900-01-01 00:00:00"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def session_is_utc(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z")


def as_utc(df: DataFrame, name: str) -> Column:
    """UTC wall-clock time of a timestamp column, free of the session time zone."""
    ts = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return ts
    plain = ts.cast("timestamp_ntz")
    return plain if session_is_utc(df) else F.convert_timezone(F.current_timezone(), F.lit("UTC"), plain)


def home_date(df: DataFrame, name: str) -> Column:
    """The London date of a UTC wall-clock column.

    In a UTC session the zone rules are looked up once per task; `convert_timezone` looks them up
    per row, about ten times the cost, and serves every other session.
    """
    if session_is_utc(df):
        return F.to_date(F.from_utc_timestamp(F.col(name).cast("timestamp"), HOME_ZONE))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(HOME_ZONE), F.col(name)))


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def iso_weekday(day: Column) -> Column:
    return (F.weekday(day) + 1).cast("int")


def uk_fiscal_year(day: Column) -> Column:
    """The UK tax year opens on 6 April."""
    opens = F.make_date(F.year(day), F.lit(4), F.lit(6))
    return F.year(day) - (day < opens).cast("int")
