"""Time expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import constants as K


def ntz(value: date | datetime | str) -> Column:
    """A zone-free timestamp literal, so comparisons push down to NTZ columns."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: date | datetime | str) -> Column:
    return F.lit(str(value)).cast("date")


def in_window(column: Column, start, end, closed: bool = False, dates: bool = False) -> Column:
    """``[start, end)``; ``closed`` also takes rows exactly at ``end``."""
    literal = day if dates else ntz
    upper = column <= literal(end) if closed else column < literal(end)
    return (column >= literal(start)) & upper


def display_timestamp(column: Column) -> Column:
    """``HH.MM-DD.MM.YY`` text; a missing time reads ``N/A``."""
    return F.coalesce(F.date_format(column, K.DISPLAY_PATTERN), F.lit(K.NO_TIME))


def as_time(df: DataFrame, name: str, pattern: str = K.DISPLAY_PATTERN) -> Column:
    """The time in column ``name``: as it is, or parsed if the table keeps text.

    Text that does not parse gives NULL.  Two-digit years read as 2000 to 2099.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name), F.lit(pattern)).cast("timestamp_ntz")
    return F.col(name)


def as_day(df: DataFrame, name: str) -> Column:
    """The date in column ``name``, parsed from ``YYYY-MM-DD`` if it is text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(F.col(name), "yyyy-MM-dd")
    return F.to_date(F.col(name))


def year_month_day(column: Column) -> Column:
    """First day of a ``YYYY/MM`` text; NULL if the text has another form."""
    return F.when(column.rlike(K.YEAR_MONTH_REGEX), F.try_to_date(column, "yyyy/MM"))


def with_year_month(df: DataFrame, at: Column) -> DataFrame:
    """Add integer ``year`` and ``month`` of ``at``; rows without a time fall out."""
    return df.filter(at.isNotNull()).withColumns({"year": F.year(at), "month": F.month(at)})


def hour_bucket(at: Column) -> Column:
    hour = F.hour(at)
    bucket = F.lit(K.NIGHT)
    for name, (first, last) in K.HOUR_BUCKETS.items():
        bucket = F.when(hour.between(first, last), F.lit(name)).otherwise(bucket)
    return F.when(hour.isNotNull(), bucket)
