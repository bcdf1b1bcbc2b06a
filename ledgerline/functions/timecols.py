"""Time expressions: tolerant timestamp parsing and calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def parse_timestamp(df: DataFrame, column: str = "timestamp") -> Column:
    """Timestamp column of ``df``; text is parsed with ``try_to_timestamp``.

    Under ANSI mode ``to_timestamp`` raises on bad text; ``try_to_timestamp``
    returns NULL instead, so one garbage value cannot fail a whole job.
    Columns that already hold timestamps pass through unchanged (decided from
    the schema while the plan is built, no job runs).
    """
    if isinstance(df.schema[column].dataType, StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column)


def month_label(ts="timestamp") -> Column:
    """``yyyy-MM`` month bucket (NULL for a NULL timestamp)."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM")


def month_start(ts="timestamp") -> Column:
    """First day of the month as DATE."""
    return F.trunc(calendar_date(ts), "MM")


def calendar_date(ts="timestamp") -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)
