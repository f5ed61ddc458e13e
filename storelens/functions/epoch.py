"""Epoch-second columns as text, timestamps and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 0001-01-01 and of the end of 9999-12-31.
FIRST_SECOND, END_SECOND = -62135596800.0, 253402300800.0
DAY = 86400


def whole_seconds(epoch: Column) -> Column:
    """Epoch without its fraction; null where the value is no number."""
    return epoch.try_cast("double").try_cast("bigint")


def as_text(epoch: Column) -> Column:
    return F.from_unixtime(whole_seconds(epoch))


def as_timestamp(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch.try_cast("double"))


def has_date(epoch: Column) -> Column:
    """True where the epoch falls on a calendar date.

    A plain range, so on a double column the scan can use it to skip row groups.
    """
    return (epoch >= FIRST_SECOND) & (epoch < END_SECOND)


def as_date(epoch: Column) -> Column:
    """UTC calendar date by integer arithmetic, without formatting and parsing text."""
    days = F.floor(whole_seconds(epoch) / DAY).cast("int")
    return F.when(has_date(epoch), F.date_from_unix_date(days))
