"""Null-safe arithmetic: ANSI mode raises where the KPIs want a null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: Column) -> Column:
    """Numeric reading of a dirty column; text that is no number becomes null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)
