"""Derived columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: run time in ISO form.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Dayofweek numbers of Sunday and Saturday.
WEEKEND = (1, 7)


def date_parts(df: DataFrame, date: str = "date_column") -> DataFrame:
    return df.withColumns({
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": F.dayofweek(date),
    })


def weekend_flag(df: DataFrame, date: str = "date_column") -> DataFrame:
    return df.withColumn("is_weekend", F.coalesce(F.dayofweek(date).isin(*WEEKEND), F.lit(False)))


def days_since_first(df: DataFrame, date: str = "date_column",
                     name: str = "days_since_first_event") -> DataFrame:
    """Days since the earliest date of the whole set.

    The first date is one aggregated row, broadcast; no window over a single partition.
    """
    first = df.agg(F.min(date).alias("_first"))
    return (df.crossJoin(F.broadcast(first))
            .withColumn(name, F.datediff(date, "_first"))
            .drop("_first"))


def flag(df: DataFrame, name: str, value: int = 1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def _instant(as_of: dt.datetime | str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def kpi_stamp(df: DataFrame, as_of: dt.datetime | str | None = None, name: str = "kpi_date",
              pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Run time as text; ``as_of`` fixes it for reruns and tests."""
    return df.withColumn(name, F.date_format(_instant(as_of), pattern))


def envelope(data: Column, request_id: Column, as_of: dt.datetime | str | None = None) -> Column:
    """Payload with arrival time, request id and origin."""
    stamp = F.date_format(_instant(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.struct(
        stamp.alias("timestamp"),
        F.coalesce(request_id, F.lit("unknown")).alias("requestId"),
        F.lit("api-gateway").alias("source"),
        data.alias("data"),
    )
