"""Quality job: clean a table, profile it, validate and enrich every row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, TimestampType

from ..operators import cleaning, enrichment, quality, validation

# Columns the generic dataset must have, with the type of an added null column.
REQUIRED = {
    "common_column": StringType(),
    "value_column": DoubleType(),
    "date_column": TimestampType(),
}


def cleaned(df: DataFrame) -> DataFrame:
    """Typed, without duplicate rows, complete in columns and without nulls in the key ones."""
    typed = cleaning.standardise_types(cleaning.require_columns(df, REQUIRED))
    return cleaning.fill_defaults(cleaning.drop_duplicate_rows(typed))


def quality_rows(df: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Cleaned rows with outlier, validation and calendar columns.

    Statistics and first date come from one aggregate row, set beside every cleaned row.
    """
    tidy = cleaned(df)
    numeric = quality.numeric_columns(tidy)
    overall = tidy.agg(*quality.outlier_stats(numeric), F.min("date_column").alias("_first"))
    rows = tidy.crossJoin(F.broadcast(overall)).withColumns(quality.outlier_flags(numeric))
    rows = validation.value_check(validation.date_check(rows, as_of))
    rows = enrichment.weekend_flag(enrichment.date_parts(rows))
    return (rows.withColumn("days_since_first_event", F.datediff("date_column", "_first"))
            .drop(*overall.columns))


def cleaned_columns(rows: DataFrame) -> list[str]:
    """The columns of a ``quality_rows`` result that come from the table itself."""
    added = {"date_validation", "value_validation", "year", "month", "day", "day_of_week",
             "is_weekend", "days_since_first_event"}
    return [c for c in rows.columns if c not in added and not c.endswith("_is_outlier")]


def quality_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    return quality.profile(cleaned(df), approximate)
