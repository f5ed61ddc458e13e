"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import epoch
from ..functions.numbers import number
from ..schemas import COMPLAINT, FEEDBACK

# Lowest and highest valid rating.
RATING_MIN, RATING_MAX = 1, 5


def valid_event_date(df: DataFrame, column: str) -> DataFrame:
    return df.filter(epoch.has_date(F.col(column)))


def _present(df: DataFrame, *columns: str) -> DataFrame:
    # Plain null tests reach the Parquet scan; na.drop turns into a test the scan cannot use.
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def web_required(df: DataFrame) -> DataFrame:
    return _present(df, "session_id", "timestamp")


def crm_required(df: DataFrame, timestamp_too: bool = False) -> DataFrame:
    return _present(df, "customer_id", *(["timestamp"] if timestamp_too else []))


def is_truthy(df: DataFrame, column: str, numeric: bool = False) -> Column:
    """Whether an id is neither null nor empty (text) nor zero (number). ``numeric`` says that a text may
    be that of a number, as those of records read as text."""
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, StringType):
        return value.isNotNull() & (value != F.lit(0))
    given = value.isNotNull() & (value != "")
    return given & F.coalesce(number(value) != 0, F.lit(True)) if numeric else given


def truthy(df: DataFrame, column: str, numeric: bool = False) -> DataFrame:
    return df.filter(is_truthy(df, column, numeric))


def is_engagement() -> Column:
    return F.col("interaction_type").isin(FEEDBACK, COMPLAINT) & F.col("rating").isNotNull()


def engagement(df: DataFrame) -> DataFrame:
    return df.filter(is_engagement())


def of_type(df: DataFrame, interaction_type: str) -> DataFrame:
    return df.filter(F.col("interaction_type") == interaction_type)


def is_usable(rating: Column) -> Column:
    """Missing, or a number on the scale."""
    return rating.isNull() | rating.between(RATING_MIN, RATING_MAX)


def rating_in_range(df: DataFrame) -> DataFrame:
    """Numeric ratings off the scale are dropped, unreadable ones become missing."""
    if "rating" not in df.columns:
        return df
    return df.withColumn("rating", number(F.col("rating"))).filter(is_usable(F.col("rating")))


def stocked_out(df: DataFrame) -> DataFrame:
    return df.filter(F.col("stock_level") == 0)


def any_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop("all", subset=columns)
