"""Record and value validation, with counts of what was removed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.numbers import number
from ..functions.payload import CORRUPT, decode_text, parse_object
from ..schemas import CRM_REQUIRED
from .filters import RATING_MAX, RATING_MIN, is_truthy

# Outcomes a delivery service understands.
OK, DROPPED, FAILED = "Ok", "Dropped", "ProcessingFailed"

# First valid year and the valid value range.
FIRST_YEAR, VALUE_MIN, VALUE_MAX = 1900, 0, 1_000_000


def validate_records(raw: DataFrame, required: list[str] = CRM_REQUIRED,
                     data: str = "data", encoded: bool = True) -> DataFrame:
    """Adds ``result``: ``Ok``, ``Dropped`` (a required field is missing or null) or
    ``ProcessingFailed`` (not decodable).

    All fields are read as text, so only presence counts. A JSON list is readable but holds no
    field, hence dropped; so is a JSON text, unless the name of the first field stands in it (a text
    that seems to have a field can't be processed). Exploding a list of one keeps Spark from parsing
    again per condition.
    """
    fields = StructType([StructField(f, StringType()) for f in required])
    text = F.col("_read.text")
    read = F.struct(text.alias("text"), parse_object(text, fields).alias("record"))
    decoded = raw.withColumn("_read", F.struct(decode_text(F.col(data), encoded).alias("text")))
    parsed = decoded.withColumn("_read", F.explode(F.array(read)))
    missing = F.lit(False)
    for field in required:
        missing = missing | F.col(f"_read.record.{field}").isNull()
    unreadable = (F.col("_read.record").isNull()
                  | F.col(f"_read.record.{CORRUPT}").isNotNull())
    result = (
        F.when(~unreadable & missing, DROPPED)
        .when(~unreadable, OK)
        .when(F.json_array_length("_read.text").isNotNull(), DROPPED)
        .when(_is_json_text(text) & ~F.contains(text, F.lit(required[0])), DROPPED)
        .otherwise(FAILED)
    )
    return parsed.withColumn("result", result).drop("_read")


def _is_json_text(text: Column) -> Column:
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.trim(text).startswith('"') & F.coalesce(alone, F.lit(False))


def result_columns() -> list[Column]:
    """Valid and dropped totals of validated records; undecodable ones count as dropped."""
    return [
        F.count("*").alias("records"),
        F.count_if(F.col("result") == OK).alias("valid"),
        F.count_if(F.col("result") != OK).alias("dropped"),
    ]


def result_counts(validated: DataFrame) -> DataFrame:
    return validated.agg(*result_columns())


def removal_columns(records: DataFrame) -> list[Column]:
    """What cleaning will remove from the records of a customer, and why."""
    routed = is_truthy(records, "customer_id", numeric=True)
    complete = routed & F.col("timestamp").isNotNull()
    off_scale = ~number(F.col("rating")).between(RATING_MIN, RATING_MAX)
    return [
        F.count_if(routed).alias("records"),
        F.count_if(routed & ~complete).alias("missing_keys"),
        F.count_if(complete & off_scale).alias("invalid_ratings"),
    ]


def removal_counts(records: DataFrame) -> DataFrame:
    return records.agg(*removal_columns(records))


def date_check(df: DataFrame, as_of: dt.datetime | str | None = None,
               date: str = "date_column") -> DataFrame:
    """``date_validation``: dates before the first year or after ``as_of`` (now) are invalid."""
    limit = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    bad = (F.year(date) < FIRST_YEAR) | (F.col(date) > limit)
    return df.withColumn("date_validation", F.when(bad, "Invalid date").otherwise("Valid"))


def value_check(df: DataFrame, value: str = "value_column") -> DataFrame:
    bad = (F.col(value) < VALUE_MIN) | (F.col(value) > VALUE_MAX)
    return df.withColumn("value_validation", F.when(bad, "Out of range").otherwise("Valid"))
