"""Typed projections and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, TimestampType

from ..functions import epoch
from ..functions.numbers import number

# Stand-ins for missing values of the generic quality dataset.
DEFAULTS = {"value_column": 0, "date_column": "1900-01-01 00:00:00"}


def _whole(name: str):
    """Whole number; a fraction is cut off, a value that is no number becomes null."""
    return number(F.col(name)).try_cast("bigint").alias(name)


def _long(df: DataFrame, name: str):
    kind = df.schema[name].dataType.simpleString()
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return F.col(name).cast("bigint").alias(name)
    return _whole(name)


def pos_clean(pos: DataFrame) -> DataFrame:
    return pos.select(
        "transaction_id",
        *[_long(pos, c) for c in ("store_id", "product_id", "quantity")],
        F.col("revenue").try_cast("double").alias("revenue"),
        F.col("discount_applied").try_cast("double").alias("discount_applied"),
        epoch.as_text(F.col("timestamp")).alias("transaction_time"),
    )


def inventory_clean(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        *[_long(inventory, c) for c in ("inventory_id", "product_id", "warehouse_id",
                                        "stock_level", "restock_threshold")],
        epoch.as_text(F.col("last_updated")).alias("last_updated_time"),
    )


def with_event_time(df: DataFrame, column: str = "timestamp", name: str = "event_time",
                    text: bool = True) -> DataFrame:
    """Readable event time: text without fraction for reports, else a timestamp."""
    convert = epoch.as_text if text else epoch.as_timestamp
    return df.withColumn(name, convert(F.col(column)))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Per-column stand-ins for nulls, and for doubles that are no number; timestamps as text."""
    filled = {}
    for name, value in (DEFAULTS if defaults is None else defaults).items():
        if name in df.columns:
            kind = df.schema[name].dataType
            present = number(F.col(name)) if isinstance(kind, DoubleType) else F.col(name)
            filled[name] = F.coalesce(present, F.lit(value).cast(kind))
    return df.withColumns(filled) if filled else df


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def require_columns(df: DataFrame, required: dict[str, DataType]) -> DataFrame:
    missing = {name: F.lit(None).cast(dtype) for name, dtype in required.items()
               if name not in df.columns}
    return df.withColumns(missing) if missing else df


def standardise_types(df: DataFrame, value: str = "value_column",
                      date: str = "date_column") -> DataFrame:
    """Value as double and date as timestamp; unreadable entries become null."""
    typed = {}
    if value in df.columns:
        typed[value] = number(F.col(value))
    if date in df.columns:
        kind = df.schema[date].dataType
        typed[date] = (F.col(date).cast(TimestampType()) if kind.simpleString() != "string"
                       else F.try_to_timestamp(F.col(date)))
    return df.withColumns(typed)
