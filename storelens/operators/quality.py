"""Data-quality metrics: every column of a table in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from ..functions.numbers import ratio

# Fixed value: distance from the mean, in standard deviations, beyond which a value is an outlier.
OUTLIER_DEVIATIONS = 3


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (DoubleType, IntegerType, LongType))]


def _distinct(name: str, approximate: bool) -> Column:
    """Distinct values, a null counting as one."""
    column = F.col(name)
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return count + F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))


def _per_column(one_row: DataFrame, names: list[str], metrics: list[str]) -> DataFrame:
    """Turn ``<metric>_<i>`` columns of a single row into a row per column name."""
    rows = [F.struct(F.lit(name).alias("column"),
                     *[F.col(f"{metric}_{i}").alias(metric) for metric in metrics])
            for i, name in enumerate(names)]
    return one_row.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def completeness(df: DataFrame) -> DataFrame:
    """Share of rows with a value, per column; null for an empty table."""
    one_row = df.agg(*[ratio(F.count(c), F.count("*")).alias(f"completeness_{i}")
                       for i, c in enumerate(df.columns)])
    return _per_column(one_row, df.columns, ["completeness"])


def uniqueness(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per row, per column; ``approximate`` avoids the exact distinct shuffle."""
    one_row = df.agg(*[ratio(_distinct(c, approximate), F.count("*")).alias(f"uniqueness_{i}")
                       for i, c in enumerate(df.columns)])
    return _per_column(one_row, df.columns, ["uniqueness"])


def _stats(name: str, prefix: str) -> list[Column]:
    return [F.mean(name).alias(f"mean_{prefix}"), F.stddev(name).alias(f"stddev_{prefix}"),
            F.min(name).cast("double").alias(f"min_{prefix}"),
            F.max(name).cast("double").alias(f"max_{prefix}")]


def numeric_stats(df: DataFrame) -> DataFrame:
    """Mean, sample deviation, least and greatest value per numeric column."""
    names = numeric_columns(df)
    one_row = df.agg(*[stat for i, name in enumerate(names) for stat in _stats(name, str(i))])
    return _per_column(one_row, names, ["mean", "stddev", "min", "max"])


def outlier_stats(names: list[str]) -> list[Column]:
    """Aggregates that ``outlier_flags`` compares with."""
    return [stat for name in names for stat in (F.mean(name).alias(f"_mean_{name}"),
                                                F.stddev(name).alias(f"_std_{name}"))]


def outlier_flags(names: list[str]) -> dict[str, Column]:
    flags = {}
    for name in names:
        reach = OUTLIER_DEVIATIONS * F.col(f"_std_{name}")
        outside = ((F.col(name) > F.col(f"_mean_{name}") + reach)
                   | (F.col(name) < F.col(f"_mean_{name}") - reach))
        flags[f"{name}_is_outlier"] = F.coalesce(outside, F.lit(False))
    return flags


def flag_outliers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``<column>_is_outlier`` for each numeric column; nulls are never outliers.

    The statistics are one row, so the broadcast has a fixed size.
    """
    names = numeric_columns(df) if columns is None else columns
    stats = df.agg(*outlier_stats(names))
    return df.crossJoin(F.broadcast(stats)).withColumns(outlier_flags(names)).drop(*stats.columns)


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """All metrics of all columns from a single scan."""
    numeric = set(numeric_columns(df))
    metrics = ["completeness", "uniqueness", "mean", "stddev", "min", "max"]
    exprs = []
    for i, name in enumerate(df.columns):
        exprs.append(ratio(F.count(name), F.count("*")).alias(f"completeness_{i}"))
        exprs.append(ratio(_distinct(name, approximate), F.count("*")).alias(f"uniqueness_{i}"))
        if name in numeric:
            exprs.extend(_stats(name, str(i)))
    one_row = df.agg(*exprs)
    absent = {f"{m}_{i}": F.lit(None).cast("double") for i, name in enumerate(df.columns)
              if name not in numeric for m in metrics[2:]}
    return _per_column(one_row.withColumns(absent) if absent else one_row, df.columns, metrics)
