"""Column profiles that can be stored per partition and merged without reading the data again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType

from ..functions.numbers import ratio

# Registers of a sketch, as a power of two: standard error of 1.04 / sqrt(2 ** 14) = 0.8 %, at most 16 KB.
REGISTERS = 14


def _sketch(df: DataFrame, name: str) -> Column:
    plain = isinstance(df.schema[name].dataType, (BinaryType, IntegerType, LongType, StringType))
    column = F.col(f"`{name}`")
    return F.hll_sketch_agg(column if plain else column.cast("string"), REGISTERS)


def column_sketches(df: DataFrame, *by: str) -> DataFrame:
    """``column, rows, present, sketch`` of each column and group of ``by`` (the table, if none is
    given), from one scan; ``sketch`` stands for the distinct values, nulls left out.

    Values of other types than numbers, texts and bytes count by their text. A table without rows
    gives no rows if ``by`` is given, else rows of zero.
    """
    names = [c for c in df.columns if c not in by]
    aggregates = [F.count("*").alias("_rows")]
    for i, name in enumerate(names):
        aggregates += [F.count(f"`{name}`").alias(f"_present_{i}"), _sketch(df, name).alias(f"_sketch_{i}")]
    profiles = [F.struct(F.lit(name).alias("column"), F.col("_rows").alias("rows"),
                         F.col(f"_present_{i}").alias("present"), F.col(f"_sketch_{i}").alias("sketch"))
                for i, name in enumerate(names)]
    return (df.groupBy(*by).agg(*aggregates)
            .select(*by, F.explode(F.array(*profiles)).alias("_profile")).select(*by, "_profile.*"))


def merged_profile(sketches: DataFrame, *by: str) -> DataFrame:
    """``column, completeness, uniqueness`` of everything that ``sketches`` stands for, per group of
    ``by``. Completeness is exact, uniqueness an estimate in which a null counts as a value."""
    rows, present = F.sum("rows"), F.sum("present")
    distinct = F.hll_sketch_estimate(F.hll_union_agg("sketch")) + (present < rows).cast("int")
    return sketches.groupBy(*by, "column").agg(
        ratio(present, rows).alias("completeness"), ratio(distinct, rows).alias("uniqueness"))
