"""Free SQL over lake tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Runs ``sql``, in which ``{name}`` stands for the frame of that name; the statement stays lazy and
    views of the session keep their names."""
    return spark.sql(sql, **tables)
