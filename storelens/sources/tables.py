"""Named tables and Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN = "run_ts"


def table_name(table: str, database: str | None = None) -> str:
    return f"`{database}`.`{table}`" if database else f"`{table}`"


def read_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(table_name(table, database))


def runs_of(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    """``run_ts`` of the runs that the catalog knows of a table; no file is read."""
    run = F.regexp_extract("partition", f"(?:^|/){RUN}=([^/]*)", 1)
    return spark.sql(f"SHOW PARTITIONS {table_name(table, database)}").select(run.alias(RUN))


def read_latest_run(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    """The rows of the last run of a table that is partitioned by ``run_ts``; none if it has no run.

    The catalog names the run and the scan is pruned to it, so that older runs cost nothing.
    """
    latest = runs_of(spark, table, database).agg(F.max(RUN)).first()[0]
    rows = read_table(spark, table, database)
    return rows.filter(F.lit(False) if latest is None else F.col(RUN) == latest)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet with a declared schema, or with the one stored in the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
