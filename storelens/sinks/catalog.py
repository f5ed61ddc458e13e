"""Catalog tables with a partition for each run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import RUN, table_name
from .folders import run_stamp


def write_run(df: DataFrame, table: str, database: str | None = None, stamp: str | None = None) -> str:
    """Writes ``df`` as the run ``stamp`` of a catalog table and returns the stamp.

    The table is made if it doesn't exist; columns go by name and must be those of the table. Running
    it again replaces the run and leaves the others. The row count and size of the run are stored in
    the catalog, where the optimizer finds them.
    """
    stamp = stamp or run_stamp()
    if not re.fullmatch(r"[\w.-]+", stamp, re.ASCII):
        raise ValueError(f"a stamp has letters, digits, '_', '-' and '.' only: {stamp!r}")
    spark, name, partition = df.sparkSession, table_name(table, database), f"PARTITION ({RUN} = '{stamp}')"
    (df.limit(0).withColumn(RUN, F.lit(stamp))
     .write.format("parquet").partitionBy(RUN).mode("ignore").saveAsTable(name))
    wanted = [c for c in spark.table(name).columns if c != RUN]
    if sorted(wanted) != sorted(df.columns):
        raise ValueError(f"columns of {name} are {wanted}, not {df.columns}")
    spark.sql(f"INSERT OVERWRITE TABLE {name} {partition} SELECT * FROM {{rows}}", rows=df.select(*wanted))
    spark.sql(f"ANALYZE TABLE {name} {partition} COMPUTE STATISTICS")
    return stamp
