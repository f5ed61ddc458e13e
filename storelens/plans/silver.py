"""Bronze to silver: copy catalog tables into run folders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sinks.folders import run_stamp, write_run_folder
from ..sources.tables import read_table


def bronze_to_silver(spark: SparkSession, tables: dict[str, str], base: str,
                     database: str | None = None, stamp: str | None = None) -> dict[str, str]:
    """Writes each table to ``<base>/<folder>/run_ts=<stamp>`` and returns the folders written.

    ``tables`` maps a folder name to the table it is copied from; all share one stamp.
    """
    stamp = stamp or run_stamp()
    return {folder: write_run_folder(read_table(spark, table, database), base, folder, stamp)
            for folder, table in tables.items()}
