"""Lake folders. Parquet by default; any table format on the classpath by name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed value: pattern of the stamp in the name of a run folder.
STAMP = "%Y-%m-%d_%H-%M-%S"


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it doesn't exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())


def run_stamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime(STAMP)


def write_run_folder(df: DataFrame, base: str, name: str, stamp: str | None = None) -> str:
    """Own folder per dataset and run. The stamp is a partition value, so readers can prune on it."""
    path = f"{base}/{name}/run_ts={stamp or run_stamp()}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_daily(df: DataFrame, path: str, date: dt.date | str | None = None,
                mode: str = "append") -> None:
    """Append to a bronze feed under the day of ingestion.

    Every task writes files of its own name, so parallel writers cannot collide.
    """
    day = F.current_date() if date is None else F.lit(str(date)).cast("date")
    (df.withColumn("ingest_date", day)
     .write.mode(mode).partitionBy("ingest_date").parquet(path))


def append_table(df: DataFrame, path: str, table_format: str = "parquet") -> None:
    """Add KPI rows to a lake table."""
    df.write.format(table_format).mode("append").save(path)


def write_snapshot(df: DataFrame, base: str, stamp: str | None = None,
                   table_format: str = "parquet") -> str:
    """Replace the snapshot of one run; running it again gives the same folder."""
    path = f"{base}/run_ts={stamp or run_stamp()}"
    df.write.format(table_format).mode("overwrite").save(path)
    return path


def write_batch(df: DataFrame, path: str, batch_id: int, query: str = "batch") -> None:
    """Rows of a micro-batch. A replayed batch replaces its own folder, never adds a row; the batches
    of another query have folders of their own."""
    df.write.mode("overwrite").parquet(f"{path}/query={query}/batch_id={batch_id}")


def write_delivery(validated: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Validated records, a folder per result."""
    target = path if batch_id is None else f"{path}/batch_id={batch_id}"
    validated.write.mode("overwrite").partitionBy("result").parquet(target)
