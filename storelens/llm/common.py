"""Helpers the operators share."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, short lineage, and
    safe when executors are lost."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_parts(parts: Sequence[DataFrame], name: str) -> DataFrame:
    """What ``stored`` gives of the union of ``parts`` (one at least, of one schema), which are computed one after the
    other: shuffle files of one part are on disk at a time."""
    first = parts[0]
    path = work_dir(first.sparkSession, name)
    for part in parts:
        part.write.mode("append").parquet(path)
        _free_shuffles(first.sparkSession)
    return first.sparkSession.read.schema(first.schema).parquet(path)


def discard(first: DataFrame, *more: DataFrame) -> None:
    """Deletes what ``stored`` has written of these. Nothing that is still lazy may read them; a task that is
    run again reads what was made of them. Shuffle files that no plan needs any more go as well: Spark deletes them
    when the driver collects its garbage, which a driver with little to do may not for a whole stage."""
    for frame in (first, *more):
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()[:1]}:
            path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    _free_shuffles(first.sparkSession)


def _free_shuffles(spark: SparkSession) -> None:
    # Frames refer to themselves in Python too.
    gc.collect()
    spark._jvm.System.gc()


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def prefix_sum(rows: DataFrame, groups: list[str], bucket: str, order: list[Column], value: Column,
               name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one, per ``groups``.

    Rows are ordered by ``bucket`` and then by ``order``. No task orders more than one bucket: the
    bucket totals are summed up first (a row per bucket) and the rest is a window inside a bucket.
    """
    keys = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_key{i}" for i in range(len(keys))]
    totals = (rows.groupBy(*keys).agg(F.sum(value).alias("_total"))
              .withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
              .select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_before"))
    numbered = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return (numbered.join(totals, on)
            .withColumn(name, F.col("_before") + F.col("_inside"))
            .drop("_before", "_inside", *names))
