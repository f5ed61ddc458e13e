"""Time of the previous row of the same key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seconds of a slice. One task orders the different instants of a key inside a slice.
SLICE = 3600.0
_LAST_SLICE = (1 << 63) - 1


def with_previous(df: DataFrame, key: str = "customer_id", time: str = "timestamp",
                  ties: tuple[str, ...] = ("id",), name: str = "prev_timestamp",
                  width: float = SLICE) -> DataFrame:
    """Adds ``name``: ``time`` of the row before, per ``key``, ordered by ``time`` then ``ties``.

    A null key is a key like others. Of the rows of one instant only the first looks back to an
    earlier one, the others have each other's time. So copies of a row are counted, the rows of an
    instant reduced to their first one, and only instants are ordered (see ``previous_instant``):
    no task holds all rows of a key, of an instant or of a repeated row.
    """
    ordered = [t for t in ties if t in df.columns]
    others = [c for c in df.columns if c not in (key, time, *ordered)]
    row = F.struct(*ordered, *others, "_copies")
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    instants = copies.groupBy(key, time).agg(F.min(row).alias("_row"))
    looked = previous_instant(instants, key, time, [], "_previous", width).select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.col("_row").alias("_first"),
        "_previous")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(time).eqNullSafe(F.col("_time"))
    first = row.eqNullSafe(F.col("_first")) & (F.col("_nth") == 1)
    return (copies.join(looked, same)
            .withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
            .select(*df.columns, F.when(first, F.col("_previous")).otherwise(F.col(time)).alias(name)))


def previous_instant(rows: DataFrame, key: str, time: str, ties: list[str], name: str,
                     width: float = SLICE) -> DataFrame:
    """Adds ``name``: ``time`` of the row before, per ``key``, for rows already reduced to a few per
    key and instant.

    Rows are ordered inside slices of ``width`` seconds. The first row of a slice takes the last time
    of the slice before it, from a table with one row per key and slice. That table is made of whole
    rows, so that both sides share one shuffle of the input.
    """
    others = [c for c in rows.columns if c not in (key, time)]
    sliced = rows.select(F.col(key), _slice(F.col(time), width).alias("_slice"),
                         F.struct(time, *others).alias("_of"))
    last = F.max("_of")[time]
    edges = (sliced.groupBy(F.col(key).alias("_edge_key"), F.col("_slice").alias("_edge")).agg(last.alias("_last"))
             .withColumn("_before", F.lag("_last").over(Window.partitionBy("_edge_key").orderBy("_edge")))
             .drop("_last"))
    inside = Window.partitionBy(key, "_slice").orderBy(F.col(f"_of.{time}"), *[F.col(f"_of.{t}") for t in ties])
    same = F.col(key).eqNullSafe(F.col("_edge_key")) & F.col("_slice").eqNullSafe(F.col("_edge"))
    before = F.coalesce(F.col("_inside"), F.col("_before"))
    return (sliced.withColumn("_inside", F.lag(f"_of.{time}").over(inside))
            .join(edges, same)
            .select(*[F.col(c) if c == key else F.col(f"_of.{c}").alias(c) for c in rows.columns],
                    before.alias(name)))


def _slice(time: Column, width: float) -> Column:
    """Number of the slice: null before all others, what is no number after all others."""
    seconds = time.cast("double")
    return F.when(F.isnan(seconds), F.lit(_LAST_SLICE)).otherwise(F.floor(seconds / F.lit(width)))
