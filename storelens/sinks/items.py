"""Keyed items, the last write of a key winning.

A store holds one folder per run and batch (``run=<number>_<query>/version=<batch>``), with a folder inside for
each bucket of keys that the batch has (``bucket=<number>``). Runs are numbered as they come, so that
a new query beats an older one whatever its batch numbers. Folders are folded into a snapshot now and then, bucket
by bucket: those that no new folder has stay where an earlier snapshot wrote them. Reading takes the snapshot and
the folders after it, of all buckets or of some.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .folders import children

SNAPSHOTS = "_snapshots"
# Fixed value: buckets of a store.
BUCKETS = 32


def newest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Last row per key by ``order``; combined before the shuffle, so a busy key stays cheap."""
    others = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("_item")).select(key, "_item.*").select(*df.columns)


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def buckets_of(rows: DataFrame, key: str) -> list[int]:
    """The buckets that the keys of these rows fall in."""
    return sorted(r[0] for r in rows.filter(F.col(key).isNotNull()).select(bucket_of(key)).distinct().collect())


def _run_folder(spark: SparkSession, path: str, query: str) -> str:
    """The folder of a query: its own if it wrote before, else one with the next number."""
    runs = [name for name in children(spark, path) if name.startswith("run=")]
    own = [name for name in runs if name.endswith(f"_{query}")]
    highest = max([int(name[4:].split("_", 1)[0]) for name in runs], default=0)
    return own[0] if own else f"run={highest + 1}_{query}"


def put_items(batch: DataFrame, path: str, batch_id: int, key: str, order: list[str],
              query: str = "batch", finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Adds a batch as version ``batch_id`` of its query. Cost follows the batch, not the store.

    A record without a key is no item. ``finish`` makes what is stored of the items that are left, one
    for each key.
    """
    folder = _run_folder(batch.sparkSession, path, query)
    items = newest_per_key(batch.filter(F.col(key).isNotNull()), key, order)
    _write(finish(items) if finish else items, key, f"{path}/{folder}/version={batch_id}")


def _write(items: DataFrame, key: str, path: str) -> None:
    (items.withColumn("bucket", bucket_of(key)).repartition(BUCKETS, "bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def _buckets(spark: SparkSession, path: str) -> list[int]:
    return [int(name[7:]) for name in children(spark, path) if name.startswith("bucket=")]


def _snapshot(spark: SparkSession, path: str) -> tuple[int, list[str], dict[int, int]]:
    """Number of the newest complete snapshot, 0 if there is none; the folders it holds; and for each
    bucket the snapshot that wrote it."""
    for number in sorted(map(int, children(spark, f"{path}/{SNAPSHOTS}")), reverse=True):
        if "folded" in children(spark, f"{path}/{SNAPSHOTS}/{number}"):
            lines = [row.value.split("\t") for row in spark.read.text(f"{path}/{SNAPSHOTS}/{number}/folded").collect()]
            return number, [x[1] for x in lines if x[0] == "folder"], {int(x[1]): int(x[2]) for x in lines if x[0] == "bucket"}
    return 0, [], {}


def _folders(spark: SparkSession, path: str, before: tuple[str, int] | None) -> list[str]:
    return [f"{run}/{version}" for run in children(spark, path) if run.startswith("run=")
            for version in children(spark, f"{path}/{run}")
            if not (before and run.endswith(f"_{before[0]}") and int(version[8:]) >= before[1])]


def _rows(spark: SparkSession, path: str, held: dict[int, int], later: dict[str, list[int]],
          buckets: Iterable[int] | None) -> DataFrame | None:
    """Items of the buckets in snapshots and in later folders."""
    wanted = set(range(BUCKETS) if buckets is None else buckets)
    parts = []
    old = [f"{path}/{SNAPSHOTS}/{n}/items/bucket={b}" for b, n in held.items() if b in wanted]
    if old:
        parts.append(spark.read.parquet(*old))
    new = [f"{path}/{name}/bucket={b}" for name, own in later.items() for b in own if b in wanted]
    if new:
        parts.append(spark.read.option("basePath", path).parquet(*new).drop("bucket"))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def _newest(rows: DataFrame, key: str) -> DataFrame:
    number = F.split("run", "_")[0].cast("int").alias("number")
    ranked = rows.withColumn("_rank", F.struct(number, "run", "version"))
    return newest_per_key(ranked, key, ["_rank"]).drop("_rank")


def current_items(spark: SparkSession, path: str, key: str, before: tuple[str, int] | None = None,
                  buckets: Iterable[int] | None = None) -> DataFrame:
    """The store as of now: of each key the item of the highest run and version. ``before`` (a query
    and a batch) leaves out this batch of the query and later ones, ``buckets`` reads these only."""
    _, folded, held = _snapshot(spark, path)
    later = {name: _buckets(spark, f"{path}/{name}") for name in _folders(spark, path, before) if name not in set(folded)}
    rows = _rows(spark, path, held, later, buckets)
    if rows is None:
        raise ValueError(f"no items in {path}")
    return _newest(rows, key)


def fold_items(spark: SparkSession, path: str, key: str) -> list[int]:
    """Folds all folders into the next snapshot and returns the buckets that it has rewritten: those of folders
    that aren't folded yet. The list of folded folders is written last and makes it complete; readers don't
    touch those folders any more, and a fold that breaks off changes nothing."""
    number, folded, held = _snapshot(spark, path)
    folders = _folders(spark, path, None)
    later = {name: _buckets(spark, f"{path}/{name}") for name in folders if name not in set(folded)}
    touched = sorted({b for own in later.values() for b in own})
    rows = _rows(spark, path, held, later, touched)
    if rows is None:
        if held:
            return []
        raise ValueError(f"no items in {path}")
    base = f"{path}/{SNAPSHOTS}/{number + 1}"
    _write(_newest(rows, key), key, f"{base}/items")
    held = held | {b: number + 1 for b in touched}
    lines = [f"folder\t{name}" for name in folders] + [f"bucket\t{b}\t{n}" for b, n in sorted(held.items())]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/folded")
    return touched
