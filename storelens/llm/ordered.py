"""Numbers and digests of rows in the order of a key, however many rows a key has."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Bytes that a digest takes in at once; they decide cost, not results.
_PIECE_BYTES = 1 << 20


def _ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows dealt to tasks by ranges of ``order`` (nulls first) and sorted inside. Equal rows are parted by
    a number of their own, so that no task gets all copies of a row."""
    spread = rows.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    by = [*[F.col(c).asc_nulls_first() for c in order], F.col("_spread")]
    return spread.repartitionByRange(*by).sortWithinPartitions(*by).drop("_spread")


def _schema(rows: DataFrame, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + list(more))


def numbered(rows: DataFrame, key: str, order: list[str], name: str = "at") -> DataFrame:
    """``rows``, stored, with ``name``: the number of the row among those of its ``key``, from 0, by ``order``
    (nulls first; rows that are equal in it follow each other in any order).

    Every task numbers a range of keys. Where a range begins inside a key, what earlier tasks hold of
    it is added; there is one such key a task at most.
    """
    at = rows.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            numbers = []
            for value in batch.column(at).to_pylist():
                n = n + 1 if value == last else 0
                last = value
                numbers.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())],
                names=[*batch.schema.names, "_part", name])

    placed = stored(_ranged(rows, [key, *order]).mapInArrow(run, _schema(rows, "_part int", f"{name} long")), "numbered")
    before = Window.partitionBy("_key").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    carried = (placed.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_in")).agg(F.count("*").alias("_n"))
               .withColumn("_before", F.sum("_n").over(before)).filter(F.col("_before") > 0).drop("_n"))
    same = (F.col("_part") == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key"))
    # As many rows as tasks at most.
    return (placed.join(F.broadcast(carried), same, "left")
            .select(*rows.columns, (F.col(name) + F.coalesce("_before", F.lit(0))).alias(name)))


def prefix_xor(rows: DataFrame, key: str, order: str, values: dict[str, str], width: int = 1024) -> DataFrame:
    """Adds, per name and column of ``values``, the exclusive or of the rows before this one of the same
    ``key``, by ``order`` (whole numbers from 0). No task orders more than ``width`` rows of a key, or a
    row for each ``width`` of them."""
    bucketed = rows.withColumn("_bucket", F.floor(F.col(order) / width))
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(key, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def over(column: Column, window: Window) -> Column:
        return F.coalesce(F.bit_xor(column).over(window), F.lit(0))

    totals = (bucketed.groupBy(F.col(key).alias("_key"), F.col("_bucket").alias("_of"))
              .agg(*[F.bit_xor(c).alias(f"_sum_{n}") for n, c in values.items()])
              .select("_key", "_of", *[over(F.col(f"_sum_{n}"), before).alias(f"_before_{n}") for n in values]))
    numbered_ = bucketed.select("*", *[over(F.col(c), inside).alias(f"_inside_{n}") for n, c in values.items()])
    joined = numbered_.join(totals, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_of")))
    return joined.select(*rows.columns, *[
        F.col(f"_before_{n}").bitwiseXOR(F.col(f"_inside_{n}")).alias(n) for n in values])


def pieces(rows: DataFrame, keys: list[str], order: list[str], data: str, separator: bytes) -> DataFrame:
    """``data`` (binary) of rows with equal ``keys``, joined by ``separator`` into pieces of bounded size:
    ``keys, part, no, data``, the pieces in the order of ``part, no`` being the rows in that of ``order``."""
    chosen = rows.select(*keys, *order, data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, key, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        out: list[tuple] = []
        for batch in batches:
            for *own, value in zip(*[batch.column(i).to_pylist() for i in range(len(keys))],
                                   batch.column(len(keys) + len(order)).to_pylist()):
                if held and (own != key or size > _PIECE_BYTES):
                    out.append((*key, part, no, separator.join(held)))
                    no, held, size = no + 1, [], 0
                key = own
                held.append(value)
                size += len(value)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip((*key, part, no, separator.join(held)), kinds)], names)

    names = [*keys, "part", "no", "data"]
    kinds = [*[_arrow(dict(chosen.dtypes)[k]) for k in keys], pa.int32(), pa.int64(), pa.binary()]
    return _ranged(chosen, [*keys, *order]).mapInArrow(run, _schema(rows.select(*keys), "part int", "no long", "data binary"))


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def sha256_of(parts: DataFrame, keys: list[str], order: list[str], data: str, separator: bytes) -> DataFrame:
    """``keys, sha256``: the digest of the pieces of each key in ``order``, joined by ``separator``. Null
    pieces are left out. A digest is taken piece by piece; nothing of a key is held."""
    chosen = parts.filter(F.col(data).isNotNull()).select(*keys, *order, data)
    names, kinds = [*keys, "sha256"], [*[_arrow(dict(parts.dtypes)[k]) for k in keys], pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(keys))]
            for *own, value in zip(*columns, batch.column(batch.num_columns - 1)):
                if digest is not None and own == key:
                    digest.update(separator)
                else:
                    if digest is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(value.as_py())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*key, digest.hexdigest()), kinds)], names)

    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    return (chosen.repartition(*keys).sortWithinPartitions(*by)
            .mapInArrow(run, _schema(parts.select(*keys), "sha256 string")))
