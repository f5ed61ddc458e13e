"""Start functions of the streaming queries.

Every query takes its own checkpoint folder. ``trigger`` defaults to taking all that is there and
stopping; give ``{"processingTime": "5 seconds"}`` to keep it running. Stored results bear the id of
their query, which the checkpoint keeps: a repeated batch replaces its own rows, and a query with a
new checkpoint adds to what others have stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.payload import tagged_payload
from ..operators.validation import removal_columns, result_columns, validate_records
from ..plans.marketing import marketing_kpis_of_records
from ..plans.support import clean_interactions, support_kpis_of_records
from ..schemas import CRM_REQUIRED, RESOLUTION
from ..sinks.folders import write_batch
from ..sinks.items import fold_items, put_items
from ..sinks.publish import POLL_SECONDS
from ..sources import landing
from ..sources.notifications import accepted_objects, manifest_counts, new_notices
from ..sources.records import read_records
from .state import keyed_state, with_last_seen

ONCE = {"availableNow": True}
POLLING = {"processingTime": f"{POLL_SECONDS} seconds"}
# Announced files that are read together.
ANNOUNCED_FILES = 1_000

ParseFiles = Callable[[DataFrame, StructType], DataFrame]


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query a micro-batch belongs to; it survives restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _per_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: dict | None) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or ONCE)).start())


def kpi_rows(raw: DataFrame, kpis: Callable[[DataFrame], DataFrame],
             write: Callable[[DataFrame, int, str], None], checkpoint: str,
             trigger: dict | None = None, encoded: bool = True) -> StreamingQuery:
    """A KPI row per micro-batch of JSON records; ``write`` takes the row, the batch and the query.

    What cleaning removes and what can't be decoded shows as the metric ``removals`` in the progress
    of the query, without another pass.
    """
    records = read_records(raw, encoded=encoded)
    counted = records.observe("removals", *removal_columns(records),
                              F.count_if(~F.col("decoded")).alias("undecodable"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(kpis(batch.filter("decoded")), batch_id, query_id(batch))

    return _per_batch(counted, handle, checkpoint, trigger)


def marketing(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
              as_of: dt.datetime | str | None = None, encoded: bool = True) -> StreamingQuery:
    return kpi_rows(raw, lambda records: marketing_kpis_of_records(records, as_of),
                    lambda row, batch_id, query: write_batch(row, path, batch_id, query),
                    checkpoint, trigger, encoded)


def support(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
            as_of: dt.datetime | str | None = None, encoded: bool = True) -> StreamingQuery:
    return kpi_rows(raw, lambda records: support_kpis_of_records(records, as_of),
                    lambda row, batch_id, query: write_batch(row, path, batch_id, query),
                    checkpoint, trigger, encoded)


def validate(raw: DataFrame, path: str, checkpoint: str, required: list[str] = CRM_REQUIRED,
             trigger: dict | None = None, encoded: bool = True) -> StreamingQuery:
    """Every record with its id, original payload and result, a folder per result.

    Totals show as the metric ``results`` in the progress of the query.
    """
    validated = validate_records(raw, required, encoded=encoded)
    return (validated.observe("results", *result_columns()).writeStream.format("parquet")
            .partitionBy("result").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or ONCE)).start(path))


def store_items(raw: DataFrame, path: str, checkpoint: str, key: str, order: list[str],
                trigger: dict | None = None, encoded: bool = True, fold_every: int = 16) -> StreamingQuery:
    """Every decoded record into the keyed store, with its text and all its fields as tagged values.

    Records without a key are no items; their number and that of undecodable ones show as the metric
    ``items``. Fields are tagged once the last record of each key is known. The store is folded after every
    ``fold_every`` batches, in the buckets that these have touched.
    """
    decoded = F.col("decoded")
    records = read_records(raw, encoded=encoded).observe(
        "items", F.count_if(decoded & F.col(key).isNotNull()).alias("items"),
        F.count_if(decoded & F.col(key).isNull()).alias("keyless"),
        F.count_if(~decoded).alias("undecodable"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        put_items(batch.filter("decoded").drop("decoded"), path, batch_id, key, order, query_id(batch),
                  lambda items: items.withColumn("item", tagged_payload(F.col("payload"))))
        if batch_id % fold_every == fold_every - 1:
            fold_items(batch.sparkSession, path, key)

    return _per_batch(records, handle, checkpoint, trigger)


def _ingest(files: DataFrame, schema: StructType, parse: ParseFiles, path: str, batch_id: int,
            query: str, day: dt.date | str | None) -> None:
    # Parsed once for both writes; what memory can't hold goes to the executors' disks.
    rows = parse(files, schema).persist()
    date = F.current_date() if day is None else F.lit(str(day)).cast("date")
    fits = rows.filter(F.col("reject").isNull()).select(*schema.names, date.alias("ingest_date"))
    try:
        write_batch(fits, f"{path}/rows", batch_id, query)
        write_batch(landing.rejected(rows), f"{path}/rejects", batch_id, query)
    finally:
        rows.unpersist()


def ingest_files(files: DataFrame, schema: StructType, parse: ParseFiles, path: str, checkpoint: str,
                 date: dt.date | str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """New landing files to bronze Parquet, each file exactly once: rows that fit to ``rows``, the
    others and unreadable files to ``rejects``. ``files`` is a ``landing.stream_files``."""
    return _per_batch(files, lambda batch, batch_id: _ingest(
        batch, schema, parse, path, batch_id, query_id(batch), date), checkpoint, trigger)


def ingest_announced(messages: DataFrame, rule: tuple[str, str, str], schema: StructType,
                     parse: ParseFiles, path: str, checkpoint: str,
                     locate: Callable[[str, str], str] = "s3a://{}/{}".format,
                     date: dt.date | str | None = None,
                     trigger: dict | None = None, repeats_within: str = "1 day") -> StreamingQuery:
    """New landing files to bronze as queue messages announce them, without listing the folder.

    ``rule`` is the bucket, prefix and extension to accept, ``locate`` makes a path of bucket and
    key. A notice that came before, up to ``repeats_within`` ago, is left out, whichever batch it comes in; one
    with another version of the object isn't. Names come to the driver ``ANNOUNCED_FILES`` at a time. A file
    that isn't there is a reject and doesn't stop the others. A repeated batch replaces its own folders.
    ``counts`` has a row per batch with the objects that were taken and those that failed.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        session, query = batch.sparkSession, query_id(batch)
        # Stored once: reading the state again for each use would cost as much as the batch.
        write_batch(batch, f"{path}/notices", batch_id, query)
        manifest = session.read.schema(batch.schema).parquet(f"{path}/notices/query={query}/batch_id={batch_id}")
        names = accepted_objects(manifest, *rule).select("bucket", "key").distinct().orderBy("bucket", "key")
        found = names.toLocalIterator()
        missing = part = 0
        while some := [locate(n.bucket, n.key) for n in islice(found, ANNOUNCED_FILES)]:
            there = [name for name in some if _exists(session, name)]
            absent = [(name, None, None, "missing file") for name in some if name not in set(there)]
            missing += len(absent)
            if there:
                _ingest(landing.files(session, there, "*"), schema, parse, f"{path}/part={part}",
                        batch_id, query, date)
            lost = session.createDataFrame(absent, "path string, line bigint, text string, reject string")
            write_batch(lost, f"{path}/part={part}/missing", batch_id, query)
            part += 1
        counts = manifest_counts(manifest, *rule)
        counts = counts.select((F.col("processed") - missing).alias("processed"),
                               (F.col("failed") + missing).alias("failed"))
        write_batch(counts, f"{path}/counts", batch_id, query)

    return _per_batch(new_notices(messages, repeats_within), handle, checkpoint, trigger)


def _exists(spark: SparkSession, path: str) -> bool:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name)


def announced_rows(spark: SparkSession, path: str) -> DataFrame:
    """What ``ingest_announced`` has stored."""
    return spark.read.option("basePath", path).parquet(f"{path}/part=*/rows")


def resolutions(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                encoded: bool = True, ttl_ms: int | None = None, initial: DataFrame | None = None) -> StreamingQuery:
    """Resolutions with the time of the customer's previous interaction, whichever batch that came in.

    The last interaction of each customer is kept in the state of the query (see ``with_last_seen``); no
    batch reads what others have stored. Interactions that come after later ones are marked as ``late``.
    """
    rows = clean_interactions(read_records(raw, encoded=encoded).filter("decoded")).select(
        F.col("customer_id").cast("string").alias("customer_id"), "id", "interaction_type", "timestamp")
    seen = with_last_seen(rows, ttl_ms, initial)

    def handle(batch: DataFrame, batch_id: int) -> None:
        found = batch.filter(F.col("interaction_type") == RESOLUTION).drop("interaction_type")
        write_batch(found, f"{path}/resolutions", batch_id, query_id(batch))

    with keyed_state(raw.sparkSession):
        return _per_batch(seen, handle, checkpoint, trigger)


def windowed_support(raw: DataFrame, path: str, checkpoint: str, width: str = "1 day",
                     delay: str = "1 hour", trigger: dict | None = None,
                     encoded: bool = True) -> StreamingQuery:
    """Support KPIs per tumbling window of event time and type: volume and average rating. A window is
    written once, when the watermark passes its end."""
    records = read_records(raw, encoded=encoded)
    rows = clean_interactions(records.filter("decoded"))
    timed = rows.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", delay)
    kpis = timed.groupBy(F.window("event_time", width), "interaction_type").agg(
        F.count("*").alias("volume"), F.avg("rating").alias("feedback_score"))
    return (kpis.select(F.col("window.start").alias("window_start"), "interaction_type", "volume", "feedback_score")
            .writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or ONCE)).start(path))
