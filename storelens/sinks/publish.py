"""Records as keyed JSON messages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Records per send and seconds between polls.
BATCH_RECORDS, POLL_SECONDS = 200, 5


def messages(df: DataFrame, id_column: str = "id") -> DataFrame:
    """``key`` and ``value``: the JSON text, keyed by id or else by a stable hash of the text."""
    value = F.to_json(F.struct(*df.columns))
    key = F.xxhash64(value).cast("string")
    if id_column in df.columns:
        key = F.coalesce(F.col(id_column).cast("string"), key)
    return df.select(key.alias("key"), value.alias("value"))


def payload_messages(records: DataFrame, id_column: str = "id") -> DataFrame:
    """``key`` and ``value`` of decoded records (``sources.records.read_records``): the whole payload,
    with fields this library doesn't know, keyed by its id or else by a stable hash."""
    key = F.coalesce(F.col(id_column).cast("string"), F.xxhash64("payload").cast("string"))
    return records.filter("decoded").select(key.alias("key"), F.col("payload").alias("value"))


def requests(keyed: DataFrame, size: int = BATCH_RECORDS) -> DataFrame:
    """Messages packed into sends of at most ``size`` records, one row per send.

    Packing happens inside each task on Arrow batches, without a shuffle.
    """
    def pack(batches):
        for batch in batches:
            ends = [*range(0, batch.num_rows, size), batch.num_rows]
            entries = pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)
            sends = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
            yield pa.RecordBatch.from_arrays([sends], names=["entries"])

    return keyed.mapInArrow(pack, "entries array<struct<key:string,value:string>>")


def publish(stream: DataFrame, target: str, checkpoint: str, sink: str = "json",
            trigger: dict | None = None, **options: str):
    """Streams messages to files or, by configuration, to a topic (``sink="kafka"``).

    Offsets are kept in the checkpoint: a failed send is repeated, not lost.
    """
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": f"{POLL_SECONDS} seconds"}))
    if sink == "kafka":
        return writer.format("kafka").option("topic", target).options(**options).start()
    return writer.format(sink).options(**options).start(target)
