"""Scans: catalog tables, Parquet, landing files, notifications, record payloads."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixtures
from ..operators.filters import valid_event_date
from ..schemas import INVENTORY, POS
from ..session import work_dir
from ..sinks import catalog
from ..sources import landing, notifications, records, tables
from .registry import feeds, query

# Rows of one JSON landing document.
_DOCUMENT_ROWS = 50_000

_POS = """SELECT transaction_id, store_id, product_id, quantity, revenue, discount_applied,
  "timestamp" FROM pos"""
_INVENTORY = """SELECT inventory_id, product_id, warehouse_id, stock_level, restock_threshold,
  last_updated FROM inventory"""
_RULE = ("landing", "pos/", ".csv")
_ACCEPTED = """SELECT message_id, 'landing' AS bucket, 'pos/' || name || '.csv' AS "key"
  FROM notices WHERE kind = 10
UNION ALL SELECT message_id, 'landing', 'pos/' || name || '.CSV' FROM notices WHERE kind = 4
UNION ALL SELECT message_id, 'landing', 'pos/day one ' || name || '.csv' FROM notices
  WHERE kind = 6
UNION ALL SELECT message_id, 'landing', 'pos/a' || name || '.csv' FROM notices WHERE kind = 7
UNION ALL SELECT message_id, 'landing', 'pos/b' || name || '.csv' FROM notices WHERE kind = 7"""


@contextlib.contextmanager
def named(df: DataFrame) -> Iterator[str]:
    """A name for ``df`` that no other view of the session has, for the time of the block."""
    name = f"storelens_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def stage_csv(spark, sf_dir) -> str:
    """The POS feed as CSV landing files of all kinds: columns in another order, one more or one less,
    whole numbers as decimals, quoted cells with line breaks."""
    path = work_dir(spark, "landing-pos")
    rows, line = fixtures.pos(spark, sf_dir), F.xxhash64("transaction_id") % 3

    def write(some: DataFrame, folder: str, **options: str) -> None:
        some.write.option("header", True).options(**options).csv(f"{path}/{folder}")

    write(rows.filter(line == 0), "plain")
    more = rows.filter(line > 0).withColumn("note", F.lit('said "no",\nthen yes'))
    write(more.select("note", *reversed(rows.columns)), "more", escape='"')
    write(rows.filter(line < 0).withColumn("quantity", F.concat(F.col("quantity").cast("string"), F.lit(".0"))), "decimal")
    return path


def stage_json(spark, sf_dir) -> str:
    """The inventory feed as JSON landing files, each one array of bounded length."""
    path = work_dir(spark, "landing-inventory")
    document = F.floor(F.monotonically_increasing_id() / _DOCUMENT_ROWS).alias("document")
    rows = fixtures.inventory(spark, sf_dir)
    documents = (rows.select(document, F.struct(*rows.columns).alias("row"))
                 .groupBy("document").agg(F.to_json(F.collect_list("row")).alias("value")))
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query(feeds(_POS, "pos"))
def src_catalog_table(spark, sf_dir):
    with named(fixtures.pos(spark, sf_dir)) as bronze_pos:
        return tables.read_table(spark, bronze_pos)


@query(feeds(_POS, "pos"))
def src_catalog_partitions(spark, sf_dir):
    """Two runs of a catalog table, an older one without discounts; the last one is read."""
    rows, database = fixtures.pos(spark, sf_dir), f"storelens_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{work_dir(spark, 'bronze')}'")
    catalog.write_run(rows.filter(F.col("discount_applied") == 0), "pos", database, "2024-01-01_00-00-00")
    catalog.write_run(rows, "pos", database, "2024-01-02_00-00-00")
    return tables.read_latest_run(spark, "pos", database).drop(tables.RUN)


@query(feeds(_POS, "pos"))
def src_parquet_typed(spark, sf_dir):
    path = work_dir(spark, "silver-pos")
    fixtures.pos(spark, sf_dir).write.parquet(path)
    return valid_event_date(tables.read_parquet(spark, path, POS), "timestamp")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value,
  props FROM events""")
def src_parquet_inferred(spark, sf_dir):
    return tables.read_parquet(spark, f"{sf_dir}/events.parquet")


@query(feeds(_POS, "pos"))
def src_csv_landing(spark, sf_dir):
    return landing.read_csv(spark, stage_csv(spark, sf_dir), POS)


@query(feeds(_INVENTORY, "inventory"))
def src_json_landing(spark, sf_dir):
    return landing.read_json(spark, stage_json(spark, sf_dir), INVENTORY, glob="*.txt")


@query(feeds("""SELECT message_id, CASE WHEN kind = 0 THEN 'test event'
    WHEN kind IN (1, 9) THEN 'bad message' ELSE 'bad entry' END AS outcome,
  CAST(NULL AS VARCHAR) AS bucket, CAST(NULL AS VARCHAR) AS "key"
FROM notices WHERE kind IN (0, 1, 8, 9)
UNION ALL SELECT message_id, 'object', 'other', 'pos/' || name || '.csv' FROM notices
  WHERE kind = 2
UNION ALL SELECT message_id, 'object', 'landing', 'inventory/' || name || '.csv' FROM notices
  WHERE kind = 3
UNION ALL SELECT message_id, 'object', 'landing', 'pos/' || name || '.txt' FROM notices
  WHERE kind = 5
UNION ALL SELECT message_id, 'object', bucket, "key" FROM (""" + _ACCEPTED + ")", "notices"))
def src_object_manifest(spark, sf_dir):
    return notifications.object_manifest(fixtures.notifications(spark, sf_dir))


@query(feeds(_ACCEPTED, "notices"))
def src_object_filter(spark, sf_dir):
    manifest = notifications.object_manifest(fixtures.notifications(spark, sf_dir))
    return notifications.accepted_objects(manifest, *_RULE).select("message_id", "bucket", "key")


@query(feeds("""SELECT CAST(sum(CASE kind WHEN 7 THEN 2 WHEN 4 THEN 1 WHEN 6 THEN 1 WHEN 10 THEN 1
    ELSE 0 END) AS BIGINT) AS processed,
  count(*) FILTER (kind IN (1, 2, 3, 5, 8, 9)) AS failed FROM notices""", "notices"))
def src_object_counts(spark, sf_dir):
    manifest = notifications.object_manifest(fixtures.notifications(spark, sf_dir))
    return notifications.manifest_counts(manifest, *_RULE)


@query("""SELECT event_id, event_id AS id, event_type AS kind FROM events WHERE event_id % 3 <> 2
UNION ALL SELECT event_id, user_id, 'second' FROM events WHERE event_id % 3 = 1""")
def src_scalar_or_array(spark, sf_dir):
    event_id = F.col("event_id")
    one = F.to_json(F.struct(event_id.alias("id"), F.col("event_type").alias("kind")))
    two = F.to_json(F.struct(F.col("user_id").alias("id"), F.lit("second").alias("kind")))
    payload = (F.when(event_id % 3 == 0, one)
               .when(event_id % 3 == 1, F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")))
               .otherwise("{bad"))
    raw = fixtures.events(spark, sf_dir).select("event_id", payload.alias("payload"))
    schema = "struct<id:bigint,kind:string>"
    return records.explode_payload(raw, schema, F.col("payload"), keep=["event_id"])
