"""Streaming queries, run to the end of the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..plans.marketing import cross_kpis
from ..schemas import POS
from ..session import work_dir
from ..sinks import items, publish
from ..sources import landing
from ..sources.records import parse_records, read_records
from ..streaming import metrics
from ..streaming import queries as streaming
from . import support as support_queries
from .registry import feeds, query, rounded
from .sources import _POS, stage_csv

_AS_OF = "2024-02-01 00:00:00"
_SESSIONS = """SELECT session_id, max("timestamp") - min("timestamp") AS span, count(*) AS n
  FROM records WHERE session_id IS NOT NULL GROUP BY session_id"""


def _stream(spark, sf_dir):
    return fixtures.stream_records_of(fixtures.events_stream(spark, sf_dir))


def _folders(spark, name: str) -> tuple[str, str]:
    base = work_dir(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


@query(feeds("""SELECT id, session_id, customer_id, interaction_type, rating, "timestamp"
FROM records""", "records"))
def src_stream_json(spark, sf_dir):
    path, checkpoint = _folders(spark, "records")
    (parse_records(_stream(spark, sf_dir)).writeStream.format("parquet")
     .option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start(path).awaitTermination())
    return spark.read.parquet(path)


@query(feeds(f"""SELECT
  (SELECT round(coalesce(avg(score), 0), 6) FROM records WHERE customer_id IS NOT NULL
    AND customer_id <> '0' AND interaction_type IN ('Feedback', 'Complaint')
    AND rating IS NOT NULL) AS customer_engagement_score,
  (SELECT round(avg(span), 6) FROM ({_SESSIONS})) AS avg_session_duration,
  (SELECT round(100 * count(*) FILTER (n = 1) / count(*), 6) FROM ({_SESSIONS}))
    AS bounce_rate_percent,
  (SELECT round(100 * count(*) FILTER (interaction_type = 'Loyalty') / count(*), 6) FROM records
    WHERE customer_id IS NOT NULL AND customer_id <> '0') AS loyalty_activity_rate_percent,
  '{_AS_OF}' AS kpi_date""", "records"))
def st_marketing_kpis(spark, sf_dir):
    path, checkpoint = _folders(spark, "marketing")
    streaming.marketing(_stream(spark, sf_dir), path, checkpoint, as_of=_AS_OF).awaitTermination()
    return rounded(spark.read.parquet(path).drop("query", "batch_id"))


@query(feeds(f"SELECT *, '{_AS_OF}' AS kpi_date FROM ({support_queries.STREAM_MART})",
             "records", "cleaned"))
def st_support_kpis(spark, sf_dir):
    path, checkpoint = _folders(spark, "support")
    streaming.support(_stream(spark, sf_dir), path, checkpoint, as_of=_AS_OF).awaitTermination()
    return rounded(spark.read.parquet(path).drop("query", "batch_id"))


@query(feeds("""SELECT "recordId", result FROM validated""", "validated"))
def st_validate(spark, sf_dir):
    path, checkpoint = _folders(spark, "validated")
    raw = fixtures.raw_records_of(fixtures.events_stream(spark, sf_dir))
    streaming.validate(raw, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("recordId", "result")


@query(feeds("""SELECT 'results' AS name, 'records' AS metric, count(*) AS value FROM validated
UNION ALL SELECT 'results', 'valid', count(*) FILTER (result = 'Ok') FROM validated
UNION ALL SELECT 'results', 'dropped', count(*) FILTER (result <> 'Ok') FROM validated""", "validated"))
def st_validate_counts(spark, sf_dir):
    """What a stream has counted, from the rows that its reports are stored as."""
    path, checkpoint = _folders(spark, "counted")
    listener = metrics.MetricRows(spark, f"{path}/counts")
    spark.streams.addListener(listener)
    try:
        raw = fixtures.raw_records_of(fixtures.events_stream(spark, sf_dir))
        listener.finish(streaming.validate(raw, f"{path}/records", checkpoint))
    finally:
        spark.streams.removeListener(listener)
    counts = metrics.stored_counts(spark, f"{path}/counts")
    return counts.groupBy("name", "metric").agg(F.sum("value").alias("value"))


@query(feeds("""SELECT customer_id, arg_max(id, struct_pack(t := "timestamp", i := id)) AS id,
  arg_max(interaction_type, struct_pack(t := "timestamp", i := id)) AS interaction_type,
  '{"N":"' || arg_max(id, struct_pack(t := "timestamp", i := id)) || '"}' AS id_tag,
  '{"S":"' || arg_max(interaction_type, struct_pack(t := "timestamp", i := id)) || '"}' AS type_tag,
  CASE WHEN CAST(arg_max(id, struct_pack(t := "timestamp", i := id)) AS BIGINT) % 61 = 0
    THEN '{"S":"web"}' END AS channel_tag
FROM records WHERE customer_id IS NOT NULL GROUP BY customer_id""", "records"))
def st_item_store(spark, sf_dir):
    path, checkpoint = _folders(spark, "items")
    streaming.store_items(_stream(spark, sf_dir), path, checkpoint, "customer_id",
                          ["timestamp", "id"]).awaitTermination()
    items.fold_items(spark, path, "customer_id")
    return items.current_items(spark, path, "customer_id").select(
        "customer_id", "id", "interaction_type", *[
            F.get_json_object("item", f"$.{field}").alias(name) for field, name in
            (("id", "id_tag"), ("interaction_type", "type_tag"), ("channel", "channel_tag"))])


@query(feeds(f"SELECT *, '2024-02-01' AS ingest_date FROM ({_POS})", "pos"))
def st_file_ingest(spark, sf_dir):
    path, checkpoint = _folders(spark, "bronze-pos")
    files = landing.stream_files(spark, stage_csv(spark, sf_dir), landing.CSV_GLOB)
    streaming.ingest_files(files, POS, landing.parse_csv, path, checkpoint, "2024-02-01").awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("query", "batch_id")


def _announced(spark, sf_dir) -> str:
    """The POS feed ingested from messages: one per landed file as the bucket would send it, one of a
    file that never came and one that is no message."""
    landed = stage_csv(spark, sf_dir)
    base, out, checkpoint = work_dir(spark, "messages"), *_folders(spark, "announced-pos")
    name = F.url_encode(F.regexp_extract("path", "[^/]+/[^/]+$", 0))

    def body(name):
        return F.concat(F.lit('{"Records":[{"s3":{"bucket":{"name":"landing"},"object":{"key":"pos/'),
                        name, F.lit('"}}}]}')).alias("body")

    files = landing.files(spark, landed, landing.CSV_GLOB)
    lost = spark.range(1).select(body(F.lit("never-came.csv")))
    other = spark.range(1).select(F.lit("no json").alias("body"))
    files.select(body(name)).union(lost).union(other).write.parquet(base)
    messages = spark.readStream.schema("body string").parquet(base)
    streaming.ingest_announced(
        messages, ("landing", "pos/", ".csv"), POS, landing.parse_csv, out, checkpoint,
        lambda _, key: f"{landed}/{key.removeprefix('pos/')}", "2024-02-01").awaitTermination()
    return out


@query(feeds(f"SELECT *, '2024-02-01' AS ingest_date FROM ({_POS})", "pos"))
def st_file_ingest_announced(spark, sf_dir):
    rows = streaming.announced_rows(spark, _announced(spark, sf_dir))
    return rows.drop("part", "query", "batch_id")


@query(feeds("""SELECT count(*) AS landed, CAST(1 AS BIGINT) AS missing, CAST(2 AS BIGINT) AS failed
FROM pos""", "pos"))
def st_file_ingest_counts(spark, sf_dir):
    """Rows ingested, announced files that never came, and all objects that failed."""
    out = _announced(spark, sf_dir)
    counts = spark.read.parquet(f"{out}/counts").agg(F.sum("failed").alias("failed"))
    missing = spark.read.option("basePath", out).parquet(f"{out}/part=*/missing")
    landed = streaming.announced_rows(spark, out).agg(F.count("*").alias("landed"))
    return cross_kpis(landed, missing.agg(F.count("*").alias("missing")), counts)


@query(feeds("""SELECT id AS "key", id, customer_id, interaction_type, rating,
  CASE WHEN CAST(id AS BIGINT) % 61 = 0 THEN 'web' END AS channel FROM records""", "records"))
def snk_stream_publish(spark, sf_dir):
    path, checkpoint = _folders(spark, "published")
    keyed = publish.payload_messages(read_records(_stream(spark, sf_dir)))
    publish.publish(keyed, path, checkpoint, trigger=streaming.ONCE).awaitTermination()
    sent = spark.read.schema("key string, value string").json(path)
    whole = "id string, customer_id string, interaction_type string, rating string, channel string"
    fields = sent.select("key", F.from_json("value", whole).alias("r")).select("key", "r.*")
    return fields.withColumn("customer_id", F.regexp_replace("customer_id", r"\.0$", ""))


@query(feeds("""SELECT id, customer_id, "timestamp", prev_timestamp FROM (
  SELECT *, lag("timestamp") OVER (PARTITION BY customer_id ORDER BY "timestamp", id) AS prev_timestamp
  FROM cleaned) WHERE interaction_type = 'Resolution'""", "records", "cleaned"))
def st_ext_prev_interaction(spark, sf_dir):
    """Four deliveries by time, each a folder of its own and one micro-batch; customers carry over from
    one to the next."""
    base, (path, checkpoint) = work_dir(spark, "ordered"), _folders(spark, "resolutions")
    events, time = fixtures.events(spark, sf_dir), fixtures.epoch_of("ts")
    first, last = events.agg(F.min(time), F.max(time)).first()
    step = (last - first) / 4 if last is not None else 0
    # Events without a time come with the last.
    part = F.coalesce(*[F.when(time < first + step * (i + 1), F.lit(i)) for i in range(3) if step], F.lit(3))
    for i in range(4):
        fixtures.stream_records_of(events.filter(part == i)).write.parquet(f"{base}/d{i}")
        raw = (spark.readStream.schema("recordId string, data string")
               .option("recursiveFileLookup", True).parquet(base))
        streaming.resolutions(raw, path, checkpoint).awaitTermination()
    return spark.read.parquet(f"{path}/resolutions").drop("query", "batch_id", "late")


@query(feeds("""SELECT strftime(date_trunc('day', make_timestamp(CAST(floor("timestamp") * 1000000 AS BIGINT))),
    '%Y-%m-%d %H:%M:%S') AS window_start, interaction_type, count(*) AS volume,
  round(avg(rating), 6) AS feedback_score
FROM cleaned WHERE "timestamp" < (SELECT epoch(date_trunc('day', make_timestamp(
    CAST(floor(max("timestamp")) * 1000000 AS BIGINT) - 3600000000))) FROM cleaned)
GROUP BY ALL""", "records", "cleaned"))
def st_ext_windowed_support(spark, sf_dir):
    """Windows that the watermark has passed: all days but the last."""
    path, checkpoint = _folders(spark, "windows")
    streaming.windowed_support(_stream(spark, sf_dir), path, checkpoint).awaitTermination()
    return rounded(spark.read.parquet(path))


@query(feeds("SELECT count(*) AS records, 0 AS oversized FROM records", "records"))
def st_microbatch_limits(spark, sf_dir):
    path, checkpoint = _folders(spark, "limited")
    sends = publish.requests(publish.payload_messages(read_records(_stream(spark, sf_dir))))
    publish.publish(sends, path, checkpoint, "parquet", streaming.ONCE).awaitTermination()
    size = F.size("entries")
    return spark.read.parquet(path).agg(
        F.sum(size).alias("records"),
        F.count_if(size > publish.BATCH_RECORDS).cast("int").alias("oversized"))
