"""Projections, cleaning, record validation and envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures
from ..functions.payload import tagged_item
from ..operators import cleaning, enrichment, validation
from ..plans import marketing
from .registry import calendar, day, feeds, moment, query, rounded

_AS_OF = "2001-01-01 00:00:00"


@query(feeds(f"""SELECT transaction_id, store_id, product_id, quantity, revenue, discount_applied,
  {moment('"timestamp"')} AS transaction_time FROM pos""", "pos"))
def prj_pos_clean(spark, sf_dir):
    return cleaning.pos_clean(fixtures.pos(spark, sf_dir))


@query(feeds(f"""SELECT inventory_id, product_id, CAST(warehouse_id AS BIGINT) AS warehouse_id,
  stock_level, CAST(restock_threshold AS BIGINT) AS restock_threshold,
  {moment('last_updated')} AS last_updated_time FROM inventory""", "inventory"))
def prj_inventory_clean(spark, sf_dir):
    return cleaning.inventory_clean(fixtures.inventory(spark, sf_dir))


@query(feeds(f"""SELECT id, customer_id, interaction_type, {moment('"timestamp"')} AS event_time
FROM crm""", "crm"))
def prj_event_time(spark, sf_dir):
    crm = fixtures.crm_of(fixtures.events(spark, sf_dir))
    return cleaning.with_event_time(crm).select("id", "customer_id", "interaction_type",
                                                "event_time")


@query(feeds("""SELECT round(avg(score), 6) AS customer_engagement_score,
  '2024-02-01 00:00:00' AS kpi_date FROM crm
WHERE interaction_type IN ('Feedback', 'Complaint') AND rating IS NOT NULL""", "crm"))
def prj_kpi_stamp(spark, sf_dir):
    score = marketing.engagement_score(fixtures.crm_of(fixtures.events(spark, sf_dir)))
    return enrichment.kpi_stamp(rounded(score), "2024-02-01 00:00:00")


@query("""SELECT '2024-02-01T00:00:00.000Z' AS "timestamp",
  CASE WHEN event_id % 10 = 0 THEN 'unknown' ELSE 'r' || CAST(event_id AS VARCHAR) END
    AS "requestId", 'api-gateway' AS source, event_id AS data_id, event_type AS data_type
FROM events""")
def prj_envelope(spark, sf_dir):
    event_id = F.col("event_id")
    request = F.when(event_id % 10 != 0, F.concat(F.lit("r"), event_id.cast("string")))
    wrapped = enrichment.envelope(F.struct("event_id", "event_type"), request,
                                  "2024-02-01 00:00:00")
    return fixtures.events(spark, sf_dir).select(wrapped.alias("e")).select(
        "e.timestamp", "e.requestId", "e.source", F.col("e.data.event_id").alias("data_id"),
        F.col("e.data.event_type").alias("data_type"))


@query("""SELECT event_id, '{"id":{"N":"' || CAST(event_id AS VARCHAR) || '"},"type":'
  || CASE WHEN event_id % 5 = 0 THEN '{"NULL":true}' ELSE '{"S":"' || event_type || '"}' END
  || ',"even":{"BOOL":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
  || '},"ids":{"L":[{"N":"' || CAST(event_id AS VARCHAR) || '"},{"N":"'
  || CAST(user_id AS VARCHAR) || '"}]},"by":{"M":{"user":{"N":"' || CAST(user_id AS VARCHAR)
  || '"}}},"nested":{"M":{"type":{"S":"' || event_type || '"},"nothing":{"NULL":true}}}}' AS item
FROM events""")
def prj_tagged_values(spark, sf_dir):
    event_id = F.col("event_id")
    items = fixtures.events(spark, sf_dir).select(
        "event_id",
        event_id.alias("id"),
        F.when(event_id % 5 != 0, F.col("event_type")).alias("type"),
        (event_id % 2 == 0).alias("even"),
        F.array("event_id", "user_id").alias("ids"),
        F.create_map(F.lit("user"), F.col("user_id")).alias("by"),
        F.struct(F.col("event_type").alias("type"),
                 F.lit(None).cast("string").alias("nothing")).alias("nested"))
    fields = T.StructType(items.schema.fields[1:])
    return items.select("event_id", tagged_item(fields).alias("item"))


@query(feeds("""SELECT "recordId", result FROM validated""", "validated"))
def vld_required_fields(spark, sf_dir):
    raw = fixtures.raw_records_of(fixtures.events(spark, sf_dir))
    return validation.validate_records(raw).select("recordId", "result")


@query(feeds("""SELECT count(*) AS records, count(*) FILTER (result = 'Ok') AS valid,
  count(*) FILTER (result <> 'Ok') AS dropped FROM validated""", "validated"))
def vld_counts(spark, sf_dir):
    raw = fixtures.raw_records_of(fixtures.events(spark, sf_dir))
    return validation.result_counts(validation.validate_records(raw))


@query(feeds("""SELECT DISTINCT o_orderkey, common_column, value_column,
  strftime(date_column, '%Y-%m-%d %H:%M:%S') AS date_column FROM quality""", "quality"))
def cln_dedupe_rows(spark, sf_dir):
    return cleaning.drop_duplicate_rows(fixtures.quality_dataset(spark, sf_dir))


@query(feeds("""SELECT o_orderkey, common_column, coalesce(value_column, 0) AS value_column,
  strftime(coalesce(date_column, TIMESTAMP '1900-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S')
    AS date_column FROM quality""", "quality"))
def cln_fill_defaults(spark, sf_dir):
    return cleaning.fill_defaults(fixtures.quality_dataset(spark, sf_dir))


@query(feeds("""SELECT o_orderkey, value_column, CAST(NULL AS VARCHAR) AS common_column,
  CAST(NULL AS VARCHAR) AS date_column FROM quality""", "quality"))
def cln_require_columns(spark, sf_dir):
    partial = fixtures.quality_dataset(spark, sf_dir).select("o_orderkey", "value_column")
    return cleaning.require_columns(partial, {
        "common_column": T.StringType(), "value_column": T.DoubleType(),
        "date_column": T.TimestampType()})


@query(feeds("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN value_column END
  AS value_column, CASE WHEN o_orderkey % 5 <> 0
    THEN strftime(date_column, '%Y-%m-%d %H:%M:%S') END AS date_column FROM quality""", "quality"))
def cln_standardise_types(spark, sf_dir):
    order = F.col("o_orderkey")
    texts = fixtures.quality_dataset(spark, sf_dir).select(
        "o_orderkey",
        F.when(order % 7 == 0, "none").otherwise(F.col("value_column").cast("string"))
        .alias("value_column"),
        F.when(order % 5 == 0, "no date").otherwise(F.col("date_column").cast("string"))
        .alias("date_column"))
    return cleaning.standardise_types(texts)


@query(feeds(f"""SELECT o_orderkey, CASE WHEN year(date_column) < 1900
  OR date_column > TIMESTAMP '{_AS_OF}' THEN 'Invalid date' ELSE 'Valid' END AS date_validation
FROM quality""", "quality"))
def vld_date(spark, sf_dir):
    checked = validation.date_check(fixtures.quality_dataset(spark, sf_dir), _AS_OF)
    return checked.select("o_orderkey", "date_validation")


@query(feeds("""SELECT o_orderkey, CASE WHEN value_column < 0 OR value_column > 1000000
  THEN 'Out of range' ELSE 'Valid' END AS value_validation FROM quality""", "quality"))
def vld_value_range(spark, sf_dir):
    checked = validation.value_check(fixtures.quality_dataset(spark, sf_dir))
    return checked.select("o_orderkey", "value_validation")


@query(f"SELECT o_orderkey, {calendar('o_orderdate')} FROM orders")
def enr_date_parts(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    return enrichment.date_parts(orders, "o_orderdate").select(
        "o_orderkey", "year", "month", "day", "day_of_week")


@query("SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders")
def enr_weekend(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    return enrichment.weekend_flag(orders, "o_orderdate").select("o_orderkey", "is_weekend")


@query(f"""SELECT o_orderkey, {day('epoch(o_orderdate)')} AS o_orderdate,
  CAST(date_diff('day', (SELECT min(o_orderdate) FROM orders), o_orderdate) AS INTEGER)
    AS days_since_first_event
FROM orders""")
def win_days_since_first(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    return enrichment.days_since_first(
        orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate")),
        "o_orderdate")
