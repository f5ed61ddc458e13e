"""Registration of queries and the feed definitions their SQL shares."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""
    def register(run: Run) -> Run:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return portable(run(spark, sf_dir))
        REGISTRY[run.__name__] = Query(prepared, sql)
        return run
    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that no engine's own rendering matters."""
    seconds = "yyyy-MM-dd HH:mm:ss"
    formats = {"date": "yyyy-MM-dd", "timestamp": seconds, "timestamp_ntz": seconds}
    texts = {name: F.date_format(name, formats[kind]) for name, kind in df.dtypes
             if kind in formats}
    return df.withColumns(texts) if texts else df


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: the order of a distributed sum is not fixed."""
    doubles = {name: F.round(name, digits) for name, kind in df.dtypes if kind == "double"}
    return df.withColumns(doubles)


def day(column: str) -> str:
    return (f"CAST(CAST(make_timestamp(CAST(floor({column}) * 1000000 AS BIGINT)) AS DATE)"
            " AS VARCHAR)")


def moment(column: str) -> str:
    return (f"strftime(make_timestamp(CAST(floor({column}) * 1000000 AS BIGINT)),"
            " '%Y-%m-%d %H:%M:%S')")


def calendar(column: str) -> str:
    """Date parts, numbered as Spark does (Sunday is 1)."""
    return (f'CAST(year({column}) AS INTEGER) AS "year", CAST(month({column}) AS INTEGER) AS '
            f'"month", CAST(day({column}) AS INTEGER) AS "day", '
            f"CAST(dayofweek({column}) + 1 AS INTEGER) AS day_of_week")


def feeds(sql: str, *names: str) -> str:
    """``sql`` after the definitions of the feeds it names."""
    return "WITH " + ",\n".join(FEEDS[name] for name in names) + "\n" + sql


_SESSION = ("CASE WHEN event_id % 41 <> 0 THEN concat('s', CAST(user_id AS VARCHAR), '-', "
            "CAST(CAST(ts AS DATE) AS VARCHAR)) END")
_CUSTOMER = "CASE WHEN event_id % 37 <> 0 THEN user_id END"
_TYPE = ("CASE event_type WHEN 'click' THEN 'Feedback' WHEN 'error' THEN 'Complaint' "
         "WHEN 'purchase' THEN 'Loyalty' WHEN 'signup' THEN 'Inquiry' "
         "WHEN 'view' THEN 'Resolution' END")
_RATING = ("CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 'n/a' "
           "ELSE CAST(event_id % 7 AS VARCHAR) END")

FEEDS = {
    "pos": f"""pos AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         l_suppkey % 10 AS store_id,
         CASE WHEN l_partkey % 17 = 0 THEN l_partkey + 10000000 ELSE l_partkey END AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS revenue,
         l_discount AS discount_applied, epoch(l_shipdate) AS "timestamp",
         {day('epoch(l_shipdate)')} AS "date"
  FROM lineitem)""",
    "inventory": f"""inventory0 AS (
  SELECT l_orderkey * 10 + l_linenumber AS inventory_id,
         CASE WHEN l_partkey % 13 = 0 THEN l_partkey + 20000000 ELSE l_partkey END AS product_id,
         CAST(l_suppkey % 5 AS INTEGER) AS warehouse_id,
         (l_orderkey * 7 + l_linenumber * 13) % 40 AS stock_level,
         CASE WHEN p_size % 11 <> 0 THEN CAST(p_size % 20 AS DOUBLE) END AS restock_threshold,
         epoch(l_shipdate) + l_linenumber * 3600
           + CASE WHEN l_orderkey % 9 = 0 THEN 86400 ELSE 0 END AS last_updated
  FROM lineitem JOIN part ON l_partkey = p_partkey),
inventory AS (SELECT *, {day('last_updated')} AS "date" FROM inventory0)""",
    "web": f"""web AS (
  SELECT {_SESSION} AS session_id, user_id, event_type AS page, epoch(ts) AS "timestamp"
  FROM events)""",
    "crm": f"""crm AS (
  SELECT event_id AS id, {_CUSTOMER} AS customer_id, {_TYPE} AS interaction_type,
         {_RATING} AS rating, TRY_CAST({_RATING} AS DOUBLE) AS score, epoch(ts) AS "timestamp"
  FROM events)""",
    # Records of the stream that can be decoded; their ids are texts.
    "records": f"""records AS (
  SELECT CAST(event_id AS VARCHAR) AS id, {_SESSION} AS session_id, CASE WHEN event_id % 43 = 0
           THEN 'C' ELSE '' END || CAST({_CUSTOMER} AS VARCHAR) AS customer_id,
         {_TYPE} AS interaction_type, {_RATING} AS rating,
         TRY_CAST({_RATING} AS DOUBLE) AS score, epoch(ts) AS "timestamp"
  FROM events WHERE event_id % 29 <> 0)""",
    # CRM records after routing and cleaning, as the support stream sees them.
    "cleaned": """cleaned AS (
  SELECT id, customer_id, interaction_type, score AS rating, "timestamp" FROM records
  WHERE customer_id IS NOT NULL AND customer_id <> '0' AND "timestamp" IS NOT NULL
    AND (score IS NULL OR score BETWEEN 1 AND 5))""",
    "validated": """validated AS (
  SELECT CAST(event_id AS VARCHAR) AS "recordId",
         CASE WHEN event_id % 29 = 0 THEN 'ProcessingFailed'
              WHEN event_id % 31 = 0 OR event_id % 23 = 0 THEN 'Dropped' ELSE 'Ok' END AS result
  FROM events)""",
    "quality": """quality0 AS (
  SELECT o_orderkey, o_orderpriority AS common_column,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN -1.0
              WHEN o_orderkey % 103 = 0 THEN 2000000.0 ELSE o_totalprice END AS value_column,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL
              WHEN o_orderkey % 107 = 0 THEN TIMESTAMP '1899-06-01 00:00:00'
              ELSE o_orderdate END AS date_column
  FROM orders),
quality AS (SELECT * FROM quality0 UNION ALL SELECT * FROM quality0 WHERE o_orderkey % 50 = 0)""",
    "tidy": """tidy AS (
  SELECT o_orderkey, common_column, coalesce(value_column, 0) AS value_column,
         coalesce(date_column, TIMESTAMP '1900-01-01 00:00:00') AS date_column
  FROM (SELECT DISTINCT * FROM quality))""",
    "notices": """notices AS (
  SELECT o_orderkey AS message_id, o_orderkey % 11 AS kind,
         CAST(o_orderkey AS VARCHAR) AS name FROM orders)""",
}
