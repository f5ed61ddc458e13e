"""The feeds, derived from the given star-schema tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])

# What each event type stands for in the CRM feed.
INTERACTIONS = {"click": "Feedback", "error": "Complaint", "purchase": "Loyalty",
                "signup": "Inquiry", "view": "Resolution"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_of(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp")) / F.lit(1e6)


# Product numbers of either feed that the other one doesn't have start here.
ONLY_POS, ONLY_INVENTORY = 10_000_000, 20_000_000


def _product(divisor: int, offset: int) -> Column:
    """The part; every ``divisor``-th under a number of this feed's own."""
    part = F.col("l_partkey")
    return F.when(part % divisor == 0, part + offset).otherwise(part).alias("product_id")


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                     F.col("l_linenumber").cast("string")).alias("transaction_id"),
            (F.col("l_suppkey") % 10).alias("store_id"),
            _product(17, ONLY_POS),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").alias("revenue"),
            F.col("l_discount").alias("discount_applied"),
            epoch_of("l_shipdate").alias("timestamp"),
        )
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    next_day = F.when(order % 9 == 0, 86400.0).otherwise(0.0)
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            (order * 10 + line).alias("inventory_id"),
            _product(13, ONLY_INVENTORY),
            (F.col("l_suppkey") % 5).cast("int").alias("warehouse_id"),
            ((order * 7 + line * 13) % 40).alias("stock_level"),
            F.when(F.col("p_size") % 11 != 0, (F.col("p_size") % 20).cast("double"))
            .alias("restock_threshold"),
            (epoch_of("l_shipdate") + line * F.lit(3600.0) + next_day).alias("last_updated"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream takes a folder or a pattern, but not the name of a single file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def _session_id() -> Column:
    day = F.col("ts").cast("date").cast("string")
    return F.when(F.col("event_id") % 41 != 0,
                  F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"), day))


def _customer_id() -> Column:
    return F.when(F.col("event_id") % 37 != 0, F.col("user_id"))


def _interaction_type() -> Column:
    chosen = F.lit(None).cast("string")
    for event_type, meaning in INTERACTIONS.items():
        chosen = F.when(F.col("event_type") == event_type, meaning).otherwise(chosen)
    return chosen


def _rating() -> Column:
    event_id = F.col("event_id")
    return (F.when(event_id % 9 == 0, None).when(event_id % 53 == 0, "n/a")
            .otherwise((event_id % 7).cast("string")))


def web_of(events: DataFrame) -> DataFrame:
    return events.select(_session_id().alias("session_id"), "user_id",
                         F.col("event_type").alias("page"), epoch_of("ts").alias("timestamp"))


def crm_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"), _customer_id().alias("customer_id"),
        _interaction_type().alias("interaction_type"), _rating().alias("rating"),
        epoch_of("ts").alias("timestamp"))


def _wrap(payload: Column) -> Column:
    return F.base64(payload.cast("binary")).alias("data")


def stream_records_of(events: DataFrame) -> DataFrame:
    """Base64 JSON records with the fields of both log feeds, as producers of all kinds write them:
    some ids are texts or decimals, some times are texts, some records have a field more or come in
    a list beside an element that is none; every 29th is broken."""
    event_id = F.col("event_id")

    def sometimes(divisor: int, text: Column, pattern: str, written: str) -> Column:
        # The text stands here once; a pattern that matches nothing leaves it as it is.
        chosen = F.when(event_id % divisor == 0, F.lit(pattern)).otherwise(F.lit("$^"))
        return F.regexp_replace(text, chosen, F.lit(written))

    record = F.struct(
        F.col("event_id").alias("id"), _session_id().alias("session_id"),
        _customer_id().alias("customer_id"), _interaction_type().alias("interaction_type"),
        _rating().alias("rating"), epoch_of("ts").alias("timestamp"))
    text = F.to_json(record)
    text = sometimes(43, text, r'"customer_id":(\d+)', '"customer_id":"C$1"')
    text = sometimes(47, text, r'"customer_id":(\d+),', '"customer_id":$1.0,')
    text = sometimes(59, text, r'"timestamp":([^},]+)', '"timestamp":"$1"')
    text = sometimes(61, text, r"^\{", '{"channel":"web",')
    text = sometimes(67, text, r"^(.*)$", "[5,$1]")
    payload = F.when(event_id % 29 == 0, "{bad").otherwise(text)
    return events.select(event_id.cast("string").alias("recordId"), _wrap(payload))


def raw_records_of(events: DataFrame) -> DataFrame:
    """Records of every validation outcome."""
    event_id = F.col("event_id")
    full = F.to_json(F.struct(F.col("user_id").alias("customer_id"),
                              _interaction_type().alias("interaction_type"),
                              epoch_of("ts").alias("timestamp")))
    payload = (
        F.when(event_id % 29 == 0, "{bad")
        .when(event_id % 31 == 0,
              '{"customer_id":null,"interaction_type":"Feedback","timestamp":1.0}')
        .when(event_id % 23 == 0, '{"customer_id":5}')
        .otherwise(full)
    )
    return events.select(event_id.cast("string").alias("recordId"), _wrap(payload))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages of all kinds, one per order."""
    order = F.col("o_orderkey")

    def entry(bucket: str, key: Column) -> Column:
        return F.concat(F.lit('{"s3":{"bucket":{"name":"' + bucket + '"},"object":{"key":"'),
                        key, F.lit('"}}}'))

    def message(*entries: Column) -> Column:
        return F.concat(F.lit('{"Records":['), F.concat_ws(",", *entries), F.lit("]}"))

    def key(prefix: str, suffix: str) -> Column:
        return F.concat(F.lit(prefix), order.cast("string"), F.lit(suffix))

    body = (
        F.when(order % 11 == 0, '{"Event":"s3:TestEvent"}')
        .when(order % 11 == 1, "no json")
        .when(order % 11 == 2, message(entry("other", key("pos/", ".csv"))))
        .when(order % 11 == 3, message(entry("landing", key("inventory/", ".csv"))))
        .when(order % 11 == 4, message(entry("landing", key("pos/", ".CSV"))))
        .when(order % 11 == 5, message(entry("landing", key("pos/", ".txt"))))
        .when(order % 11 == 6, message(entry("landing", key("pos/day+one%20", ".csv"))))
        .when(order % 11 == 7, message(entry("landing", key("pos/a", ".csv")),
                                       entry("landing", key("pos/b", ".csv"))))
        .when(order % 11 == 8, '{"Records":[{"s3":{"bucket":{"name":"landing"}}}]}')
        .when(order % 11 == 9, '{"hello":1}')
        .otherwise(message(entry("landing", key("pos/", ".csv"))))
    )
    return table(spark, sf_dir, "orders").select(order.alias("message_id"), body.alias("body"))


def quality_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic dataset with nulls, odd values and exact duplicate rows."""
    order = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("common_column"),
        F.when(order % 19 == 0, None).when(order % 101 == 0, -1.0)
        .when(order % 103 == 0, 2000000.0).otherwise(F.col("o_totalprice")).alias("value_column"),
        F.when(order % 23 == 0, None)
        .when(order % 107 == 0, F.lit("1899-06-01").cast("timestamp"))
        .otherwise(F.col("o_orderdate").cast("timestamp")).alias("date_column"),
    )
    copies = F.array_repeat(F.lit(0), F.when(order % 50 == 0, 2).otherwise(1))
    return rows.withColumn("copy", F.explode(copies)).drop("copy")
