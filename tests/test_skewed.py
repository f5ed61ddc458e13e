"""Queries against SQL on tables where one key holds a third of all rows, in many files."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from oracle import compare, connect
from storelens import fixtures
from storelens.operators.previous import with_previous
from storelens.sources.records import parse_records

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("skewed"))
    copies = spark.range(3).select(F.col("id").alias("copy"))

    def table(name):
        return spark.read.parquet(f"{SOURCE}/{name}.parquet")

    # Product 46 and customer 5 take a third of the rows; a third of the orders are exact copies.
    lines = table("lineitem").crossJoin(copies)
    (lines.withColumn("l_partkey", F.when(F.col("copy") == 0, 46).otherwise(F.col("l_partkey")))
     .drop("copy").repartition(5).write.parquet(f"{base}/lineitem.parquet"))
    events = table("events").crossJoin(copies)
    (events.withColumn("user_id", F.when(F.col("copy") == 0, 5).otherwise(F.col("user_id")))
     .withColumn("event_id", F.col("event_id") * 3 + F.col("copy")).drop("copy")
     .repartition(5).write.parquet(f"{base}/events.parquet"))
    orders = table("orders")
    hot = orders.filter("o_orderkey = 1").crossJoin(spark.range(700)).drop("id")
    orders.unionByName(hot).repartition(5).write.parquet(f"{base}/orders.parquet")
    table("part").write.parquet(f"{base}/part.parquet")
    return base


@pytest.mark.parametrize("name", [
    "mart_sales", "join_full_outer_chain", "mart_operations", "join_left_product",
    "mart_marketing", "mart_support_batch", "mart_support_stream", "win_prev_interaction",
    "ord_customer_time", "agg_session_activity", "job_quality", "job_quality_profile",
    "cln_dedupe_rows", "snk_keyed_upsert", "st_support_kpis", "st_marketing_kpis", "st_validate",
    "st_item_store", "st_file_ingest", "st_microbatch_limits", "st_ext_prev_interaction",
    "st_file_ingest_counts", "win_time_to_resolution"])
def test_query_agrees_with_sql(spark, skewed, name):
    problem = compare(spark, connect(skewed), name, skewed)
    assert problem is None, problem


def test_hot_null_and_hot_instant(spark, skewed):
    """A third of all rows without a customer, a third of one instant: the same answer as one window."""
    records = parse_records(fixtures.stream_records_of(fixtures.events(spark, skewed)))
    number = F.col("id").cast("bigint")
    odd = records.withColumns({
        "customer_id": F.when(number % 3 == 0, None).otherwise(F.col("customer_id")),
        "timestamp": F.when(number % 3 == 1, 1.0e9).otherwise(F.col("timestamp")),
        "id": number}).cache()
    plain = odd.withColumn("prev_timestamp", F.lag("timestamp").over(
        Window.partitionBy("customer_id").orderBy("timestamp", "id")))
    seen = with_previous(odd)
    assert seen.exceptAll(plain.select(*seen.columns)).count() == 0 and seen.count() == plain.count()
    odd.unpersist()
