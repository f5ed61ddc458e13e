"""Sinks: each query writes whole tables to the shared folder and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators.validation import validate_records
from ..plans import operations, silver, support
from ..session import work_dir
from ..sinks import folders, items, jdbc
from . import operations as operations_queries
from . import support as support_queries
from .registry import REGISTRY, feeds, query, rounded
from .sources import _POS, named

_STAMP = "2024-02-01_00-00-00"
_AS_OF = "2024-02-01 00:00:00"


def _sql(name: str) -> str:
    return REGISTRY[name].sql


@query(feeds(f"""SELECT *, '{_STAMP}' AS run_ts FROM ({_POS})""", "pos"))
def snk_parquet_run_folder(spark, sf_dir):
    base = work_dir(spark, "silver")
    folders.write_run_folder(fixtures.pos(spark, sf_dir), base, "pos", _STAMP)
    return spark.read.parquet(f"{base}/pos")


@query(feeds(f"""SELECT *, '2024-02-01' AS ingest_date FROM ({_POS})""", "pos"))
def snk_bronze_daily(spark, sf_dir):
    path = work_dir(spark, "bronze-pos")
    folders.write_daily(fixtures.pos(spark, sf_dir), path, "2024-02-01")
    return spark.read.parquet(path)


@query(_sql("mart_support_batch"))
def snk_table_append(spark, sf_dir):
    path = work_dir(spark, "crm-kpis")
    crm = fixtures.crm_of(fixtures.events(spark, sf_dir))
    folders.append_table(support.support_kpis(crm, _AS_OF), path)
    return rounded(spark.read.parquet(path))


@query(feeds(f"SELECT *, '{_STAMP}' AS run_ts FROM ({operations_queries._SIGNALS})",
             "pos", "inventory"))
def snk_table_snapshot(spark, sf_dir):
    base = work_dir(spark, "operation-kpis")
    kpis = operations.operations_kpis(fixtures.pos(spark, sf_dir),
                                      fixtures.inventory(spark, sf_dir))
    folders.write_snapshot(kpis, base, _STAMP)
    return spark.read.parquet(base)


@query(feeds(f"""SELECT *, '{_AS_OF}' AS kpi_date, 'batch' AS query, 0 AS batch_id
FROM ({support_queries.STREAM_MART})""", "records", "cleaned"))
def snk_kpi_row_insert(spark, sf_dir):
    path = work_dir(spark, "support-kpis")
    records = support_queries._records(spark, sf_dir)
    kpis = jdbc.kpi_defaults(support.support_kpis_of_records(records, _AS_OF))
    folders.write_batch(kpis, path, 0)
    return rounded(spark.read.parquet(path))


@query(feeds("""SELECT customer_id, arg_max(id, struct_pack(t := "timestamp", i := id)) AS id,
  arg_max(interaction_type, struct_pack(t := "timestamp", i := id)) AS interaction_type
FROM crm WHERE customer_id IS NOT NULL GROUP BY customer_id""", "crm"))
def snk_keyed_upsert(spark, sf_dir):
    path = work_dir(spark, "items")
    crm = (fixtures.crm_of(fixtures.events(spark, sf_dir))
           .select("customer_id", "id", "interaction_type", "timestamp"))
    # Two batches cut by time: the later one replaces items of the earlier one.
    cut = F.lit(1705276800.0)
    order = ["timestamp", "id"]
    items.put_items(crm.filter(F.col("timestamp") < cut), path, 0, "customer_id", order)
    items.put_items(crm.filter(F.col("timestamp") >= cut), path, 1, "customer_id", order)
    return items.current_items(spark, path, "customer_id").select(
        "customer_id", "id", "interaction_type")


@query(feeds("""SELECT "recordId", result FROM validated""", "validated"))
def snk_validated_delivery(spark, sf_dir):
    path = work_dir(spark, "delivery")
    raw = fixtures.raw_records_of(fixtures.events(spark, sf_dir))
    folders.write_delivery(validate_records(raw), path)
    return spark.read.parquet(path).select("recordId", "result")


@query(feeds("""SELECT 'pos' AS dataset, count(*) AS records,
  round(sum(revenue), 2) AS total FROM pos
UNION ALL SELECT 'inventory', count(*), CAST(sum(stock_level) AS DOUBLE) FROM inventory""",
             "pos", "inventory"))
def job_bronze_to_silver(spark, sf_dir):
    with (named(fixtures.pos(spark, sf_dir)) as bronze_pos,
          named(fixtures.inventory(spark, sf_dir)) as bronze_inventory):
        written = silver.bronze_to_silver(
            spark, {"silver-pos": bronze_pos, "silver-inventory": bronze_inventory},
            work_dir(spark, "silver"), stamp=_STAMP)
    pos = spark.read.parquet(written["silver-pos"]).agg(
        F.lit("pos").alias("dataset"), F.count("*").alias("records"),
        F.round(F.sum("revenue"), 2).alias("total"))
    inventory = spark.read.parquet(written["silver-inventory"]).agg(
        F.lit("inventory").alias("dataset"), F.count("*").alias("records"),
        F.sum("stock_level").cast("double").alias("total"))
    return pos.unionAll(inventory)
