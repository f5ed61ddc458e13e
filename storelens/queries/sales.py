"""Sales KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators.filters import valid_event_date
from ..plans import adhoc, sales
from .registry import feeds, query

_SALES = """SELECT "date", store_id, product_id, round(sum(revenue), 3) AS total_sales
FROM pos GROUP BY ALL"""
_STOCK = """SELECT "date", product_id,
  avg(CASE WHEN stock_level > coalesce(restock_threshold, 0) THEN 100.0 ELSE 0.0 END)
    AS stock_availability
FROM inventory GROUP BY ALL"""
_UNITS = """SELECT "date", product_id, CAST(sum(quantity) AS BIGINT) AS units_sold
FROM pos GROUP BY ALL"""
_LEVELS = """SELECT "date", product_id, avg(stock_level) AS avg_stock_level
FROM inventory GROUP BY ALL"""
_TURNOVER = f"""SELECT "date", product_id,
  round(units_sold / nullif(avg_stock_level, 0), 3) AS turnover_rate
FROM ({_UNITS}) JOIN ({_LEVELS}) USING ("date", product_id)"""
_CHAIN = f"""SELECT "date", store_id, product_id, total_sales, stock_availability,
  turnover_rate AS product_turnover_rate
FROM ({_SALES}) FULL JOIN ({_STOCK}) USING ("date", product_id)
  FULL JOIN ({_TURNOVER}) USING ("date", product_id)"""
_PRESENT = """total_sales IS NOT NULL OR stock_availability IS NOT NULL
  OR product_turnover_rate IS NOT NULL"""


@query(feeds(_SALES, "pos"))
def agg_total_sales(spark, sf_dir):
    return sales.total_sales(fixtures.pos(spark, sf_dir))


@query(feeds(_STOCK, "inventory"))
def agg_stock_availability(spark, sf_dir):
    return sales.stock_availability(fixtures.inventory(spark, sf_dir))


@query(feeds(_UNITS, "pos"))
def agg_units_sold_daily(spark, sf_dir):
    return sales.units_sold_daily(fixtures.pos(spark, sf_dir))


@query(feeds(_LEVELS, "inventory"))
def agg_avg_stock_daily(spark, sf_dir):
    return sales.avg_stock_daily(fixtures.inventory(spark, sf_dir))


@query(feeds(f"""SELECT * FROM ({_UNITS}) JOIN ({_LEVELS}) USING ("date", product_id)""",
             "pos", "inventory"))
def join_inner_date_product(spark, sf_dir):
    return sales.units_with_stock(fixtures.pos(spark, sf_dir), fixtures.inventory(spark, sf_dir))


@query(feeds(_TURNOVER, "pos", "inventory"))
def mart_sales_turnover(spark, sf_dir):
    return sales.product_turnover(fixtures.pos(spark, sf_dir), fixtures.inventory(spark, sf_dir))


@query(feeds(_CHAIN, "pos", "inventory"))
def join_full_outer_chain(spark, sf_dir):
    pos, inventory = fixtures.pos(spark, sf_dir), fixtures.inventory(spark, sf_dir)
    return sales.combine(sales.total_sales(pos), sales.stock_availability(inventory),
                         sales.product_turnover(pos, inventory))


@query(feeds(f"""SELECT "date" AS sales_date, store_id AS region, product_id, total_sales
FROM ({_SALES})""", "pos"))
def prj_rename_select(spark, sf_dir):
    return sales.total_sales(fixtures.pos(spark, sf_dir)).withColumnsRenamed(
        {"date": "sales_date", "store_id": "region"}).select(
        "sales_date", "region", "product_id", "total_sales")


@query(feeds(f"SELECT * FROM ({_CHAIN}) WHERE {_PRESENT}", "pos", "inventory"))
def mart_sales(spark, sf_dir):
    return sales.sales_kpis(fixtures.pos(spark, sf_dir), fixtures.inventory(spark, sf_dir))


@query(feeds(f"""SELECT "date", product_id, turnover_rate FROM ({_TURNOVER})
WHERE turnover_rate IS NOT NULL""", "pos", "inventory"))
def flt_any_kpi_present(spark, sf_dir):
    turnover = sales.product_turnover(fixtures.pos(spark, sf_dir),
                                      fixtures.inventory(spark, sf_dir))
    return sales.any_present(turnover, ["turnover_rate"])


@query(feeds("""SELECT transaction_id, product_id, store_id, quantity, "timestamp" FROM pos
WHERE product_id % 19 NOT IN (1, 2, 3)""", "pos"))
def flt_valid_event_date(spark, sf_dir):
    kind = F.col("product_id") % 19
    broken = (F.when(kind == 1, None).when(kind == 2, float("nan")).when(kind == 3, 1e15)
              .otherwise(F.col("timestamp")))
    pos = fixtures.pos(spark, sf_dir).withColumn("timestamp", broken)
    return valid_event_date(pos, "timestamp").select(
        "transaction_id", "product_id", "store_id", "quantity", "timestamp")


@query(feeds(f"""SELECT store_id, count(*) AS days, round(sum(total_sales), 2) AS total_sales
FROM (SELECT "date", store_id, sum(total_sales) AS total_sales FROM ({_SALES}) GROUP BY ALL)
GROUP BY ALL""", "pos"))
def sql_adhoc(spark, sf_dir):
    return adhoc.query(
        spark,
        """SELECT store_id, count(*) AS days, round(sum(total_sales), 2) AS total_sales
           FROM (SELECT date, store_id, sum(total_sales) AS total_sales
                 FROM {sales_kpis} GROUP BY date, store_id)
           GROUP BY store_id""",
        sales_kpis=sales.total_sales(fixtures.pos(spark, sf_dir)))
