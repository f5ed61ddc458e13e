"""Operations KPIs."""

from __future__ import annotations

from .. import fixtures
from ..operators.cleaning import fill_zero, inventory_clean
from ..operators.enrichment import flag
from ..operators.filters import stocked_out
from ..plans import operations
from .registry import feeds, query

_SALES = """SELECT product_id, count(*) AS transactions,
  CAST(sum(quantity) AS BIGINT) AS units_sold FROM pos GROUP BY ALL"""
_STOCK = "SELECT product_id, avg(stock_level) AS avg_stock_level FROM inventory GROUP BY ALL"
_RESTOCK = """SELECT product_id, CAST(sum(CASE WHEN restock_threshold IS NULL THEN 0
  WHEN stock_level <= restock_threshold THEN 1 ELSE 0 END) AS BIGINT) AS restock_frequency
FROM inventory GROUP BY ALL"""
_ALERTS = """SELECT DISTINCT product_id, 1 AS stockout_alert FROM inventory
WHERE stock_level = 0 AND product_id IN (SELECT product_id FROM pos)"""
_TURNOVER = f"""SELECT *, units_sold / nullif(avg_stock_level, 0) AS inventory_turnover
FROM ({_SALES}) JOIN ({_STOCK}) USING (product_id)"""
_SIGNALS = f"""SELECT product_id, transactions, units_sold, avg_stock_level,
  coalesce(inventory_turnover, 0) AS inventory_turnover,
  coalesce(restock_frequency, 0) AS restock_frequency,
  coalesce(stockout_alert, 0) AS stockout_alert
FROM ({_TURNOVER}) LEFT JOIN ({_RESTOCK}) USING (product_id)
  LEFT JOIN ({_ALERTS}) USING (product_id)"""


def _pair(spark, sf_dir):
    return fixtures.pos(spark, sf_dir), fixtures.inventory(spark, sf_dir)


@query(feeds(_SALES, "pos"))
def agg_sales_per_product(spark, sf_dir):
    return operations.sales_per_product(fixtures.pos(spark, sf_dir))


@query(feeds(_STOCK, "inventory"))
def agg_stock_per_product(spark, sf_dir):
    return operations.stock_per_product(fixtures.inventory(spark, sf_dir))


@query(feeds(_RESTOCK, "inventory"))
def agg_restock_frequency(spark, sf_dir):
    return operations.restock_frequency(fixtures.inventory(spark, sf_dir))


@query(feeds("SELECT DISTINCT product_id FROM pos", "pos"))
def agg_distinct_products(spark, sf_dir):
    return operations.products(fixtures.pos(spark, sf_dir))


@query(feeds("""SELECT inventory_id, product_id, warehouse_id FROM inventory
WHERE stock_level = 0""", "inventory"))
def flt_stockout(spark, sf_dir):
    return stocked_out(fixtures.inventory(spark, sf_dir)).select(
        "inventory_id", "product_id", "warehouse_id")


@query(feeds("""SELECT DISTINCT product_id, 1 AS out_of_stock FROM inventory
WHERE stock_level = 0""", "inventory"))
def prj_flag_constant(spark, sf_dir):
    empty = stocked_out(fixtures.inventory(spark, sf_dir))
    return flag(operations.products(empty), "out_of_stock")


@query(feeds(_TURNOVER, "pos", "inventory"))
def join_inner_product(spark, sf_dir):
    return operations.inventory_turnover(*_pair(spark, sf_dir))


@query(feeds(f"SELECT product_id FROM ({_ALERTS})", "pos", "inventory"))
def join_semi_sold_stockouts(spark, sf_dir):
    return operations.sold_stockouts(*_pair(spark, sf_dir))


@query(feeds(_SIGNALS, "pos", "inventory"))
def join_left_product(spark, sf_dir):
    pos, inventory = _pair(spark, sf_dir)
    return operations.attach_signals(
        operations.inventory_turnover(pos, inventory),
        operations.restock_frequency(inventory_clean(inventory)),
        operations.stockout_alerts(pos, inventory))


@query(feeds("""SELECT inventory_id, product_id, stock_level,
  coalesce(restock_threshold, 0) AS restock_threshold FROM inventory""", "inventory"))
def cln_fill_zero(spark, sf_dir):
    return fill_zero(fixtures.inventory(spark, sf_dir).select(
        "inventory_id", "product_id", "stock_level", "restock_threshold"))


@query(feeds(_SIGNALS, "pos", "inventory"))
def mart_operations(spark, sf_dir):
    return operations.operations_kpis(*_pair(spark, sf_dir))
