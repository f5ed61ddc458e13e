"""Sales KPIs: total sales, stock availability and product turnover.

Each KPI exists on its own; ``sales_kpis`` computes all of them from one scan per feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch
from ..functions.numbers import ratio
from ..operators.filters import any_present, valid_event_date

# KPI columns of the mart.
KPIS = ["total_sales", "stock_availability", "product_turnover_rate"]


def _dated(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("date", epoch.as_date(F.col(column)))


def _availability() -> Column:
    """Percentage of stock rows above their threshold, no threshold meaning zero."""
    above = F.col("stock_level") > F.coalesce(F.col("restock_threshold"), F.lit(0.0))
    return F.avg(F.when(above, F.lit(100.0)).otherwise(F.lit(0.0)))


def _turnover(units: Column, stock: Column) -> Column:
    return F.round(ratio(units, stock), 3)


def total_sales(pos: DataFrame) -> DataFrame:
    return (_dated(pos, "timestamp").groupBy("date", "store_id", "product_id")
            .agg(F.round(F.sum("revenue"), 3).alias("total_sales")))


def stock_availability(inventory: DataFrame) -> DataFrame:
    return (_dated(inventory, "last_updated").groupBy("date", "product_id")
            .agg(_availability().alias("stock_availability")))


def units_sold_daily(pos: DataFrame) -> DataFrame:
    return (_dated(pos, "timestamp").groupBy("date", "product_id")
            .agg(F.sum("quantity").alias("units_sold")))


def avg_stock_daily(inventory: DataFrame) -> DataFrame:
    return (_dated(inventory, "last_updated").groupBy("date", "product_id")
            .agg(F.avg("stock_level").alias("avg_stock_level")))


def units_with_stock(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    """Days and products with both sales and stock readings.

    Both feeds go through one aggregate: a task holds one table of groups, where a join of two aggregates holds both
    tables and their sorted copies at once.
    """
    keys = ["date", "product_id"]
    sold = _dated(pos, "timestamp").select(*keys, "quantity", F.lit(True).alias("_sold"))
    stock = _dated(inventory, "last_updated").select(*keys, "stock_level", F.lit(False).alias("_sold"))
    both = sold.unionByName(stock, allowMissingColumns=True).dropna(subset=keys)
    return (both.groupBy(*keys)
            .agg(F.sum("quantity").alias("units_sold"), F.avg("stock_level").alias("avg_stock_level"),
                 F.bool_or("_sold").alias("_any_sold"), F.bool_and("_sold").alias("_only_sold"))
            .filter(F.col("_any_sold") & ~F.col("_only_sold")).drop("_any_sold", "_only_sold"))


def product_turnover(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    rate = _turnover(F.col("units_sold"), F.col("avg_stock_level"))
    return units_with_stock(pos, inventory).select(
        "date", "product_id", rate.alias("turnover_rate"))


def combine(sales: DataFrame, stock: DataFrame, turnover: DataFrame) -> DataFrame:
    """Full outer chain over separately computed KPIs; stock KPIs repeat per store."""
    keys = ["date", "product_id"]
    return sales.join(stock, keys, "outer").join(turnover, keys, "outer").select(
        "date", "store_id", "product_id", "total_sales", "stock_availability",
        F.col("turnover_rate").alias("product_turnover_rate"))


def sales_kpis(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    """The sales mart: date, store and product with all three KPIs.

    Sales are reduced to date, store and product before anything else moves. The units of a day
    and product are a window sum over that result, at most one row per store, and both stock
    figures share an aggregate, so turnover needs no join of its own: it is null unless both
    sides of the one outer join are there.
    """
    sold = (_dated(valid_event_date(pos, "timestamp"), "timestamp")
            .groupBy("date", "store_id", "product_id")
            .agg(F.round(F.sum("revenue"), 3).alias("total_sales"),
                 F.sum("quantity").alias("units")))
    per_product = Window.partitionBy("date", "product_id")
    sold = sold.withColumn("units_sold", F.sum("units").over(per_product)).drop("units")
    stock = (_dated(valid_event_date(inventory, "last_updated"), "last_updated")
             .groupBy("date", "product_id")
             .agg(_availability().alias("stock_availability"),
                  F.avg("stock_level").alias("avg_stock_level")))
    kpis = sold.join(stock, ["date", "product_id"], "outer").select(
        "date", "store_id", "product_id", "total_sales", "stock_availability",
        _turnover(F.col("units_sold"), F.col("avg_stock_level")).alias("product_turnover_rate"))
    return any_present(kpis, KPIS)
