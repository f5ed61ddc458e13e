"""Operations KPIs per product: inventory turnover, restock frequency, stockout alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..operators.cleaning import fill_zero, inventory_clean, pos_clean
from ..operators.enrichment import flag
from ..operators.filters import stocked_out


def sales_per_product(pos: DataFrame) -> DataFrame:
    return pos.groupBy("product_id").agg(F.count("*").alias("transactions"),
                                         F.sum("quantity").alias("units_sold"))


def stock_per_product(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("product_id").agg(F.avg("stock_level").alias("avg_stock_level"))


def _restocks() -> Column:
    """Stock rows at or below their threshold; rows without one never count."""
    due = F.col("stock_level") <= F.col("restock_threshold")
    return F.sum(F.when(due, 1).otherwise(0))


def restock_frequency(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("product_id").agg(_restocks().alias("restock_frequency"))


def products(df: DataFrame) -> DataFrame:
    return df.select("product_id").distinct()


def sold_stockouts(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    """Products that ran out of stock and were also sold."""
    # Both sides are reduced to products first, so a much-sold product moves as one row per task.
    return products(stocked_out(inventory)).join(products(pos), "product_id", "left_semi")


def stockout_alerts(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    return flag(sold_stockouts(pos, inventory), "stockout_alert")


def inventory_turnover(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    joined = sales_per_product(pos).join(stock_per_product(inventory), "product_id")
    return joined.withColumn("inventory_turnover",
                             ratio(F.col("units_sold"), F.col("avg_stock_level")))


def attach_signals(turnover: DataFrame, restocks: DataFrame, alerts: DataFrame) -> DataFrame:
    """Left joins of separately computed signals; whatever is missing becomes zero."""
    return fill_zero(turnover.join(restocks, "product_id", "left")
                     .join(alerts, "product_id", "left"))


def operations_kpis(pos: DataFrame, inventory: DataFrame) -> DataFrame:
    """The operations mart from one aggregate per feed and a single join.

    A product of the inner join has both sales and stock, so whether it ever ran out, and how
    often it was due, are further columns of the stock aggregate and need no join.
    """
    stock = inventory_clean(inventory).groupBy("product_id").agg(
        F.avg("stock_level").alias("avg_stock_level"),
        _restocks().alias("restock_frequency"),
        F.max(F.when(F.col("stock_level") == 0, 1)).alias("stockout_alert"),
    )
    kpis = sales_per_product(pos_clean(pos)).join(stock, "product_id").select(
        "product_id", "transactions", "units_sold", "avg_stock_level",
        ratio(F.col("units_sold"), F.col("avg_stock_level")).alias("inventory_turnover"),
        "restock_frequency", "stockout_alert")
    return fill_zero(kpis)
