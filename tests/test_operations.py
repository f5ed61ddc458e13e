from test_sales import inventory, pos

from storelens.operators.cleaning import inventory_clean, pos_clean
from storelens.plans import operations


def test_fused_mart_equals_the_joined_parts(spark):
    p = pos(spark, [(1, 1, 5, 1.0, 0.0), (2, 1, 3, 1.0, 0.0), (1, 2, 4, 1.0, 0.0),
                    (1, 3, None, 1.0, 0.0), (1, 9, 1, 1.0, 0.0), (1, None, 1, 1.0, 0.0)])
    i = inventory(spark, [(1, 4, 4.0, 0.0), (1, 0, None, 0.0), (2, 0, None, 0.0),
                          (3, 6, 2.0, 0.0), (8, 0, 1.0, 0.0), (None, 0, 1.0, 0.0)])
    parts = operations.attach_signals(
        operations.inventory_turnover(p, i),
        operations.restock_frequency(inventory_clean(i)),
        operations.stockout_alerts(p, i))
    fused = operations.operations_kpis(p, i)
    assert fused.columns == parts.columns
    rows = {tuple(r) for r in fused.collect()}
    assert rows == {tuple(r) for r in parts.collect()}
    assert rows == {
        (1, 2, 8, 2.0, 4.0, 1, 1),
        # Average stock of zero: no turnover, reported as zero.
        (2, 1, 4, 0.0, 0.0, 0, 1),
        (3, 1, 0, 6.0, 0.0, 0, 0),
    }


def test_threshold_is_cut_to_a_whole_number(spark):
    i = inventory(spark, [(1, 0, -0.5, 0.0), (1, 5, 5.7, 0.0), (1, 6, 5.7, 0.0)])
    cleaned = inventory_clean(i)
    assert sorted(r.restock_threshold for r in cleaned.collect()) == [0, 5, 5]
    assert operations.restock_frequency(cleaned).first().restock_frequency == 2


def test_dirty_text_columns_become_null(spark):
    raw = spark.createDataFrame(
        [("t", "1", "x", "3.9", "2.5", "", "12.7")],
        "transaction_id string, store_id string, product_id string, quantity string,"
        " revenue string, discount_applied string, timestamp string")
    row = pos_clean(raw).first()
    assert (row.store_id, row.product_id, row.quantity, row.revenue, row.discount_applied) == \
        (1, None, 3, 2.5, None)
    assert row.transaction_time == "1970-01-01 00:00:12"


def test_sold_stockouts_needs_both(spark):
    p = pos(spark, [(1, 1, 1, 1.0, 0.0), (1, 2, 1, 1.0, 0.0)])
    i = inventory(spark, [(1, 0, None, 0.0), (1, 0, None, 0.0), (2, 5, None, 0.0),
                          (3, 0, None, 0.0)])
    assert [r.product_id for r in operations.sold_stockouts(p, i).collect()] == [1]
