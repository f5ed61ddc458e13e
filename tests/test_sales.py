import datetime as dt

from storelens.operators.filters import any_present, valid_event_date
from storelens.plans import sales
from storelens.schemas import INVENTORY, POS

DAY = 86400.0


def pos(spark, rows):
    """Rows of (store, product, quantity, revenue, timestamp)."""
    return spark.createDataFrame(
        [(f"t{i}", s, p, q, r, None, t) for i, (s, p, q, r, t) in enumerate(rows)], POS)


def inventory(spark, rows):
    """Rows of (product, stock, threshold, timestamp)."""
    return spark.createDataFrame(
        [(i, p, 1, s, h, t) for i, (p, s, h, t) in enumerate(rows)], INVENTORY)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_sales_kpis_equal_the_outer_chain(spark):
    p = pos(spark, [(1, 10, 2, 5.5, 0.0), (1, 10, 1, 2.25, 10.9), (2, 10, 4, 1.0, 5.0),
                    (1, 11, 1, 9.0, DAY), (1, 12, 3, 1.0, DAY), (None, 13, 1, 1.0, DAY),
                    (1, None, 5, 2.0, 0.0)])
    i = inventory(spark, [(10, 4, 3.0, 1.0), (10, 0, None, 2.0), (12, 0, 1.0, DAY),
                          (14, 7, 7.0, DAY), (None, 3, 1.0, 0.0)])
    chain = sales.combine(sales.total_sales(p), sales.stock_availability(i),
                          sales.product_turnover(p, i))
    fused = sales.sales_kpis(p, i)
    assert as_set(fused) == as_set(any_present(chain, sales.KPIS))
    day0, day1 = dt.date(1970, 1, 1), dt.date(1970, 1, 2)
    assert as_set(fused) == {
        (day0, 1, 10, 7.75, 50.0, 3.5), (day0, 2, 10, 1.0, 50.0, 3.5),
        (day1, 1, 11, 9.0, None, None), (day1, 1, 12, 1.0, 0.0, None),
        (day1, None, 13, 1.0, None, None), (day1, None, 14, None, 0.0, None),
        # Null products never match each other.
        (day0, 1, None, 2.0, None, None), (day0, None, None, None, 100.0, None),
    }


def test_stock_at_the_threshold_is_not_available(spark):
    i = inventory(spark, [(1, 3, 3.0, 0.0), (1, 4, 3.0, 0.0), (1, 1, None, 0.0), (1, 0, None, 0.0)])
    assert sales.stock_availability(i).first().stock_availability == 50.0


def test_rows_without_a_calendar_date_are_left_out(spark):
    p = pos(spark, [(1, 1, 1, 1.0, t) for t in
                    (0.0, None, float("nan"), float("inf"), 1e18, -1e18, 253402300799.5)])
    assert sorted(r.timestamp for r in valid_event_date(p, "timestamp").collect()) == \
        [0.0, 253402300799.5]


def test_zero_average_stock_gives_no_turnover(spark):
    p, i = pos(spark, [(1, 1, 2, 1.0, 0.0)]), inventory(spark, [(1, 0, None, 0.0)])
    assert sales.product_turnover(p, i).first().turnover_rate is None


def test_empty_feeds(spark):
    assert sales.sales_kpis(pos(spark, []), inventory(spark, [])).count() == 0


def test_one_scan_per_feed(spark, tmp_path):
    pos(spark, [(1, 1, 1, 1.0, 0.0)]).write.parquet(f"{tmp_path}/pos")
    inventory(spark, [(1, 1, 1.0, 0.0)]).write.parquet(f"{tmp_path}/inv")
    kpis = sales.sales_kpis(spark.read.schema(POS).parquet(f"{tmp_path}/pos"),
                            spark.read.schema(INVENTORY).parquet(f"{tmp_path}/inv"))
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "discount_applied" not in plan


def test_units_with_stock_match_the_join_in_one_aggregate(spark):
    pos = spark.createDataFrame(
        [(7, 2, 0.0), (7, None, 3600.0), (8, None, 0.0), (9, 4, 0.0), (None, 5, 0.0), (7, 3, 86400.0), (7, 9, None)],
        "product_id long, quantity long, timestamp double")
    inventory = spark.createDataFrame(
        [(7, 10, 10.0), (7, 13, 20.0), (8, None, 0.0), (10, 4, 0.0), (None, 5, 0.0), (7, 6, None)],
        "product_id long, stock_level long, last_updated double")
    got = sales.units_with_stock(pos, inventory)
    joined = sales.units_sold_daily(pos).join(sales.avg_stock_daily(inventory), ["date", "product_id"])
    assert got.columns == joined.columns and got.dtypes == joined.dtypes
    rows = {tuple(r)[1:] for r in got.collect()}
    assert rows == {tuple(r)[1:] for r in joined.collect()} == {(7, 2, 11.5), (8, None, None)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1
