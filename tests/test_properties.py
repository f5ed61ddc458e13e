"""Fused plans against plain Python on random small feeds."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_sales import inventory, pos

from storelens.plans import marketing, operations, sales
from storelens.schemas import WEB_LOGS

FEW = settings(max_examples=6, deadline=None, derandomize=True,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(1, 3))
times = st.sampled_from([0.0, 10.5, 86399.9, 86400.0, 200000.0])
pos_rows = st.lists(st.tuples(keys, keys, st.integers(0, 5), st.integers(0, 400).map(lambda c: c / 4),
                              times), max_size=25)
inventory_rows = st.lists(st.tuples(keys, st.integers(0, 3),
                                    st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.0])), times),
                          max_size=25)


def date(moment):
    return dt.date(1970, 1, 1) + dt.timedelta(days=int(moment) // 86400)


@FEW
@given(pos_rows, inventory_rows)
def test_sales_mart(spark, sold, stocked):
    revenue, units = defaultdict(float), defaultdict(int)
    for store, product, quantity, amount, moment in sold:
        revenue[date(moment), store, product] += amount
        units[date(moment), product] += quantity
    levels = defaultdict(list)
    for product, level, threshold, moment in stocked:
        levels[date(moment), product].append((level, level > (threshold or 0)))

    def stock_of(day, product):
        rows = levels.get((day, product)) if product is not None else None
        return (None, None) if not rows else (100.0 * sum(a for _, a in rows) / len(rows),
                                              sum(v for v, _ in rows) / len(rows))

    want = []
    for (day, store, product), total in revenue.items():
        available, average = stock_of(day, product)
        rate = round(units[day, product] / average, 3) if average else None
        want.append((day, store, product, total, available, rate))
    sold_keys = {(day, product) for day, _, product in revenue if product is not None}
    for (day, product), rows in levels.items():
        if (day, product) not in sold_keys:
            want.append((day, None, product, None, 100.0 * sum(a for _, a in rows) / len(rows), None))
    got = [tuple(r) for r in sales.sales_kpis(pos(spark, sold), inventory(spark, stocked)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


@FEW
@given(pos_rows, inventory_rows)
def test_operations_mart(spark, sold, stocked):
    p, i = pos(spark, sold), inventory(spark, stocked)
    rows = {r.product_id: r for r in operations.operations_kpis(p, i).collect()}
    products = ({r[1] for r in sold} & {r[0] for r in stocked}) - {None}
    assert set(rows) == products
    for product in products:
        quantities = [r[2] for r in sold if r[1] == product]
        stock = [(level, threshold) for key, level, threshold, _ in stocked if key == product]
        average = sum(level for level, _ in stock) / len(stock)
        assert tuple(rows[product])[1:] == (
            len(quantities), sum(quantities), average,
            sum(quantities) / average if average else 0.0,
            sum(threshold is not None and level <= threshold for level, threshold in stock),
            int(any(level == 0 for level, _ in stock)))


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc")),
                          st.one_of(st.none(), times)), max_size=20))
def test_sessions(spark, visits):
    web = spark.createDataFrame([(s, 1, "p", t) for s, t in visits], WEB_LOGS)
    seen = defaultdict(list)
    for session, moment in visits:
        if session is not None and moment is not None:
            seen[session].append(moment)
    row = marketing.session_metrics(marketing.session_activity(
        marketing.web_required(web))).first()
    if not seen:
        assert tuple(row) == (None, None)
    else:
        spans = [max(m) - min(m) for m in seen.values()]
        bounces = sum(len(m) == 1 for m in seen.values())
        assert abs(row.avg_session_duration - sum(spans) / len(spans)) < 1e-9
        assert abs(row.bounce_rate_percent - 100 * bounces / len(seen)) < 1e-9
