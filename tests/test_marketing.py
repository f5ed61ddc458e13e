import pytest

from storelens.plans import marketing
from storelens.schemas import CRM_LOGS, RECORD, WEB_LOGS


def web(spark, rows):
    return spark.createDataFrame([(s, 1, "p", t) for s, t in rows], WEB_LOGS)


def crm(spark, rows):
    """Rows of (customer, type, rating)."""
    return spark.createDataFrame([(i, c, k, r, 1.0) for i, (c, k, r) in enumerate(rows)], CRM_LOGS)


def test_mart(spark):
    w = web(spark, [("a", 1.0), ("a", 4.5), ("b", 9.0), (None, 1.0), ("c", None)])
    c = crm(spark, [(1, "Feedback", "4"), (1, "Complaint", "1"), (2, "Feedback", "n/a"),
                    (2, "Loyalty", "5"), (None, "Feedback", "5"), (0, "Loyalty", None)])
    row = marketing.marketing_kpis(w, c, "2024-01-01 00:00:00").collect()
    assert [tuple(r) for r in row] == [(2.5, 1.75, 50.0, 40.0, "2024-01-01 00:00:00")]


def test_empty_feeds_give_nulls_in_batch(spark):
    row = marketing.marketing_kpis(web(spark, []), crm(spark, []), "2024-01-01 00:00:00").first()
    assert tuple(row)[:4] == (None, None, None, 0.0)


def records(spark, rows):
    """Rows of (session, customer, type, rating, timestamp)."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], RECORD)


def test_record_with_both_ids_counts_on_both_sides(spark):
    r = records(spark, [("a", 1, "Feedback", "2", 1.0), ("a", None, None, None, 3.0),
                        ("", 0, "Loyalty", None, 5.0)])
    row = marketing.marketing_kpis_of_records(r, "2024-01-01 00:00:00").first()
    assert tuple(row)[:4] == (2.0, 2.0, 0.0, 0.0)


def test_records_without_ids_give_no_row(spark):
    r = records(spark, [("", 0, "Loyalty", None, 5.0), (None, None, None, None, None)])
    assert marketing.marketing_kpis_of_records(r).count() == 0
    assert marketing.marketing_kpis_of_records(records(spark, [])).count() == 0


def test_only_web_records_give_zeros_for_the_rest(spark):
    row = marketing.marketing_kpis_of_records(
        records(spark, [("a", None, None, None, 5.0)]), "2024-01-01 00:00:00").first()
    assert tuple(row)[:4] == (0.0, 0.0, 100.0, 0.0)


def test_single_event_session_is_a_bounce(spark):
    row = marketing.session_activity(web(spark, [("a", 7.0)])).first()
    assert (row.event_count, row.session_duration, row.is_bounce) == (1, 0.0, 1)


def test_only_single_rows_stand_side_by_side(spark):
    one, two = spark.sql("SELECT 1 AS a"), spark.range(2)
    assert [tuple(r) for r in marketing.cross_kpis(one, spark.range(1)).collect()] == [(1, 0)]
    assert marketing.cross_kpis(one, spark.range(0)).collect() == []
    with pytest.raises(Exception, match="a row each"):
        marketing.cross_kpis(one, two).collect()
