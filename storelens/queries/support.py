"""Customer-support KPIs in both definitions, and the window behind time to resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import filters, previous, validation
from ..plans import support
from ..sources.records import parse_records
from .registry import feeds, query, rounded

_FEEDBACK = """SELECT round(coalesce(avg(score) FILTER (interaction_type = 'Feedback'), 0), 6)
  AS feedback_score FROM crm"""
_VOLUME = "SELECT interaction_type, count(*) AS volume FROM crm GROUP BY ALL"
_SPAN = """SELECT round(coalesce(avg(span), 0), 6) AS time_to_resolution FROM (
  SELECT CAST(trunc(max("timestamp") - min("timestamp")) AS BIGINT) AS span
  FROM crm WHERE interaction_type = 'Complaint' GROUP BY customer_id)"""
_PREVIOUS = """SELECT *, lag("timestamp") OVER (PARTITION BY customer_id
  ORDER BY "timestamp", id) AS prev_timestamp FROM cleaned"""
_RESOLUTION = f"""SELECT round(coalesce(avg(("timestamp" - prev_timestamp) / 60.0), 0), 6)
  AS avg_time_to_resolution_minutes FROM ({_PREVIOUS})
WHERE interaction_type = 'Resolution' AND prev_timestamp IS NOT NULL"""


def _json(column: str, source: str) -> str:
    """Volumes as JSON text, keys sorted."""
    return ("'{' || string_agg('\"' || interaction_type || '\":' || CAST(volume AS VARCHAR), ',' "
            f"ORDER BY interaction_type) || '}}' AS {column} FROM (SELECT interaction_type, "
            f"count(*) AS volume FROM {source} GROUP BY ALL)")


STREAM_MART = f"""SELECT * FROM
  (SELECT round(coalesce(avg(rating), 0), 6) AS feedback_score FROM cleaned)
  CROSS JOIN (SELECT {_json('interaction_volume_by_type', 'cleaned')})
  CROSS JOIN ({_RESOLUTION})"""


def _crm(spark, sf_dir):
    return fixtures.crm_of(fixtures.events(spark, sf_dir))


def _records(spark, sf_dir):
    return parse_records(fixtures.stream_records_of(fixtures.events(spark, sf_dir)))


def _cleaned(spark, sf_dir):
    return support.clean_interactions(_records(spark, sf_dir))


@query(feeds("""SELECT id, customer_id, interaction_type, score AS rating, "timestamp" FROM crm
WHERE score IS NULL OR score BETWEEN 1 AND 5""", "crm"))
def flt_rating_range(spark, sf_dir):
    return filters.rating_in_range(_crm(spark, sf_dir))


@query(feeds("""SELECT count(*) AS records,
  count(*) FILTER ("timestamp" IS NULL) AS missing_keys,
  count(*) FILTER (score IS NOT NULL AND score NOT BETWEEN 1 AND 5) AS invalid_ratings
FROM records WHERE customer_id IS NOT NULL AND customer_id <> '0'""", "records"))
def vld_drop_metrics(spark, sf_dir):
    return validation.removal_counts(_records(spark, sf_dir))


@query(feeds(_FEEDBACK, "crm"))
def agg_feedback_score(spark, sf_dir):
    return rounded(support.feedback_score(_crm(spark, sf_dir)))


@query(feeds("SELECT round(coalesce(avg(rating), 0), 6) AS feedback_score FROM cleaned",
             "records", "cleaned"))
def agg_feedback_score_any(spark, sf_dir):
    return rounded(support.feedback_score_any(_cleaned(spark, sf_dir)))


@query(feeds(_VOLUME, "crm"))
def agg_interaction_volume(spark, sf_dir):
    return support.interaction_volume(_crm(spark, sf_dir))


@query(feeds("""SELECT interaction_type, count(*) AS volume FROM cleaned
WHERE interaction_type IS NOT NULL GROUP BY ALL ORDER BY 2 DESC, 1""", "records", "cleaned"))
def agg_interaction_volume_sorted(spark, sf_dir):
    return support.interaction_volume_sorted(_cleaned(spark, sf_dir))


@query(feeds("""SELECT interaction_type, count(*) AS volume FROM crm
WHERE interaction_type IS NOT NULL GROUP BY ALL ORDER BY 2 DESC, 1""", "crm"))
def ord_value_counts(spark, sf_dir):
    return support.interaction_volume_sorted(_crm(spark, sf_dir))


@query(feeds(f"SELECT {_json('interaction_volume', 'crm')}", "crm"))
def agg_interaction_volume_json(spark, sf_dir):
    return support.interaction_volume_json(_crm(spark, sf_dir))


@query(feeds(_SPAN, "crm"))
def agg_time_to_resolution_span(spark, sf_dir):
    return rounded(support.complaint_span(_crm(spark, sf_dir)))


@query(feeds(f"""SELECT *, '2024-02-01T00:00:00.000000' AS "timestamp" FROM ({_FEEDBACK})
CROSS JOIN (SELECT {_json('interaction_volume', 'crm')}) CROSS JOIN ({_SPAN})""", "crm"))
def mart_support_batch(spark, sf_dir):
    return rounded(support.support_kpis(_crm(spark, sf_dir), "2024-02-01 00:00:00"))


@query(feeds(_PREVIOUS, "records", "cleaned"))
def win_prev_interaction(spark, sf_dir):
    return previous.with_previous(_cleaned(spark, sf_dir)).drop("session_id")


@query(feeds(_RESOLUTION, "records", "cleaned"))
def win_time_to_resolution(spark, sf_dir):
    return rounded(support.time_to_resolution(_cleaned(spark, sf_dir)))


@query(feeds("""SELECT customer_id, "timestamp", id, interaction_type FROM cleaned
ORDER BY customer_id, "timestamp", id""", "records", "cleaned"))
def ord_customer_time(spark, sf_dir):
    # Copies of a record share all sort columns; a number lets the sort spread them over tasks.
    rows = _cleaned(spark, sf_dir).withColumn("number", F.monotonically_increasing_id())
    return (rows.orderBy("customer_id", "timestamp", "id", "number")
            .select("customer_id", "timestamp", "id", "interaction_type"))


@query(feeds("""SELECT id, customer_id, interaction_type FROM cleaned ORDER BY id LIMIT 5""",
             "records", "cleaned"))
def lim_preview(spark, sf_dir):
    return (_cleaned(spark, sf_dir).select("id", "customer_id", "interaction_type")
            .orderBy(F.col("id")).limit(5))


@query(feeds(f"SELECT *, '2024-02-01 00:00:00' AS kpi_date FROM ({STREAM_MART})",
             "records", "cleaned"))
def mart_support_stream(spark, sf_dir):
    return rounded(support.support_kpis_of_records(_records(spark, sf_dir),
                                                   "2024-02-01 00:00:00"))
