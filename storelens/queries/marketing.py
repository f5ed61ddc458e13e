"""Marketing KPIs."""

from __future__ import annotations

from .. import fixtures
from ..operators import filters
from ..plans import marketing
from .registry import feeds, query, rounded

_ENGAGED = """customer_id IS NOT NULL AND interaction_type IN ('Feedback', 'Complaint')
  AND rating IS NOT NULL"""
_ENGAGEMENT = f"""SELECT round(avg(score), 6) AS customer_engagement_score
FROM crm WHERE {_ENGAGED}"""
_ACTIVITY = """SELECT session_id, min("timestamp") AS start_time, max("timestamp") AS end_time,
  count(*) AS event_count, max("timestamp") - min("timestamp") AS session_duration,
  CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS is_bounce
FROM web WHERE session_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY session_id"""
_METRICS = f"""SELECT round(avg(session_duration), 6) AS avg_session_duration,
  round(sum(is_bounce) / count(*) * 100, 6) AS bounce_rate_percent FROM ({_ACTIVITY})"""
_LOYALTY = """SELECT round(count(*) FILTER (interaction_type = 'Loyalty') / count(*) * 100, 6)
  AS loyalty_activity_rate_percent FROM crm WHERE customer_id IS NOT NULL"""
MART = f"""SELECT * FROM ({_ENGAGEMENT}) CROSS JOIN ({_METRICS}) CROSS JOIN ({_LOYALTY})"""


def _web(spark, sf_dir):
    return fixtures.web_of(fixtures.events(spark, sf_dir))


def _crm(spark, sf_dir):
    return filters.crm_required(fixtures.crm_of(fixtures.events(spark, sf_dir)))


@query(feeds("""SELECT * FROM web WHERE session_id IS NOT NULL AND "timestamp" IS NOT NULL""",
             "web"))
def flt_web_required(spark, sf_dir):
    return filters.web_required(_web(spark, sf_dir))


@query(feeds("""SELECT id, customer_id, interaction_type, rating, "timestamp" FROM crm
WHERE customer_id IS NOT NULL""", "crm"))
def flt_crm_required(spark, sf_dir):
    return _crm(spark, sf_dir)


@query(feeds("""SELECT id, customer_id, interaction_type, rating, "timestamp" FROM crm
WHERE customer_id IS NOT NULL AND customer_id <> 0""", "crm"))
def flt_truthy_id(spark, sf_dir):
    return filters.truthy(fixtures.crm_of(fixtures.events(spark, sf_dir)), "customer_id")


@query(feeds(f"SELECT id, customer_id, interaction_type, rating FROM crm WHERE {_ENGAGED}",
             "crm"))
def flt_engagement(spark, sf_dir):
    return filters.engagement(_crm(spark, sf_dir)).select(
        "id", "customer_id", "interaction_type", "rating")


@query(feeds("SELECT id, customer_id, rating FROM crm WHERE interaction_type = 'Feedback'", "crm"))
def flt_interaction_type(spark, sf_dir):
    crm = fixtures.crm_of(fixtures.events(spark, sf_dir))
    return filters.of_type(crm, "Feedback").select("id", "customer_id", "rating")


@query(feeds(_ENGAGEMENT, "crm"))
def agg_engagement_score(spark, sf_dir):
    return rounded(marketing.engagement_score(_crm(spark, sf_dir)))


@query(feeds(_ACTIVITY, "web"))
def agg_session_activity(spark, sf_dir):
    return marketing.session_activity(filters.web_required(_web(spark, sf_dir)))


@query(feeds(_METRICS, "web"))
def agg_session_metrics(spark, sf_dir):
    web = filters.web_required(_web(spark, sf_dir))
    return rounded(marketing.session_metrics(marketing.session_activity(web)))


@query(feeds(_LOYALTY, "crm"))
def agg_loyalty_rate(spark, sf_dir):
    return rounded(marketing.loyalty_rate(_crm(spark, sf_dir)))


@query(feeds(MART, "web", "crm"))
def join_cross_kpis(spark, sf_dir):
    crm, web = _crm(spark, sf_dir), filters.web_required(_web(spark, sf_dir))
    return rounded(marketing.cross_kpis(
        marketing.engagement_score(crm),
        marketing.session_metrics(marketing.session_activity(web)),
        marketing.loyalty_rate(crm)))


@query(feeds(f"SELECT *, '2024-02-01 00:00:00' AS kpi_date FROM ({MART})", "web", "crm"))
def mart_marketing(spark, sf_dir):
    events = fixtures.events(spark, sf_dir)
    return rounded(marketing.marketing_kpis(fixtures.web_of(events), fixtures.crm_of(events),
                                            "2024-02-01 00:00:00"))
