"""Marketing KPIs: engagement score, session duration, bounce rate, loyalty rate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import number, percent, ratio
from ..operators.enrichment import kpi_stamp
from ..operators.filters import crm_required, is_engagement, is_truthy, web_required
from ..schemas import LOYALTY

# KPI columns of the report, in its order.
KPIS = ["customer_engagement_score", "avg_session_duration", "bounce_rate_percent",
        "loyalty_activity_rate_percent"]


def _engagement() -> Column:
    return F.avg(F.when(is_engagement(), number(F.col("rating"))))


def _loyalty() -> Column:
    loyal = F.count_if(F.col("interaction_type") == LOYALTY)
    return F.coalesce(percent(loyal, F.count("*")), F.lit(0.0))


def engagement_score(crm: DataFrame) -> DataFrame:
    """Average rating of feedback and complaints; null when there is none."""
    return crm.agg(_engagement().alias(KPIS[0]))


def loyalty_rate(crm: DataFrame) -> DataFrame:
    return crm.agg(_loyalty().alias(KPIS[3]))


def session_activity(web: DataFrame) -> DataFrame:
    moment = number(F.col("timestamp"))
    return (web.groupBy("session_id")
            .agg(F.min(moment).alias("start_time"), F.max(moment).alias("end_time"),
                 F.count("*").alias("event_count"))
            .withColumns({
                "session_duration": F.col("end_time") - F.col("start_time"),
                "is_bounce": (F.col("event_count") == 1).cast("int"),
            }))


def session_metrics(activity: DataFrame) -> DataFrame:
    return activity.agg(F.avg("session_duration").alias(KPIS[1]),
                        percent(F.sum("is_bounce"), F.count("*")).alias(KPIS[2]))


def _single(df: DataFrame) -> DataFrame:
    """``df`` reduced to its row; an error if it has several."""
    fits = F.when(F.col("_rows") > 1, F.raise_error(F.lit("KPIs side by side need a row each")).cast("boolean"))
    row = df.agg(F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in df.columns])
    return row.filter(fits.otherwise(F.col("_rows") == 1)).drop("_rows")


def cross_kpis(*one_row_frames: DataFrame) -> DataFrame:
    """Side by side; every input has a single row, or none, which leaves no result."""
    combined, *others = one_row_frames
    for other in others:
        combined = combined.crossJoin(F.broadcast(_single(other)))
    return combined


def marketing_kpis(web: DataFrame, crm: DataFrame,
                   as_of: dt.datetime | str | None = None) -> DataFrame:
    """The marketing mart: one row, nulls where there is nothing to average.

    Engagement and loyalty come from one pass over the CRM feed.
    """
    from_crm = crm_required(crm).agg(_engagement().alias(KPIS[0]), _loyalty().alias(KPIS[3]))
    sessions = session_metrics(session_activity(web_required(web)))
    return kpi_stamp(cross_kpis(from_crm, sessions).select(*KPIS), as_of)


def marketing_kpis_of_records(records: DataFrame,
                              as_of: dt.datetime | str | None = None) -> DataFrame:
    """Stream definition: zeros for missing KPIs, no row when no record has an id.

    A record with both a session and a customer id counts on both sides. All KPIs come from sums per
    session, so that the records are read once.
    """
    is_crm, is_web = is_truthy(records, "customer_id", numeric=True), is_truthy(records, "session_id")
    moment = number(F.col("timestamp"))
    rating = F.when(is_crm & is_engagement(), number(F.col("rating")))
    # Records that belong to no session share the null one.
    session = F.when(is_web & F.col("timestamp").isNotNull(), F.col("session_id")).alias("session_id")
    per_session = records.groupBy(session).agg(
        (F.max(moment) - F.min(moment)).alias("duration"), F.count("*").alias("events"),
        F.sum(rating).alias("rating"), F.count(rating).alias("rated"),
        F.count_if(is_crm & (F.col("interaction_type") == LOYALTY)).alias("loyal"),
        F.count_if(is_crm).alias("crm"), F.count_if(is_crm | is_web).alias("routed"))
    known = F.col("session_id").isNotNull()
    kpis = per_session.agg(
        ratio(F.sum("rating"), F.sum("rated")).alias(KPIS[0]),
        F.avg(F.when(known, F.col("duration"))).alias(KPIS[1]),
        percent(F.count_if(known & (F.col("events") == 1)), F.count_if(known)).alias(KPIS[2]),
        percent(F.sum("loyal"), F.sum("crm")).alias(KPIS[3]),
        F.sum("routed").alias("routed")).filter(F.col("routed") > 0)
    return kpi_stamp(kpis.select(*[F.coalesce(k, F.lit(0.0)).alias(k) for k in KPIS]), as_of)
