"""Customer-support KPIs: feedback score, interaction volume, time to resolution.

Two definitions exist side by side. The batch one rates feedback rows only and takes a
customer's span of complaints as resolution time in seconds. The stream one rates every row with
a valid rating and measures minutes from the previous interaction to each resolution.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import number, ratio
from ..operators.enrichment import ISO, kpi_stamp
from ..operators.filters import crm_required, is_usable, of_type, rating_in_range, truthy
from ..operators.previous import previous_instant
from ..schemas import COMPLAINT, FEEDBACK, RESOLUTION
from .marketing import cross_kpis


def feedback_score(crm: DataFrame) -> DataFrame:
    score = F.avg(F.when(F.col("interaction_type") == FEEDBACK, number(F.col("rating"))))
    return crm.agg(F.coalesce(score, F.lit(0.0)).alias("feedback_score"))


def feedback_score_any(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.coalesce(F.avg("rating"), F.lit(0.0)).alias("feedback_score"))


def interaction_volume(crm: DataFrame) -> DataFrame:
    return crm.groupBy("interaction_type").agg(F.count("*").alias("volume"))


def interaction_volume_sorted(crm: DataFrame) -> DataFrame:
    volume = interaction_volume(crm.filter(F.col("interaction_type").isNotNull()))
    return volume.orderBy(F.desc("volume"), "interaction_type")


def _volume_json(type_name: Column) -> Column:
    """Volumes per type as one JSON object with sorted keys.

    Only rows already counted per type come together here, as many as the text has entries.
    """
    counted = type_name.isNotNull() & (F.col("volume") > 0)
    entry = F.when(counted, F.struct(type_name, F.col("volume")))
    return F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry))))


def interaction_volume_json(crm: DataFrame, name: str = "interaction_volume",
                            null_name: str | None = None) -> DataFrame:
    """All volumes in one text; rows without a type count under ``null_name`` or not at all."""
    kind = F.col("interaction_type")
    if null_name is not None:
        kind = F.coalesce(kind, F.lit(null_name))
    volume = interaction_volume(crm.withColumn("interaction_type", kind))
    return volume.agg(_volume_json(F.col("interaction_type")).alias(name))


def complaint_span(crm: DataFrame) -> DataFrame:
    """Average over customers of the whole seconds between first and last complaint.

    Rows without a customer form one group, as any other customer.
    """
    moment = number(F.col("timestamp"))
    spans = of_type(crm, COMPLAINT).groupBy("customer_id").agg(
        (F.max(moment) - F.min(moment)).cast("bigint").alias("span"))
    return spans.agg(F.coalesce(F.avg("span"), F.lit(0.0)).alias("time_to_resolution"))


def support_kpis(crm: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """The support mart, batch definition: score and volumes share one aggregate per type."""
    kind = F.coalesce(F.col("interaction_type"), F.lit("null"))
    per_type = crm.groupBy(kind.alias("interaction_type")).agg(
        F.count("*").alias("volume"), F.avg(number(F.col("rating"))).alias("score"))
    score = F.max(F.when(F.col("interaction_type") == FEEDBACK, F.col("score")))
    volumes = per_type.agg(
        F.coalesce(score, F.lit(0.0)).alias("feedback_score"),
        _volume_json(F.col("interaction_type")).alias("interaction_volume"))
    return kpi_stamp(cross_kpis(volumes, complaint_span(crm)), as_of, "timestamp", ISO)


def clean_interactions(records: DataFrame) -> DataFrame:
    """Records of a customer, complete and with a usable or missing rating."""
    return rating_in_range(crm_required(truthy(records, "customer_id", numeric=True), timestamp_too=True))


def _clean(records: DataFrame) -> Column:
    """``clean_interactions`` as a condition."""
    return (F.col("customer_id").isNotNull() & F.col("timestamp").isNotNull()
            & F.coalesce(is_usable(number(F.col("rating"))), F.lit(True)))


def _instants(rows: DataFrame, clean: Column) -> DataFrame:
    """Rows counted per customer, instant and type, with the time of the interaction before; rows
    that aren't clean share one group. ``minutes`` and ``resolved`` are those of the resolutions
    that have an interaction before them.

    Interactions of one instant follow each other without delay, so that their first one alone looks
    back.
    """
    first = F.min("id") if "id" in rows.columns else F.lit(None).cast("string")
    rating = number(F.col("rating")) if "rating" in rows.columns else F.lit(None).cast("double")
    flagged = rows.withColumn("clean", clean)
    kept = [F.when(F.col("clean"), F.col(c)).alias(c) for c in ("customer_id", "timestamp", "interaction_type")]
    counted = flagged.groupBy(*kept, "clean").agg(
        F.count("*").alias("n"), first.alias("first_id"),
        F.sum(F.when(F.col("clean"), rating)).alias("total"),
        F.count(F.when(F.col("clean"), rating)).alias("rated"))
    seen = previous_instant(counted, "customer_id", "timestamp", ["first_id", "interaction_type"],
                            "prev_timestamp")
    resolution = F.col("clean") & (F.col("interaction_type") == RESOLUTION)
    return seen.withColumns({
        "minutes": F.when(resolution, (F.col("timestamp") - F.col("prev_timestamp")) / F.lit(60.0)),
        "resolved": F.when(resolution, F.col("n") - F.col("prev_timestamp").isNull().cast("bigint")),
    })


def time_to_resolution(cleaned: DataFrame) -> DataFrame:
    """Average minutes from the previous interaction to a resolution.

    A resolution that is the first interaction of its customer is left out.
    """
    average = ratio(F.sum("minutes"), F.sum("resolved"))
    return _instants(cleaned, F.lit(True)).agg(
        F.coalesce(average, F.lit(0.0)).alias("avg_time_to_resolution_minutes"))


def support_kpis_of_records(records: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """The support mart, stream definition.

    No row when no record has a customer; zeros when cleaning leaves nothing. All KPIs come from
    sums per customer, instant and type, and the records are read once: those that cleaning
    removes are counted beside the others.
    """
    routed = truthy(records, "customer_id", numeric=True)
    per_type = _instants(routed, _clean(routed)).groupBy("interaction_type").agg(
        F.sum(F.when(F.col("clean"), F.col("n"))).alias("volume"), F.sum("n").alias("routed"),
        *[F.sum(c).alias(c) for c in ("total", "rated", "minutes", "resolved")])

    def average(top: str, bottom: str) -> Column:
        return F.coalesce(ratio(F.sum(top), F.sum(bottom)), F.lit(0.0))

    figures = per_type.agg(
        average("total", "rated").alias("feedback_score"),
        _volume_json(F.col("interaction_type")).alias("interaction_volume_by_type"),
        average("minutes", "resolved").alias("avg_time_to_resolution_minutes"),
        F.sum("routed").alias("routed"))
    return kpi_stamp(figures.filter(F.col("routed") > 0).drop("routed"), as_of)
