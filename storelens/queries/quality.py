"""Data-quality metrics and the whole quality job."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures
from ..operators import quality, sketches
from ..plans import quality_job
from ..session import work_dir
from .registry import calendar, feeds, query, rounded

_COLUMNS = ["o_orderkey", "common_column", "value_column", "date_column"]
_NUMERIC = ["o_orderkey", "value_column"]


def _each(template: str, columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {template.format(c=c)} FROM {table}" for c in columns)


_COMPLETE = "round(count({c}) / count(*), 9) AS completeness"
_UNIQUE = ("round((count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"
           " / count(*), 9) AS uniqueness")
_STATS = ('round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS "stddev", '
          'round(CAST(min({c}) AS DOUBLE), 4) AS "min", round(CAST(max({c}) AS DOUBLE), 4) AS "max"')
_NO_STATS = ('CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS "stddev", '
             'CAST(NULL AS DOUBLE) AS "min", CAST(NULL AS DOUBLE) AS "max"')


def _outlier(column: str, table: str) -> str:
    return (f"coalesce({column} > (SELECT avg({column}) + 3 * stddev_samp({column}) FROM {table})"
            f" OR {column} < (SELECT avg({column}) - 3 * stddev_samp({column}) FROM {table}),"
            f" false) AS {column}_is_outlier")


@query(feeds(_each(_COMPLETE, _COLUMNS, "quality"), "quality"))
def agg_dq_completeness(spark, sf_dir):
    return rounded(quality.completeness(fixtures.quality_dataset(spark, sf_dir)), 9)


@query(feeds(_each(_UNIQUE, _COLUMNS, "quality"), "quality"))
def agg_dq_uniqueness(spark, sf_dir):
    return rounded(quality.uniqueness(fixtures.quality_dataset(spark, sf_dir)), 9)


@query(feeds(_each(f"{_COMPLETE}, true AS close", _COLUMNS, "quality"), "quality"))
def agg_dq_uniqueness_merged(spark, sf_dir):
    """Sketches stored per year and merged; ``close`` holds where the estimate is within 3 % of the
    exact share of distinct values."""
    rows = fixtures.quality_dataset(spark, sf_dir)
    path = work_dir(spark, "sketches")
    by_year = sketches.column_sketches(rows.withColumn("year", F.year("date_column")), "year")
    by_year.write.partitionBy("year").parquet(path)
    merged = sketches.merged_profile(spark.read.schema(by_year.schema).parquet(path))
    exact = quality.uniqueness(rows).withColumnRenamed("uniqueness", "exact")
    close = F.abs(F.col("uniqueness") - F.col("exact")) <= 0.03 * F.col("exact")
    return rounded(merged.join(exact, "column").select("column", "completeness", close.alias("close")), 9)


@query(feeds(_each(_STATS, _NUMERIC, "quality"), "quality"))
def agg_dq_numeric_stats(spark, sf_dir):
    return rounded(quality.numeric_stats(fixtures.quality_dataset(spark, sf_dir)), 4)


@query(feeds(f"SELECT o_orderkey, value_column, {_outlier('value_column', 'quality')} FROM quality",
             "quality"))
def agg_dq_outliers(spark, sf_dir):
    rows = fixtures.quality_dataset(spark, sf_dir).select("o_orderkey", "value_column")
    return quality.flag_outliers(rows, ["value_column"])


@query(feeds(f"""SELECT o_orderkey, common_column, value_column,
  strftime(date_column, '%Y-%m-%d %H:%M:%S') AS date_column,
  {_outlier('o_orderkey', 'tidy')}, {_outlier('value_column', 'tidy')},
  CASE WHEN year(date_column) < 1900 OR date_column > TIMESTAMP '2001-01-01 00:00:00'
    THEN 'Invalid date' ELSE 'Valid' END AS date_validation,
  CASE WHEN value_column < 0 OR value_column > 1000000
    THEN 'Out of range' ELSE 'Valid' END AS value_validation,
  {calendar('date_column')}, dayofweek(date_column) IN (0, 6) AS is_weekend,
  CAST(date_diff('day', CAST((SELECT min(date_column) FROM tidy) AS DATE),
    CAST(date_column AS DATE)) AS INTEGER) AS days_since_first_event
FROM tidy""", "quality", "tidy"))
def job_quality(spark, sf_dir):
    return quality_job.quality_rows(fixtures.quality_dataset(spark, sf_dir),
                                    "2001-01-01 00:00:00")


@query(feeds(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {_COMPLETE.format(c=c)}, {_UNIQUE.format(c=c)}, "
    f"{(_STATS if c in _NUMERIC else _NO_STATS).format(c=c)} FROM tidy" for c in _COLUMNS),
    "quality", "tidy"))
def job_quality_profile(spark, sf_dir):
    report = quality_job.quality_profile(fixtures.quality_dataset(spark, sf_dir))
    digits = {"completeness": 9, "uniqueness": 9, "mean": 4, "stddev": 4, "min": 4, "max": 4}
    return report.withColumns({name: F.round(name, d) for name, d in digits.items()})
