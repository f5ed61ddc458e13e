"""What the physical plans must and must not contain."""

import re

import pytest

from storelens.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
# Queries that write files before they return are left to the other tests.
READING = sorted(name for name in REGISTRY
                 if not name.startswith(("snk_", "st_", "job_bronze", "src_csv", "src_json",
                                         "src_stream", "src_parquet_typed")))


def plan_of(spark, name):
    return REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", READING)
def test_plan_spreads_its_work(spark, name):
    """No Python, no cartesian product; what meets in one task was aggregated or limited before."""
    plan = plan_of(spark, name)
    assert not re.search("EvalPython|MapInPandas|MapInArrow|FlatMapGroups|CartesianProduct", plan)
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "SinglePartition" in line:
            assert re.search("Aggregate|LocalLimit", below), (line, below)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_support_stream_reads_once(spark):
    """One scan, one parse: what the customers' slices need twice is shuffled once."""
    plan = final_plan(REGISTRY["mart_support_stream"].run(spark, SF_DIR))
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    plan = final_plan(REGISTRY["st_marketing_kpis"].run(spark, SF_DIR))
    assert "InMemoryTableScan" not in plan


def test_quality_job_cleans_once(spark):
    """The duplicates are removed by one shuffle of whole rows, which both sides of the job use."""
    plan = final_plan(REGISTRY["job_quality"].run(spark, SF_DIR))
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("name, scans, joins", [
    ("mart_sales", 3, 1), ("mart_operations", 3, 1), ("mart_marketing", 2, 0),
    ("mart_support_batch", 2, 0), ("job_quality_profile", 1, 0)])
def test_scans_and_joins(spark, name, scans, joins):
    """The fixture inventory reads two tables and joins them."""
    plan = plan_of(spark, name)
    assert plan.count("FileScan") == scans
    fixture_joins = 1 if name in ("mart_sales", "mart_operations") else 0
    found = len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[", plan))
    assert found - fixture_joins == joins
