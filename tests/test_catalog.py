import uuid

import pytest
from pyspark.sql import functions as F

from storelens.plans import adhoc
from storelens.sinks import catalog
from storelens.sources import tables


@pytest.fixture()
def database(spark, tmp_path):
    name = f"catalog_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_runs_are_partitions_and_a_rerun_replaces_its_own(spark, database):
    for stamp, n in (("r1", 3), ("r2", 5), ("r2", 4)):
        assert catalog.write_run(spark.range(n).withColumn("x", F.lit("a")), "t", database, stamp) == stamp
    rows = tables.read_table(spark, "t", database)
    assert {r["run_ts"]: r["count"] for r in rows.groupBy("run_ts").count().collect()} == {"r1": 3, "r2": 4}
    assert sorted(r[0] for r in tables.runs_of(spark, "t", database).collect()) == ["r1", "r2"]
    assert tables.read_latest_run(spark, "t", database).count() == 4


def test_only_the_last_run_is_scanned(spark, database):
    for stamp in ("r1", "r2", "r3"):
        catalog.write_run(spark.range(10, numPartitions=1), "t", database, stamp)
    latest = tables.read_latest_run(spark, "t", database)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_ts" in plan and "InMemoryFileIndex(1 paths)" in plan
    assert len(latest.select(F.input_file_name()).distinct().collect()) == 1
    asked = adhoc.query(spark, "SELECT count(*) AS n FROM {t} WHERE run_ts = 'r2'",
                        t=tables.read_table(spark, "t", database))
    assert asked.first()["n"] == 10


def test_statistics_of_a_run_are_in_the_catalog(spark, database):
    catalog.write_run(spark.range(7), "t", database, "r1")
    facts = spark.sql(f"DESCRIBE EXTENDED {database}.t PARTITION (run_ts = 'r1')").collect()
    assert any("7 rows" in (r["data_type"] or "") for r in facts)


def test_columns_go_by_name_and_must_fit(spark, database):
    catalog.write_run(spark.sql("SELECT 1 AS a, 'x' AS b"), "t", database, "r1")
    catalog.write_run(spark.sql("SELECT 'y' AS b, 2 AS a"), "t", database, "r2")
    assert tuple(tables.read_latest_run(spark, "t", database).select("a", "b").first()) == (2, "y")
    with pytest.raises(ValueError, match="columns"):
        catalog.write_run(spark.sql("SELECT 1 AS a"), "t", database, "r3")
    with pytest.raises(ValueError, match="stamp"):
        catalog.write_run(spark.sql("SELECT 1 AS a, 'x' AS b"), "t", database, "r4' OR '1'='1")


def test_empty_runs(spark, database):
    catalog.write_run(spark.range(0), "t", database, "r1")
    assert tables.read_latest_run(spark, "t", database).count() == 0
    spark.range(1).withColumn("run_ts", F.lit("x")).limit(0).write.partitionBy("run_ts").saveAsTable(f"{database}.none")
    assert tables.read_latest_run(spark, "none", database).count() == 0
