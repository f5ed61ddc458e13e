import pytest
from pyspark.sql import functions as F

from storelens.operators import quality, sketches


def profile_of(df, *by):
    return {tuple(r[c] for c in (*by, "column")): (r["completeness"], r["uniqueness"]) for r in df.collect()}


@pytest.fixture()
def rows(spark):
    return spark.range(60_000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 7_000).alias("few"), (F.col("id") * 0.5).alias("many"),
        F.lit(None).cast("string").alias("none"), F.to_date(F.lit("2024-01-01")).alias("one"),
        (F.col("id") % 4).alias("part"))


def test_merged_parts_agree_with_the_whole(rows, tmp_path):
    sketches.column_sketches(rows, "part").write.partitionBy("part").parquet(f"{tmp_path}/s")
    merged = profile_of(sketches.merged_profile(rows.sparkSession.read.parquet(f"{tmp_path}/s")))
    assert merged == profile_of(sketches.merged_profile(sketches.column_sketches(rows.drop("part"))))
    whole = rows.drop("part")
    share = {r["column"]: r["completeness"] for r in quality.completeness(whole).collect()}
    exact = {r["column"]: r["uniqueness"] for r in quality.uniqueness(whole).collect()}
    for (name,), (completeness, uniqueness) in merged.items():
        assert completeness == share[name]
        assert uniqueness == pytest.approx(exact[name], rel=0.03)
    assert merged[("none",)] == (0.0, 1 / 60_000) and merged[("one",)][1] == 1 / 60_000


def test_a_new_part_needs_no_old_data(rows, tmp_path):
    path = f"{tmp_path}/s"
    for part in range(3):
        new = rows.filter(F.col("part") == part).drop("part")
        sketches.column_sketches(new).write.parquet(f"{path}/part={part}")
    stored = rows.sparkSession.read.parquet(path)
    assert profile_of(sketches.merged_profile(stored)).keys() == {(c,) for c in ("few", "many", "none", "one")}
    assert stored.filter("column = 'many'").agg(F.sum("rows")).first()[0] == 45_000
    each = profile_of(sketches.merged_profile(stored, "part"), "part")
    assert each[(1, "few")][0] == 1.0 and each[(0, "few")][0] == pytest.approx(0.8)


def test_empty_tables_and_odd_names(spark):
    empty = spark.createDataFrame([], "`a.b` int, rows string, sketch date")
    assert profile_of(sketches.merged_profile(sketches.column_sketches(empty))) == {
        (c,): (None, None) for c in empty.columns}
    assert sketches.column_sketches(empty, "rows").count() == 0
    one = spark.createDataFrame([(1, None, None)], empty.schema)
    assert profile_of(sketches.merged_profile(sketches.column_sketches(one)))[("a.b",)] == (1.0, 1.0)
