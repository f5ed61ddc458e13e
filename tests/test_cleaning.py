import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions import epoch
from storelens.functions.numbers import number, percent, ratio
from storelens.functions.payload import decode_text, tagged_item
from storelens.operators import cleaning, enrichment, filters, quality, validation
from storelens.plans import quality_job


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(0.0,), (86399.9,), (86400.0,), (-0.5,), (-1.0,), (None,),
                                (float("nan"),), (1746432371.8444808,)], "t double")
    rows = df.select(epoch.as_date(F.col("t")), epoch.as_text(F.col("t")),
                     epoch.as_timestamp(F.col("t"))).collect()
    assert [r[0] for r in rows] == [
        dt.date(1970, 1, 1), dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1970, 1, 1),
        dt.date(1969, 12, 31), None, None, dt.date(2025, 5, 5)]
    assert rows[1][1] == "1970-01-01 23:59:59"
    assert rows[7][1] == "2025-05-05 08:06:11"
    assert rows[7][2] == dt.datetime(2025, 5, 5, 8, 6, 11, 844480)
    assert rows[5][1:] == rows[6][1:] == (None, None)


def test_numbers(spark):
    df = spark.createDataFrame([("3.5",), ("n/a",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(number(F.col("v"))).collect()] == [3.5, None, None, None]
    row = spark.range(1).select(ratio(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(4)),
                                ratio(F.lit(None).cast("int"), F.lit(0))).first()
    assert tuple(row) == (None, 25.0, None)


def test_truthy_by_type(spark):
    df = spark.createDataFrame([(0, ""), (None, None), (5, "0")], "n bigint, s string")
    assert [r.n for r in filters.truthy(df, "n").collect()] == [5]
    assert [r.s for r in filters.truthy(df, "s").collect()] == ["0"]
    assert filters.truthy(df, "s", numeric=True).count() == 0


def test_rating_range(spark):
    df = spark.createDataFrame([("0",), ("1",), ("5",), ("5.1",), ("n/a",), ("NaN",), (None,),
                                ("inf",)], "rating string")
    kept = [r.rating for r in filters.rating_in_range(df).collect()]
    assert kept == [1.0, 5.0, None, None, None]
    without = df.select(F.lit(1).alias("x"))
    assert filters.rating_in_range(without).count() == 8


def test_required_columns_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), (None, 1.0)], "session_id string, timestamp double")
    df.write.parquet(f"{tmp_path}/web")
    kept = filters.web_required(spark.read.parquet(f"{tmp_path}/web"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(session_id), IsNotNull(timestamp)" in plan


def test_fill_and_require(spark):
    df = spark.createDataFrame([(None, None)], "value_column double, date_column timestamp")
    filled = cleaning.fill_defaults(df).first()
    assert tuple(filled) == (0.0, dt.datetime(1900, 1, 1))
    odd = spark.createDataFrame([(float("nan"),)], "value_column double")
    assert cleaning.fill_defaults(odd).first().value_column == 0.0
    grown = cleaning.require_columns(df, quality_job.REQUIRED)
    assert grown.columns == ["value_column", "date_column", "common_column"]
    assert grown.schema["common_column"].dataType == T.StringType()
    mixed = spark.createDataFrame([(None, None, None)], "a int, b string, c timestamp")
    assert tuple(cleaning.fill_zero(mixed).first()) == (0, None, None)


def test_duplicates_and_types(spark):
    df = spark.createDataFrame([("1.5", "2020-01-02 03:04:05"), ("1.5", "2020-01-02 03:04:05"),
                                ("x", "y")], "value_column string, date_column string")
    typed = cleaning.standardise_types(cleaning.drop_duplicate_rows(df))
    assert {tuple(r) for r in typed.collect()} == {
        (1.5, dt.datetime(2020, 1, 2, 3, 4, 5)), (None, None)}


def test_validation_of_values(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1899, 12, 31), -1.0), (dt.datetime(1900, 1, 1), 0.0),
         (dt.datetime(2030, 1, 1), 1e6), (None, None), (dt.datetime(2000, 1, 1), 1000000.5)],
        "date_column timestamp, value_column double")
    checked = validation.value_check(validation.date_check(df, "2024-01-01 00:00:00"))
    assert [(r.date_validation, r.value_validation) for r in checked.collect()] == [
        ("Invalid date", "Out of range"), ("Valid", "Valid"), ("Invalid date", "Valid"),
        ("Valid", "Valid"), ("Valid", "Out of range")]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 3, 23),), (dt.datetime(2024, 2, 5, 1),),
                                (None,)], "date_column timestamp")
    rows = enrichment.days_since_first(enrichment.weekend_flag(enrichment.date_parts(df))).collect()
    assert sorted([tuple(r)[1:] for r in rows], key=str) == [
        (2024, 2, 3, 7, True, 0), (2024, 2, 5, 2, False, 2), (None, None, None, None, False, None)]


def b64(text):
    import base64
    return base64.b64encode(text if isinstance(text, bytes) else text.encode()).decode()


def test_record_results(spark):
    full = '{"customer_id":1,"interaction_type":"","timestamp":"x"}'
    cases = {
        b64(full): "Ok",
        b64('{"customer_id":[1],"interaction_type":{"a":1},"timestamp":false}'): "Ok",
        b64('{"customer_id":null,"interaction_type":"a","timestamp":1}'): "Dropped",
        b64("{}"): "Dropped", b64("[]"): "Dropped", b64(f"[{full}]"): "Dropped",
        b64("5"): "ProcessingFailed", b64("null"): "ProcessingFailed",
        b64("{bad"): "ProcessingFailed", b64(""): "ProcessingFailed",
        b64(b"\xff\xfe{}"): "ProcessingFailed", "!!!": "ProcessingFailed",
    }
    raw = spark.createDataFrame([(str(i), d) for i, d in enumerate(cases)],
                                "recordId string, data string")
    validated = validation.validate_records(raw)
    assert validated.columns == ["recordId", "data", "result"]
    assert {r.data: r.result for r in validated.collect()} == cases
    assert tuple(validation.result_counts(validated).first()) == (12, 2, 10)
    nothing = spark.createDataFrame([(None,)], "data string")
    assert validation.validate_records(nothing).first().result == "ProcessingFailed"


def test_decode(spark):
    df = spark.createDataFrame([(b64("é"),), ("%%%",), (b64(b"\xff"),), (None,)], "d string")
    assert [r[0] for r in df.select(decode_text(F.col("d"))).collect()] == ["é", None, None, None]


def test_tagged_items(spark):
    schema = T.StructType.fromDDL(
        "s string, n int, d decimal(5,2), b boolean, l array<struct<x:int>>, m map<string,array<string>>")
    df = spark.createDataFrame([("a\"b", 1, None, True, [(1,), (None,)], {"k": ["v", None]}),
                                (None,) * 6], schema)
    items = [json.loads(r[0]) for r in df.select(tagged_item(schema)).collect()]
    assert items[0] == {
        "s": {"S": 'a"b'}, "n": {"N": "1"}, "d": {"NULL": True}, "b": {"BOOL": True},
        "l": {"L": [{"M": {"x": {"N": "1"}}}, {"M": {"x": {"NULL": True}}}]},
        "m": {"M": {"k": {"L": [{"S": "v"}, {"NULL": True}]}}}}
    assert items[1] == {name: {"NULL": True} for name in schema.names}


def test_quality_metrics(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 1.0), (3, "a", None), (3, "b", None)],
                               "id int, s string, v double")
    assert {tuple(r) for r in quality.completeness(df).collect()} == {
        ("id", 1.0), ("s", 0.75), ("v", 0.5)}
    assert {tuple(r) for r in quality.uniqueness(df).collect()} == {
        ("id", 0.75), ("s", 0.75), ("v", 0.5)}
    stats = {r.column: tuple(r)[1:] for r in quality.numeric_stats(df).collect()}
    assert stats["v"] == (1.0, 0.0, 1.0, 1.0)
    profile = {r.column: r for r in quality.profile(df).collect()}
    assert profile["s"].uniqueness == 0.75 and profile["s"].mean is None
    assert profile["id"].max == 3.0
    empty = df.limit(0)
    assert {r.completeness for r in quality.completeness(empty).collect()} == {None}
    assert {r.uniqueness for r in quality.uniqueness(empty).collect()} == {None}


def test_outliers(spark):
    rows = [(0.0,)] * 50 + [(1000.0,), (None,)]
    flagged = quality.flag_outliers(spark.createDataFrame(rows, "v double"))
    assert [r.v for r in flagged.filter("v_is_outlier").collect()] == [1000.0]
    single = spark.createDataFrame([(5.0,)], "v double")
    assert quality.flag_outliers(single).first().v_is_outlier is False


def test_quality_job_adds_missing_columns(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,)], "value_column string")
    rows = quality_job.quality_rows(df, "2024-01-01 00:00:00").collect()
    assert sorted(r.value_column for r in rows) == [0.0, 1.0]
    assert {r.date_column for r in rows} == {dt.datetime(1900, 1, 1)}
    assert {(r.date_validation, r.days_since_first_event) for r in rows} == {("Valid", 0)}
