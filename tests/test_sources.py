import json

import pytest
from pyspark.sql import functions as F

from storelens.plans import adhoc, silver
from storelens.schemas import INVENTORY, POS
from storelens.sources import landing, notifications, records, tables

HEADER = "transaction_id,store_id,product_id,quantity,revenue,discount_applied,timestamp\n"


def test_csv_landing_takes_any_case_of_the_extension(spark, tmp_path):
    (tmp_path / "day1").mkdir()
    (tmp_path / "day1" / "a.csv").write_text(HEADER + "t1,1,2,3,4.5,,1700000000.25\n")
    (tmp_path / "b.CSV").write_text(HEADER + "t2,1,2,3,4.5,0.1,1\n")
    (tmp_path / "c.txt").write_text(HEADER + "t3,1,2,3,4.5,,1\n")
    rows = landing.read_csv(spark, str(tmp_path), POS).orderBy("transaction_id").collect()
    assert [tuple(r) for r in rows] == [("t1", 1, 2, 3, 4.5, None, 1700000000.25),
                                        ("t2", 1, 2, 3, 4.5, 0.1, 1.0)]


def test_csv_columns_go_by_name_and_nothing_is_lost(spark, tmp_path):
    (tmp_path / "moved.csv").write_text(HEADER.replace("store_id,product_id", "product_id, store_id")
                                        + "t1,1,2,3.0,4.5,,1\n\n")
    (tmp_path / "other.csv").write_text(
        '\ufefftransaction_id,note,store_id,product_id,quantity,revenue,timestamp\r\n'
        '"t,2","two\nlines, ""quoted""",1,9007199254740993,1e2,NaN, 7 \r\nt3,short\r\n', newline="")
    (tmp_path / "odd.csv").write_text(HEADER + "t4,1,2,abc,4.5,,x\nt5,1,2,3,4,5,6,7\nt6,1,2,3,4.5,,1\n")
    (tmp_path / "bytes.csv").write_bytes(HEADER.encode() + b"t7,\xff\n")
    (tmp_path / "quote.csv").write_text(HEADER + 't8,1,"2\n')
    (tmp_path / "empty.csv").write_text("")
    rows = landing.parse_csv(landing.files(spark, str(tmp_path), landing.CSV_GLOB), POS).cache()
    good = sorted(tuple(r) for r in landing.landed(rows, POS).collect())
    assert good == [("t,2", 1, 9007199254740993, 100, None, None, 7.0), ("t1", 2, 1, 3, 4.5, None, 1.0),
                    ("t3", None, None, None, None, None, None), ("t6", 1, 2, 3, 4.5, None, 1.0)]
    bad = {(r.path.rsplit("/", 1)[1], r.reject) for r in landing.rejected(rows).collect()}
    assert bad == {("odd.csv", "does not fit: quantity,timestamp"), ("odd.csv", landing.TOO_LONG),
                   ("bytes.csv", landing.UNREADABLE), ("quote.csv", landing.UNREADABLE)}
    assert rows.filter("line = 2 and reject like 'does%'").first().text == "t4,1,2,abc,4.5,,x"
    assert landing.read_csv(spark, str(tmp_path), POS).count() == 4
    rows.unpersist()


def test_csv_rows_after_a_bad_one_are_kept(spark, tmp_path):
    good = [f"t{i},1,2,3,4.5,,1\n" for i in range(7)]
    big = "x" * 200_000
    (tmp_path / "a.csv").write_bytes("".join(
        [HEADER, good[0], 't10,"x"y,3\n', good[1], f"{big},1,2,3,4.5,,1\n", good[2], 't11,"open\n', good[3],
         '"t,4",1,2,3,4.5,,1\n']).encode() + b"t12,\xff\n" + "".join(good[5:]).encode())
    rows = landing.parse_csv(landing.files(spark, str(tmp_path), landing.CSV_GLOB), POS).cache()
    ids = sorted(r.transaction_id for r in landing.landed(rows, POS).collect())
    assert ids == sorted(["t0", "t1", "t2", "t3", "t,4", "t5", "t6", big])
    bad = sorted((r.line, r.text, r.reject) for r in landing.rejected(rows).collect())
    assert bad == [(3, 't10,"x"y,3', landing.UNREADABLE), (7, 't11,"open', landing.UNREADABLE),
                   (10, "t12,\ufffd", landing.UNREADABLE)]
    rows.unpersist()


def test_json_elements_that_fit_are_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"inventory_id": "1", "stock_level": 2.0, "extra": 1}, 5,'
                                     ' {"inventory_id": "x"}, {"product_id": 3}]')
    (tmp_path / "b.json").write_text('[{"inventory_id": 1}')
    (tmp_path / "c.json").write_bytes(b"\xff")
    (tmp_path / "d.json").write_text("[]")
    rows = landing.parse_json(landing.files(spark, str(tmp_path), landing.JSON_GLOB), INVENTORY)
    good = landing.landed(rows, INVENTORY).select("inventory_id", "product_id", "stock_level")
    assert sorted(map(tuple, good.collect()), key=str) == [(1, None, 2), (None, 3, None)]
    assert sorted(r.reject for r in landing.rejected(rows).collect()) == [
        "does not fit: inventory_id", landing.NO_OBJECT, landing.UNREADABLE, landing.UNREADABLE]


def test_json_landing_reads_whole_documents(spark, tmp_path):
    rows = [{"inventory_id": i, "product_id": 7, "warehouse_id": 1, "stock_level": i,
             "restock_threshold": None, "last_updated": 1.5} for i in range(3)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "b.JSON").write_text(json.dumps(rows[0]))
    got = landing.read_json(spark, str(tmp_path), INVENTORY).collect()
    assert sorted(r.inventory_id for r in got) == [0, 0, 1, 2]
    assert {r.restock_threshold for r in got} == {None}


def test_typed_parquet_widens_narrow_files(spark, tmp_path):
    spark.sql("select 1 as inventory_id, 2 as product_id, 3 as warehouse_id, 4 as stock_level,"
              " 5 as restock_threshold, 6.5d as last_updated").write.parquet(f"{tmp_path}/i")
    row = tables.read_parquet(spark, f"{tmp_path}/i", INVENTORY).first()
    assert tuple(row) == (1, 2, 3, 4, 5.0, 6.5)


def manifest(spark, *bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "message_id int, body string")
    return notifications.object_manifest(df)


def entry(bucket, key):
    return {"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}


def test_notifications(spark):
    found = manifest(
        spark,
        json.dumps({"Records": [entry("in", "pos/a%20b+c.csv"), entry("in", "pos/d.CSV")]}),
        json.dumps({"Records": [entry("out", "pos/a.csv")]}),
        json.dumps({"Records": [entry("in", "other/a.csv"), entry("in", "pos/a.txt")]}),
        json.dumps({"Records": [{"s3": {"bucket": {"name": "in"}}}, entry("in", "pos/%zz.csv")]}),
        json.dumps({"Event": "s3:TestEvent", "Bucket": "in"}),
        json.dumps({"hello": 1}), "no json", None, json.dumps({"Records": []}))
    rule = ("in", "pos/", ".csv")
    accepted = notifications.accepted_objects(found, *rule)
    assert sorted(r.key for r in accepted.collect()) == ["pos/a b c.csv", "pos/d.CSV"]
    outcomes = sorted((r.message_id, r.outcome) for r in found.collect())
    assert outcomes == [
        (0, "object"), (0, "object"), (1, "object"), (2, "object"), (2, "object"),
        (3, "bad entry"), (3, "bad entry"), (4, "test event"), (5, "bad message"),
        (6, "bad message"), (7, "bad message"), (8, "empty message")]
    assert tuple(notifications.manifest_counts(found, *rule).first()) == (2, 8)


def test_payload_of_one_or_many(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '[{"a":2},{"a":3}]'), (3, "{bad"), (4, "[]"),
                                (5, None), (6, '{"a":"x","b":"y"}'), (7, '[5,{"a":4},"x",[{"a":9}]]')], "k int, p string")
    got = records.explode_payload(df, "struct<a:bigint,b:string>", F.col("p"), ["k"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        (1, 1, None), (2, 2, None), (2, 3, None), (6, None, "y"), (7, 4, None)]


def test_function_events(spark):
    events = spark.createDataFrame([
        (json.dumps({"Records": [{"kinesis": {"data": "YQ=="}}, {"kinesis": {"data": "Yg=="}}]}),),
        (json.dumps({"invocationId": "x", "records": [{"recordId": "1", "data": "Yw=="}]}),),
        ("{bad",), (None,)], "event string")
    got = records.unpack_events(events).collect()
    assert [tuple(r) for r in got] == [(None, "YQ=="), (None, "Yg=="), ("1", "Yw==")]


def test_plain_payloads(spark):
    df = spark.createDataFrame([(bytearray(b'{"id":5}'),)], "value binary")
    assert records.parse_records(df, data="value", encoded=False).first().id == "5"


def test_ids_and_times_of_any_kind(spark):
    texts = ['{"customer_id":"C12","timestamp":"1700000000"}', '{"customer_id":7.0,"timestamp":1.5}',
             '{"customer_id":"007","id":9007199254740993,"timestamp":"soon"}', '{"customer_id":true,"more":[1]}']
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    rows = records.read_records(df, encoded=False)
    assert [(r.id, r.customer_id, r.timestamp) for r in rows.collect()] == [
        (None, "C12", 1700000000.0), (None, "7", 1.5), ("9007199254740993", "007", None), (None, "true", None)]
    assert [r.payload for r in rows.collect()] == texts


def test_record_parsing_happens_once(spark, tmp_path):
    spark.range(5).select(F.col("id").cast("string").alias("data")).write.parquet(f"{tmp_path}/r")
    parsed = records.parse_records(spark.read.parquet(f"{tmp_path}/r"))
    plan = (parsed.filter("customer_id <> 0 and rating is not null")
            ._jdf.queryExecution().executedPlan().toString())
    # One reads the elements of a payload, one the fields of an element.
    assert plan.count("from_json") == 2


def test_silver_copy_and_adhoc_sql(spark, tmp_path):
    spark.range(4).createOrReplaceTempView("bronze_a")
    spark.range(2).createOrReplaceTempView("bronze_b")
    written = silver.bronze_to_silver(spark, {"a": "bronze_a", "b": "bronze_b"}, str(tmp_path),
                                      stamp="2024-01-01_00-00-00")
    assert written["a"] == f"{tmp_path}/a/run_ts=2024-01-01_00-00-00"
    a, b = (spark.read.parquet(written[k]) for k in "ab")
    joined = adhoc.query(spark, "select count(*) n from {left_t} join {right_t} using (id)",
                         left_t=a, right_t=b)
    assert joined.first().n == 2
    assert spark.read.parquet(f"{tmp_path}/a").filter("run_ts = '2024-01-01_00-00-00'").count() == 4


def test_long_files_are_read_in_blocks(spark, tmp_path):
    """Blocks much shorter than the files: rows, rejects and line numbers are the same."""
    lines = [f"t{i},1,2,3,4.5,,1" for i in range(3_000)]
    lines[700], lines[2_000], lines[2_500] = "t700,1,2,x,4.5,,1", '"t,2000",1,2,3,4.5,,1', 't2500,"x"y'
    (tmp_path / "flat.csv").write_text(HEADER + "\r\n".join(lines) + "\r\n", newline="")
    broken = list(lines)
    broken[1_000] = '"two\nlines",1,2,3,4.5,,1'
    (tmp_path / "joined.csv").write_text(HEADER.replace(",", '","').replace("tr", '"tr').replace("\n", '"\n') + "\n".join(broken))
    objects = [json.dumps({"inventory_id": i, "product_id": 7, "note": "}" if i == 5 else "{"}) for i in range(2_000)]
    (tmp_path / "nested.json").write_text("[" + ",\n".join(objects) + "]\n")
    flat = ", ".join(o.replace('"}"', '""').replace('"{"', '""') for o in objects)
    (tmp_path / "flat.json").write_text(f"[ {flat} ]", encoding="utf-8-sig")
    (tmp_path / "marked.json").write_text("[" + ",".join(objects) + "]", encoding="utf-8-sig")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        rows = landing.parse_csv(landing.files(spark, str(tmp_path), landing.CSV_GLOB), POS).collect()
        items = landing.parse_json(landing.files(spark, str(tmp_path), landing.JSON_GLOB), INVENTORY).collect()
        parts = landing._pieces(landing.files(spark, str(tmp_path), landing.CSV_GLOB)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert parts > 10
    for name, moved in (("flat.csv", 0), ("joined.csv", 1)):
        own = [r for r in rows if r.path.endswith(name)]
        assert len(own) == 3_000
        assert sorted((r.line, r.text, r.reject) for r in own if r.reject) == [
            (702, "t700,1,2,x,4.5,,1", "does not fit: quantity"), (2_502 + moved, 't2500,"x"y', landing.UNREADABLE)]
        assert {"t,2000", "t0", "t2999"} <= {r.transaction_id for r in own}
    assert "two\nlines" in {r.transaction_id for r in rows}
    for name in ("nested.json", "flat.json", "marked.json"):
        assert sorted(r.inventory_id for r in items if r.path.endswith(name)) == list(range(2_000))
    assert not any(r.reject for r in items)


def blocks_of(spark, size, run):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        return run()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_line_breaks_inside_quotes_are_read_by_many_tasks(spark, tmp_path):
    lines = [f'"{i % 3 * "x"}""no"",\n\nthen, yes",t{i},1,{i}' for i in range(2_000)]
    (tmp_path / "a.csv").write_text("note,transaction_id,store_id,product_id\n" + "\n".join(lines) + "\n")

    def run():
        rows = landing.parse_csv(landing.files(spark, str(tmp_path), landing.CSV_GLOB), POS)
        return rows.select("*", F.spark_partition_id().alias("part")).collect()

    rows = blocks_of(spark, 5_000, run)
    assert sorted((r.line, r.transaction_id, r.product_id, r.reject) for r in rows) == [
        (4 + 3 * i, f"t{i}", i, None) for i in range(2_000)]
    assert len({r.part for r in rows}) > 10


@pytest.mark.parametrize("odd", ['t,5" disc', 't,"x"y', 't,"open', '"a\nb"c\n"', '"never', 't,"a","b\n"",\n', "t,\xff"])
def test_quotes_that_do_not_add_up_are_read_in_order(spark, tmp_path, odd):
    """Whatever stands in a file, its blocks give the rows that it gives as a whole."""
    lines = [f't{i},"a, {i}\n""b"" "' if i % 3 else f"t{i},{i}" for i in range(400)]
    lines[150] = lines[151] = odd
    lines[300] = odd
    text = "transaction_id,product_id\n" + "\n".join(lines) + "\n"
    (tmp_path / "a.csv").write_bytes(text.encode("latin-1"))

    def sound(line):
        try:
            line.decode()
            return True
        except UnicodeDecodeError:
            return False

    given = [(line.decode(errors="replace"), sound(line)) for line in text.encode("latin-1").split(b"\n")[:-1]]
    want = [row[1:] for row in landing._file_rows("a", iter(given), ["transaction_id", "product_id"])]
    rows = blocks_of(spark, 700, lambda: landing._csv_rows(
        landing.files(spark, str(tmp_path), landing.CSV_GLOB), ["transaction_id", "product_id"]).collect())
    assert sorted(map(str, (tuple(r)[1:] for r in rows))) == sorted(map(str, want))


def test_only_large_whole_numbers_are_cast_as_such(spark):
    """The cast raises an exception inside for a text like 3.0, so it is left out where the double is exact."""
    texts = ["3.0", "-2.0", "9007199254740991", "9007199254740993", "-9007199254740993", "1e3",
             "9223372036854775807", "-9223372036854775808", "1e19", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "g string")
    got = df.select(landing._value(F.col("g"), POS["product_id"].dataType))
    assert [r[0] for r in got.collect()] == [
        3, -2, 9007199254740991, 9007199254740993, -9007199254740993, 1000,
        9223372036854775807, -9223372036854775808, None, None]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ELSE") < plan.index("as bigint), try_cast(")


def test_json_layout_sorts_no_texts(spark, tmp_path):
    """The layout of documents is summed up by block, without sorting the pieces that it is made of."""
    for name, text in {"a": '[{"inventory_id": 1}, {"inventory_id": 2}]', "b": ' \ufeff[ { "x": "}" } ]', "c": '{"x": 1}',
                       "d": '[{"x": {}}]', "e": '[{"x": 1}', "f": "[]", "g": '[{"x": 1},{"x" 2}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    pieces = landing._pieces(landing.files(spark, str(tmp_path), landing.JSON_GLOB), "}")
    layout = landing._json_layout(landing._json_pieces(pieces))
    assert {r.file[-6]: r.flat for r in layout.collect()} == {
        "a": True, "b": False, "c": True, "d": False, "e": False, "f": False, "g": False}
    assert "Sort" not in layout._jdf.queryExecution().sparkPlan().toString()


def test_names_that_look_like_patterns(spark, tmp_path):
    (tmp_path / "a[1]{x}+%20 *.csv").write_text(HEADER + "t1,1,2,3,4.5,,1\n")
    (tmp_path / "a1x.csv").write_text(HEADER + "t2,1,2,3,4.5,,1\n")
    rows = landing.parse_csv(landing.files(spark, str(tmp_path), landing.CSV_GLOB), POS).collect()
    assert sorted(r.transaction_id for r in rows) == ["t1", "t2"]
    one = landing.files(spark, [f"{tmp_path}/a[1]{{x}}+%20 *.csv"], "*")
    assert [r.transaction_id for r in landing.parse_csv(one, POS).collect()] == ["t1"]


def test_an_open_quote_ends_where_a_cell_is_too_long(spark, tmp_path, monkeypatch):
    """The rows behind a quote that is never closed are rows again."""
    monkeypatch.setattr(landing, "LONGEST", 200)
    rows = list(landing._records(iter([('t0,"open', True)] + [(f"t{i},1", True) for i in range(100)])))
    assert rows[0] == (1, None, 't0,"open') and [r[1][0] for r in rows[1:]] == [f"t{i}" for i in range(100)]


@pytest.mark.parametrize("text, want", [
    ('[{"a":"}"},[{"b":1}], "x,]y" ,5]', ['{"a":"}"}', '[{"b":1}]', '"x,]y"', "5"]), ("[]", []), (" [ ]\n", []),
    ('{"a":{"b":[1]}}', ['{"a":{"b":[1]}}']), ("[1,]", None), ("[{}", None), ("[1] 2", None), ('[{"a":1}]}', None), ("", None)])
def test_elements_of_a_document(text, want):
    parts = text.split("}")
    chunks = [(p, True, len(text.encode()), len(p.encode())) for p in (parts if parts[-1] else parts[:-1])]
    try:
        assert list(landing._elements(iter(chunks))) == want
    except ValueError:
        assert want is None
