import base64
import json
import os
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from storelens import jobs
from storelens.operators.validation import validate_records
from storelens.plans import marketing, support
from storelens.schemas import POS
from storelens.sinks import items, publish
from storelens.sources import landing, records
from storelens.streaming import metrics, state
from storelens.streaming import queries as streaming

AS_OF = "2024-01-01 00:00:00"
RAW = "recordId string, data string"


def wrap(payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return base64.b64encode(text.encode()).decode()


def deliveries(spark, path, *batches):
    """One file per delivery, each becoming a micro-batch."""
    for i, batch in enumerate(batches):
        rows = [(f"{i}-{j}", wrap(p)) for j, p in enumerate(batch)]
        spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(f"{path}/d{i}")
    return (spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(path))


FIRST = [
    {"id": 1, "customer_id": 1, "interaction_type": "Complaint", "rating": 2, "timestamp": 0.0},
    {"id": 2, "customer_id": 1, "interaction_type": "Resolution", "timestamp": 120.0},
    {"id": 3, "customer_id": 2, "session_id": "s", "interaction_type": "Loyalty", "timestamp": 5},
    {"id": 4, "session_id": "s", "timestamp": 9.0}, "{bad", "[1]", "7",
    {"id": 5, "customer_id": 0, "interaction_type": "Feedback", "rating": "5", "timestamp": 1.0},
]
SECOND = [{"id": 6, "page": "x"}]
THIRD = [{"id": 7, "customer_id": 1, "interaction_type": "Resolution", "rating": "n/a",
          "timestamp": 180.0}]


def test_support_rows_per_batch(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST, SECOND, THIRD)
    streaming.support(raw, f"{tmp_path}/out", f"{tmp_path}/cp", as_of=AS_OF).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").drop("kpi_date", "query").orderBy("batch_id").collect()
    # Batches know nothing of each other, and one without customers writes no row.
    assert [tuple(r) for r in out] == [
        (2.0, '{"Complaint":1,"Loyalty":1,"Resolution":1}', 2.0, 0),
        (0.0, '{"Resolution":1}', 0.0, 2)]


def test_marketing_rows_per_batch(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST, SECOND, THIRD)
    streaming.marketing(raw, f"{tmp_path}/out", f"{tmp_path}/cp", as_of=AS_OF).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").drop("kpi_date", "query").orderBy("batch_id").collect()
    assert [tuple(r) for r in out] == [(2.0, 4.0, 0.0, pytest.approx(100 / 3), 0),
                                       (0.0, 0.0, 0.0, 0.0, 2)]


def test_one_batch_equals_the_batch_functions(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST + THIRD)
    parsed = records.parse_records(spark.read.parquet(f"{tmp_path}/in/d0"))
    for start, plan in ((streaming.support, support.support_kpis_of_records),
                        (streaming.marketing, marketing.marketing_kpis_of_records)):
        base = f"{tmp_path}/{start.__name__}"
        start(raw, f"{base}/out", f"{base}/cp", as_of=AS_OF).awaitTermination()
        streamed = spark.read.parquet(f"{base}/out").drop("query", "batch_id").collect()
        assert streamed == plan(parsed, AS_OF).collect()


def test_validation_keeps_ids_and_payloads(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST, SECOND)
    streaming.validate(raw, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    streamed = spark.read.parquet(f"{tmp_path}/out").select("recordId", "data", "result")
    batch = validate_records(spark.read.option("recursiveFileLookup", True)
                             .schema(RAW).parquet(f"{tmp_path}/in"))
    assert set(streamed.collect()) == set(batch.collect())
    assert {r.result for r in batch.collect()} == {"Ok", "Dropped", "ProcessingFailed"}


def test_item_store_across_batches(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST, THIRD)
    streaming.store_items(raw, f"{tmp_path}/out", f"{tmp_path}/cp", "customer_id",
                          ["timestamp", "id"]).awaitTermination()
    stored = items.current_items(spark, f"{tmp_path}/out", "customer_id")
    rows = {r.customer_id: r for r in stored.collect()}
    assert {customer: r.id for customer, r in rows.items()} == {"0": "5", "1": "7", "2": "3"}
    assert json.loads(rows["1"].payload) == THIRD[0]
    assert json.loads(rows["1"].item) == {
        "id": {"N": "7"}, "customer_id": {"N": "1"}, "interaction_type": {"S": "Resolution"},
        "rating": {"S": "n/a"}, "timestamp": {"N": "180.0"}}


def test_the_item_store_is_folded_while_the_query_runs(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST, SECOND, THIRD)
    path = f"{tmp_path}/out"
    streaming.store_items(raw, path, f"{tmp_path}/cp", "customer_id", ["timestamp", "id"], fold_every=2).awaitTermination()
    number, folded, _ = items._snapshot(spark, path)
    assert number == 1 and [name.rsplit("=", 1)[1] for name in folded] == ["0", "1"]
    stored = {r.customer_id: r.id for r in items.current_items(spark, path, "customer_id").collect()}
    assert stored == {"0": "5", "1": "7", "2": "3"}


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    """Two queries, with batch numbers from 0 each, into one output; then the first one again."""
    first, second = f"{tmp_path}/first", f"{tmp_path}/second"
    raw = deliveries(spark, first, FIRST, SECOND)
    other = deliveries(spark, second, THIRD)

    def run(raw, name):
        streaming.store_items(raw, f"{tmp_path}/items", f"{tmp_path}/cp-{name}-i", "customer_id",
                              ["timestamp", "id"]).awaitTermination()
        streaming.support(raw, f"{tmp_path}/kpis", f"{tmp_path}/cp-{name}-k", as_of=AS_OF).awaitTermination()
        stored = items.current_items(spark, f"{tmp_path}/items", "customer_id").collect()
        return {r.customer_id: r.id for r in stored}, spark.read.parquet(f"{tmp_path}/kpis").count()

    assert run(raw, "a") == ({"0": "5", "1": "2", "2": "3"}, 1)
    assert run(other, "b") == ({"0": "5", "1": "7", "2": "3"}, 2)
    assert run(raw, "a") == ({"0": "5", "1": "7", "2": "3"}, 2)
    # The first query goes on under its own number, which is older than that of the second.
    spark.createDataFrame([("x", wrap({"id": 8, "customer_id": 1, "timestamp": 500.0}))], RAW).coalesce(1).write.parquet(f"{first}/d9")
    assert run(raw, "a") == ({"0": "5", "1": "7", "2": "3"}, 3)


def test_files_are_ingested_once(spark, tmp_path):
    header = ",".join(POS.names) + "\n"
    inbox, out, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/cp"
    inbox.mkdir()

    def run():
        files = landing.stream_files(spark, str(inbox), landing.CSV_GLOB)
        streaming.ingest_files(files, POS, landing.parse_csv, out, checkpoint, "2024-01-01").awaitTermination()
        return spark.read.parquet(f"{out}/rows").count()

    (inbox / "a.csv").write_text(header + "t1,1,1,1,1.0,,1.0\n")
    assert run() == 1
    assert run() == 1
    (inbox / "b.Csv").write_text(header + "t2,1,1,1,1.0,,1.0\nt3,1,1,1,1.0,,1.0\n")
    (inbox / "c.tmp").write_text("nothing")
    (inbox / "d.csv").write_bytes(b"\xff\xfe")
    assert run() == 3
    assert [r.reject for r in spark.read.parquet(f"{out}/rejects").collect()] == [landing.UNREADABLE]


def test_a_file_beyond_the_limit_of_values_stops_nothing(spark, tmp_path):
    header = ",".join(POS.names) + "\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "long.csv").write_text(header + "".join(f"t{i},1,1,1,1.0,,1.0\n" for i in range(500)))
    (tmp_path / "in" / "short.csv").write_text(header + "s1,1,1,1,1.0,,1.0\n")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        files = landing.stream_files(spark, f"{tmp_path}/in", landing.CSV_GLOB)
        streaming.ingest_files(files, POS, landing.parse_csv, f"{tmp_path}/out", f"{tmp_path}/cp", "2024-01-01").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert spark.read.parquet(f"{tmp_path}/out/rows").count() == 501


def test_announced_files_are_ingested(spark, tmp_path):
    header = ",".join(POS.names) + "\n"
    (tmp_path / "pos").mkdir()
    for name in ("a b.csv", "c.CSV", "d.csv"):
        (tmp_path / "pos" / name).write_text(header + f"{name},1,1,1,1.0,,1.0\n")
    entry = '{"s3":{"bucket":{"name":"%s"},"object":{"key":"%s"}}}'

    def message(*objects):
        return '{"Records":[' + ",".join(entry % o for o in objects) + "]}"

    batches = [[message(("in", "pos/a+b.csv"), ("in", "pos/c.CSV")), message(("in", "pos/c.CSV"))],
               [message(("out", "pos/d.csv")), "no json", '{"Event":"s3:TestEvent"}'],
               [message(("in", "pos/c.CSV"), ("in", "pos/gone.csv")), "no json"],
               [message(("in", "pos/c.CSV")).replace('"key"', '"eTag":"second","key"')]]
    for i, bodies in enumerate(batches):
        (spark.createDataFrame([(b,) for b in bodies], "body string").coalesce(1)
         .write.parquet(f"{tmp_path}/queue/d{i}"))
    messages = (spark.readStream.schema("body string").option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", True).parquet(f"{tmp_path}/queue"))
    streaming.ingest_announced(
        messages, ("in", "pos/", ".csv"), POS, landing.parse_csv, f"{tmp_path}/out",
        f"{tmp_path}/cp", lambda _, key: f"{tmp_path}/{key}", "2024-01-01").awaitTermination()
    rows = streaming.announced_rows(spark, f"{tmp_path}/out").collect()
    counts = spark.read.parquet(f"{tmp_path}/out/counts").orderBy("batch_id").collect()
    assert [(r.processed, r.failed) for r in counts][:4] == [(2, 0), (0, 2), (0, 1), (1, 0)]
    # A notice that comes again, in its batch or later, adds no row; a new version of its file does.
    assert sorted((r.batch_id, r.transaction_id) for r in rows) == [
        (0, "a b.csv"), (0, "c.CSV"), (3, "c.CSV")]


def test_publish_round_trip(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST)
    keyed = publish.payload_messages(records.read_records(raw))
    publish.publish(keyed, f"{tmp_path}/out", f"{tmp_path}/cp",
                    trigger=streaming.ONCE).awaitTermination()
    sent = spark.read.schema("key string, value string").json(f"{tmp_path}/out").collect()
    assert sorted(r.key for r in sent) == ["1", "2", "3", "4", "5"]
    assert json.loads(next(r.value for r in sent if r.key == "4")) == {
        "id": 4, "session_id": "s", "timestamp": 9.0}


def test_previous_interaction_across_batches(spark, tmp_path):
    later = [{"id": 8, "customer_id": 2, "interaction_type": "Resolution", "timestamp": 65.0},
             {"id": 9, "customer_id": 3, "interaction_type": "Resolution", "timestamp": 70.0}]
    raw = deliveries(spark, f"{tmp_path}/in", FIRST, later, THIRD)
    streaming.resolutions(raw, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out/resolutions").collect()
    assert sorted((r.customer_id, r.id, r.prev_timestamp) for r in rows) == [
        ("1", "2", 0.0), ("1", "7", 120.0), ("2", "8", 5.0), ("3", "9", None)]


def test_previous_interactions_survive_a_restart(spark, tmp_path):
    """State goes on from the checkpoint; late rows are marked and not remembered; a start can be given."""
    def record(i, customer, time):
        return {"id": i, "customer_id": customer, "interaction_type": "Resolution", "timestamp": time}

    def run(*batches, start=None):
        for i, batch in enumerate(batches):
            (spark.createDataFrame([(str(r["id"]), wrap(r)) for r in batch], RAW).coalesce(1)
             .write.mode("append").parquet(f"{tmp_path}/in"))
            raw = spark.readStream.schema(RAW).parquet(f"{tmp_path}/in")
            streaming.resolutions(raw, f"{tmp_path}/out", f"{tmp_path}/cp", initial=start).awaitTermination()
        rows = spark.read.parquet(f"{tmp_path}/out/resolutions").collect()
        return sorted((r.id, r.prev_timestamp, r.late) for r in rows)

    known = spark.createDataFrame([("5", 1.0, "a"), ("5", 3.0, "b")], "customer_id string, timestamp double, id string")
    first = run([record(1, 1, 10.0), record(2, 1, 20.0), record(3, 5, 7.0)], start=known)
    assert first == [("1", None, False), ("2", 10.0, False), ("3", 3.0, False)]
    later = run([record(4, 1, 15.0), record(5, 1, 16.0), record(6, 1, 30.0)], [record(7, 1, 31.0), record(8, 5, 8.0)], start=known)
    assert later == first + [("4", None, True), ("5", 15.0, True), ("6", 20.0, False), ("7", 30.0, False), ("8", 7.0, False)]


def test_interactions_of_a_customer_are_no_frame(spark, tmp_path):
    """Customers come as rows, in any order: ties go by id, late ones look back to late ones, and no frame is made."""
    processor = state._Previous(None)
    processor.last = SimpleNamespace(get=lambda: (10.0, "5"), update=(kept := []).append)
    given = [Row(id=i, interaction_type="Resolution", timestamp=t) for i, t in
             [("9", 12.0), ("1", 4.0), ("6", 10.0), ("8", 12.0), ("4", 10.0)]]
    got = list(processor.handleInputRows(("1",), iter(given), None))
    assert [(r.id, r.prev_timestamp, r.late) for r in got] == [
        ("1", None, True), ("4", 4.0, True), ("6", 10.0, False), ("8", 10.0, False), ("9", 12.0, False)]
    assert kept == [(12.0, "9")]
    raw = spark.readStream.schema("customer_id string, id string, interaction_type string, timestamp double").parquet(
        made(spark, f"{tmp_path}/in"))
    assert "InPandas" not in state.with_last_seen(raw)._jdf.queryExecution().logical().toString()


def made(spark, path):
    spark.createDataFrame([("1", "1", "Resolution", 1.0)], "customer_id string, id string, interaction_type string, timestamp double").write.parquet(path)
    return path


def test_late_rows_of_windows_are_counted(spark, tmp_path):
    def record(i, time):
        return {"id": i, "customer_id": 1, "interaction_type": "Feedback", "rating": "4", "timestamp": time}

    hour = 3600.0
    raw = deliveries(spark, f"{tmp_path}/in", [record(1, 0.0), record(2, 10 * hour)], [record(6, 11 * hour)],
                     [record(3, 1.0), record(4, 2.0)], [record(5, 30 * hour)])
    listener = metrics.MetricRows(spark, f"{tmp_path}/counts")
    spark.streams.addListener(listener)
    try:
        listener.finish(streaming.windowed_support(raw, f"{tmp_path}/out", f"{tmp_path}/cp", "1 hour", "1 hour"))
    finally:
        spark.streams.removeListener(listener)
    late = metrics.stored_counts(spark, f"{tmp_path}/counts").filter("metric = 'late_rows'").groupBy().sum("value").first()[0]
    assert late == 1  # two records of one window, dropped together
    volumes = {r.volume for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert volumes == {1}


def observed(query, name):
    query.awaitTermination()
    return [tuple(p.observedMetrics[name]) for p in query.recentProgress if p.observedMetrics]


def test_removed_and_dropped_records_are_counted_while_the_query_runs(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", [
        {"customer_id": 1, "rating": "9", "timestamp": 1.0}, {"customer_id": 1, "rating": "3"},
        {"customer_id": 0, "rating": "9"}, {"session_id": "s"}, "{bad"])
    for start in (streaming.support, streaming.marketing):
        base = f"{tmp_path}/{start.__name__}"
        assert observed(start(raw, f"{base}/out", f"{base}/cp"), "removals") == [(2, 1, 1, 1)]
    query = streaming.store_items(raw, f"{tmp_path}/items", f"{tmp_path}/items-cp", "customer_id", ["id"])
    assert observed(query, "items") == [(3, 1, 1)]
    query = streaming.validate(raw, f"{tmp_path}/valid", f"{tmp_path}/valid-cp",
                               ["customer_id", "rating"])
    assert observed(query, "results") == [(5, 3, 2)]


def test_jobs_from_the_command_line(spark, tmp_path):
    crm = spark.createDataFrame([(1, 1, "Feedback", "4", 1.0)],
                                "id int, customer_id int, interaction_type string, rating string,"
                                " timestamp double")
    crm.createOrReplaceTempView("crm_logs")
    spark.sql("select 's' session_id, 1.0d timestamp").createOrReplaceTempView("web_logs")

    def run(*argv):
        args = jobs.parser().parse_args([*argv])
        args.run(spark, args)

    run("support", "--crm-table", "crm_logs", "--output", f"{tmp_path}/support")
    assert spark.read.parquet(f"{tmp_path}/support").first().feedback_score == 4.0
    run("marketing", "--web-table", "web_logs", "--crm-table", "crm_logs",
        "--output", f"{tmp_path}/marketing")
    assert spark.read.parquet(f"{tmp_path}/marketing").first().bounce_rate_percent == 100.0
    run("quality", "--tables", "crm_logs", "--output", f"{tmp_path}/quality")
    assert spark.read.parquet(f"{tmp_path}/quality/crm_logs").count() == 1
    profile = spark.read.parquet(f"{tmp_path}/quality/crm_logs-profile").collect()
    assert {r.column: r.completeness for r in profile} == dict.fromkeys(
        ["id", "customer_id", "interaction_type", "rating", "timestamp", "common_column",
         "value_column", "date_column"], 1.0) | {"common_column": 0.0}
    deliveries(spark, f"{tmp_path}/in", FIRST)
    run("stream", "--kind", "validate", "--schema", RAW, "--option", f"path={tmp_path}/in",
        "--option", "recursiveFileLookup=true", "--output", f"{tmp_path}/valid",
        "--checkpoint", f"{tmp_path}/cp")
    assert spark.read.parquet(f"{tmp_path}/valid").count() == len(FIRST)


def test_ingest_jobs_from_the_command_line(spark, tmp_path):
    (tmp_path / "pos").mkdir()
    (tmp_path / "pos" / "a.csv").write_text(",".join(POS.names) + "\nt1,1,1,1,1.0,,1.0\n")
    body = '{"Records":[{"s3":{"bucket":{"name":"in"},"object":{"key":"pos/a.csv"}}}]}'
    spark.createDataFrame([(body,)], "message string").write.parquet(f"{tmp_path}/queue")
    for argv in (["ingest", "--landing", f"{tmp_path}/pos"],
                 ["announced", "--bucket", "in", "--prefix", "pos/", "--schema", "message string",
                  "--body-column", "message", "--locate", f"{tmp_path}/{{1}}",
                  "--option", f"path={tmp_path}/queue"]):
        out = f"{tmp_path}/{argv[0]}-out"
        args = jobs.parser().parse_args(argv + [
            "--feed", "pos", "--output", out, "--checkpoint", f"{tmp_path}/{argv[0]}-cp"])
        args.run(spark, args)
        stored = spark.read.parquet(f"{out}/rows") if argv[0] == "ingest" else streaming.announced_rows(spark, out)
        assert [r.transaction_id for r in stored.collect()] == ["t1"]


def test_publish_jobs_from_the_command_line(spark, tmp_path):
    event = json.dumps({"Records": [{"kinesis": {"data": wrap(p)}} for p in FIRST]})
    spark.createDataFrame([(event,)], "event string").write.parquet(f"{tmp_path}/events")

    def run(name, *argv):
        args = jobs.parser().parse_args([
            "stream", "--kind", "publish", "--schema", "event string", "--data-column", "event", "--events",
            "--option", f"path={tmp_path}/events", "--output", f"{tmp_path}/{name}",
            "--checkpoint", f"{tmp_path}/{name}-cp", *argv])
        args.run(spark, args)

    run("plain")
    sent = spark.read.schema("key string, value string").json(f"{tmp_path}/plain").collect()
    assert sorted(json.dumps(json.loads(r.value)) for r in sent) == sorted(
        json.dumps(p) for p in FIRST if isinstance(p, dict))
    run("enveloped", "--envelope")
    wrapped = [json.loads(r.value) for r in
               spark.read.schema("key string, value string").json(f"{tmp_path}/enveloped").collect()]
    assert {w["source"] for w in wrapped} == {"api-gateway"}
    assert sorted(w["data"]["id"] for w in wrapped) == [1, 2, 3, 4, 5]
    run("packed", "--pack", "2", "--sink", "parquet")
    sends = spark.read.parquet(f"{tmp_path}/packed").collect()
    assert sorted(len(r.entries) for r in sends) == [1, 2, 2]

def test_polling_trigger(spark, tmp_path):
    raw = deliveries(spark, f"{tmp_path}/in", FIRST)
    query = streaming.validate(raw, f"{tmp_path}/out", f"{tmp_path}/cp",
                               trigger=streaming.POLLING)
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").filter(F.col("result") == "Ok").count() == 4


def test_batch_jobs_from_the_command_line(spark, tmp_path):
    spark.sql("select 't' transaction_id, 1L store_id, 2L product_id, 3L quantity, 4.5d revenue,"
              " 0.1d discount_applied, 86400.0d timestamp").createOrReplaceTempView("pos_table")
    spark.sql("select 1L inventory_id, 2L product_id, 1 warehouse_id, 6L stock_level,"
              " 9.0d restock_threshold, 86400.0d last_updated").createOrReplaceTempView("inv_table")

    def run(*argv):
        args = jobs.parser().parse_args([*argv, "--output", f"{tmp_path}/{argv[0]}"])
        args.run(spark, args)

    run("silver", "--pos-table", "pos_table", "--inventory-table", "inv_table")
    run("sales", "--pos-path", f"{tmp_path}/silver/silver-pos",
        "--inventory-path", f"{tmp_path}/silver/silver-inventory")
    row = spark.read.parquet(f"{tmp_path}/sales").first()
    assert (str(row.date), row.store_id, row.total_sales, row.stock_availability,
            row.product_turnover_rate) == ("1970-01-02", 1, 4.5, 0.0, 0.5)
    run("operations", "--pos-table", "pos_table", "--inventory-table", "inv_table")
    row = spark.read.parquet(f"{tmp_path}/operations").first()
    assert (row.inventory_turnover, row.restock_frequency, row.stockout_alert) == (0.5, 1, 0)


def test_previous_interactions_of_two_months(spark, tmp_path):
    from oracle import compare, connect

    small = "/root/testdata/sf0.001"
    for name in os.listdir(small):
        if name != "events.parquet":
            os.symlink(f"{small}/{name}", tmp_path / name)
    events = pq.read_table(f"{small}/events.parquet")
    late = pc.equal(pc.bit_wise_and(events["event_id"], 1), 1)
    moved = pc.if_else(late, pc.add(events["ts"], pa.scalar(31 * 86_400_000_000, pa.duration("us"))), events["ts"])
    pq.write_table(events.set_column(events.schema.get_field_index("ts"), "ts", moved), tmp_path / "events.parquet")
    problem = compare(spark, connect(str(tmp_path)), "st_ext_prev_interaction", str(tmp_path))
    assert problem is None, problem
