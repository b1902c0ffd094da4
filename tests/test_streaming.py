from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanvec.operators import providers
from spanvec.sources.tables import SnapshotTable
from spanvec.operators.series import alert_rules, last_n, latest_per_type, metric_retention
from spanvec.streaming import ingest, messages
from spanvec.streaming.metrics import metric_stream


def message(vectors, metadata=None, operation=None, collection=None):
    body = {"vectors": vectors, "metadata": metadata, "operation": operation, "collection": collection}
    return json.dumps({k: v for k, v in body.items() if v is not None})


TEXTS = [
    message([[1, 2, 3]], [{"id": 1}], "insert", "test_collection"),
    message([[4, 5, 6], [7, 8, 9]], [{"id": 2}], "insert", "test_collection"),
    message([[0, 0, 1]]),
    "not json",
    message([[1, 1, 1]], [{"id": 1}], "explode", "test_collection"),
]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_explode_and_rejects(spark):
    raw = frame(spark, TEXTS)
    rows = messages.stream_explode(messages.stream_parse(raw)).collect()
    got = sorted(
        ((r.collection, r.operation, r.pos, tuple(r.vector), (r.metadata or {}).get("id")) for r in rows),
        key=lambda g: g[3],
    )
    assert got == [
        ("default", "insert", 0, (0.0, 0.0, 1.0), None),
        ("test_collection", "insert", 0, (1.0, 2.0, 3.0), "1"),
        ("test_collection", "insert", 0, (4.0, 5.0, 6.0), "2"),
        ("test_collection", "insert", 1, (7.0, 8.0, 9.0), None),
    ]
    reasons = {r.reason for r in messages.stream_rejects(raw).collect()}
    assert reasons == {"malformed message", "unknown operation"}


def test_render_and_parse_are_inverse(spark):
    df = spark.createDataFrame([([[1.5, 2.0]], [{"id": "7"}])], "vectors array<array<double>>, metadata array<map<string,string>>")
    back = messages.stream_parse(messages.render_messages(df, "update", "c")).first()
    assert back.vectors == [[1.5, 2.0]] and back.metadata == [{"id": "7"}]
    assert (back.operation, back.collection) == ("update", "c")


def test_a_stream_of_messages_is_forwarded(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "topic")
    ingest.produce_messages(frame(spark, TEXTS).coalesce(1), source)
    query = ingest.produce_messages(ingest.file_source(spark, source), target, checkpoint=str(tmp_path / "c"))
    query.awaitTermination()
    assert sorted(r.value for r in spark.read.text(target).collect()) == sorted(TEXTS)


def test_topic_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.kafka_source(spark, "localhost:9", "t", 100, {"failOnDataLoss": "false"})


def test_ingest_survives_a_restart_and_equals_the_batch(spark, tmp_path):
    source, root, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    ingest.produce_messages(frame(spark, TEXTS[:3]).coalesce(1), source)

    def run():
        query = ingest.stream_ingest(ingest.file_source(spark, source, 1), root, check, available_now=True)
        query.awaitTermination()

    run()
    first = ingest.read_ingested(spark, root, "test_collection").count()
    run()
    assert ingest.read_ingested(spark, root, "test_collection").count() == first == 3
    ingest.produce_messages(frame(spark, TEXTS[3:]).coalesce(1), source)
    run()
    rows = ingest.read_ingested(spark, root, "test_collection")
    batch = messages.stream_explode(messages.stream_parse(frame(spark, TEXTS))).where("collection = 'test_collection'")
    assert rows.select("pos", "vector").exceptAll(batch.select("pos", "vector")).count() == 0
    assert rows.count() == batch.count()
    assert spark.read.parquet(f"{root}/rejects").count() == 2


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    ingest.produce_messages(frame(spark, TEXTS).coalesce(1), source)
    # A lost checkpoint makes the query take the same files as batch 0 again.
    for check in ("a", "b"):
        query = ingest.stream_ingest(ingest.file_source(spark, source), root, str(tmp_path / check), True)
        query.awaitTermination()
    assert ingest.read_ingested(spark, root, "test_collection").count() == 3


def test_operations_fold_into_the_collection(spark, tmp_path):
    source, root, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    base = spark.createDataFrame([(i, [float(i)] * 2, i) for i in range(5)], "id bigint, vector array<double>, n int")
    steps = [
        [message([[9, 9]], [{"id": 0, "n": 50}], "update", "c"), message([[1, 1]], [{"id": 7}], "insert", "c")],
        [message([[0, 0]], [{"id": 1}], "delete", "c"), message([[8, 8]], [{"id": 0}], "update", "c")],
        [message([[5, 5]], [{"id": 1, "n": 60}], "insert", "c"), message([[0, 0]], [{"id": 7}], "delete", "c")],
    ]
    for texts in steps:
        ingest.produce_messages(frame(spark, texts).coalesce(1), source)
        query = ingest.stream_ingest(ingest.file_source(spark, source), root, check, True)
        query.awaitTermination()
    operations = ingest.read_ingested(spark, root, "c")
    # The last operation of id 0 names no ``n``: the one of the batch before stays.
    expected = {0: (8.0, 50), 1: (5.0, 60), 2: (2.0, 2), 3: (3.0, 3), 4: (4.0, 4)}
    state = ingest.current_state(base, operations)
    assert {r.id: (r.vector[0], r.n) for r in state.collect()} == expected
    t = SnapshotTable(spark, str(tmp_path / "table"))
    t.create(base)
    for _ in range(2):
        ingest.fold_operations(t, operations)
        assert {r.id: (r.vector[0], r.n) for r in t.read().collect()} == expected


def test_operations_that_do_not_fit_are_reported(spark):
    base = spark.createDataFrame([(1, [1.0], 1)], "id bigint, vector array<float>, n int")
    rows = [
        (0, "insert", {"n": "5"}), (1, "insert", None), (2, "insert", {"id": "abc"}), (3, "insert", {"id": "7", "n": "x"}), (4, "update", {"n": "1"}),
        (5, "delete", {}), (6, "update", {"id": "99", "n": "1"}), (7, "update", {"id": "1", "n": "8"}), (8, "insert", {"id": "2", "n": "3"}),
    ]
    operations = spark.createDataFrame(
        [(seq, 0, op, 0, [2.0], m, 0) for seq, op, m in rows], "seq bigint, part int, operation string, pos int, vector array<double>, metadata map<string,string>, batch_id bigint"
    )
    state = ingest.current_state(base, operations).collect()
    given = {r.id: r.n for r in state if r.id < ingest.OWN_IDS}
    assert given == {1: 8, 2: 3} and sorted(str(r.n) for r in state if r.id >= ingest.OWN_IDS) == ["5", "None"]
    rejects = {r._seq: r.reason for r in ingest.split_operations(base, operations)[1].collect()}
    assert rejects == {2: "id is not a number", 3: "n is not of type int", 4: "no id", 5: "no id"}
    # A later batch leaves the ids of the stream as they are.
    more = operations.unionByName(operations.where("seq = 8").withColumn("batch_id", F.lit(1).cast("bigint")))
    assert {r.id for r in ingest.current_state(base, more).collect()} == {r.id for r in state}


def test_batches_follow_one_another(spark):
    rows = [
        (1, 0, "update", "a", None), (1, 1, "update", None, 1), (1, 2, "update", "b", None),
        (2, 0, "update", "a", 9), (2, 1, "delete", "x", None), (2, 2, "update", None, 4),
        (3, 0, "insert", "a", 9), (3, 1, "insert", "c", None), (3, 2, "update", None, 5),
        (4, 0, "insert", "a", 9), (4, 1, "delete", None, None),
    ]
    df = spark.createDataFrame(rows, "id bigint, b int, operation string, s string, n int")
    out = {r.id: (r.operation, r.s, r.n) for r in messages.fold_batches(df, "id", "b", ["s", "n"]).collect()}
    assert out == {1: ("update", "b", 1), 2: ("insert", None, 4), 3: ("insert", "c", 5), 4: ("delete", None, None)}


def test_metric_windows_on_a_stream_equal_the_batch(spark, tmp_path):
    source = str(tmp_path / "events")
    events = spark.sql(
        "select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int)) as ts, "
        "cast(id as double) as value, id % 5 = 0 as bad from range(600)"
    )
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    rolled = metric_stream(stream, "ts", "1 hour", "value", F.col("bad"))
    query = rolled.writeStream.format("memory").queryName("rolled").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = metric_stream(events, "ts", "1 hour", "value", F.col("bad"))
    assert spark.table("rolled").exceptAll(batch).count() == 0 and batch.count() == 10


def test_series(spark):
    rows = [(t, i, float(i)) for t in ("a", "b") for i in range(10)]
    df = spark.createDataFrame(rows, "metric string, ts int, value double")
    latest = latest_per_type(df, "metric", "ts", "ts", ["value"])
    assert {r.metric: r.value for r in latest.collect()} == {"a": 9.0, "b": 9.0}
    assert last_n(df, "metric", "ts", "ts", 3).count() == 6
    alerts = alert_rules(latest, {"a": 9.0, "b": 8.5, "c": 0.0}).collect()
    assert [r.message for r in alerts] == ["Alert: b exceeded threshold (9.0 > 8.5)"]
    times = spark.sql("select timestamp'2024-01-31 00:00:00' - make_interval(0,0,0,cast(id as int)) as ts from range(10)")
    kept = metric_retention(times, "ts", F.lit("2024-01-31 00:00:00").cast("timestamp"), "7 days")
    assert kept.count() == 7


# --- providers -------------------------------------------------------------------------


def test_hashed_embedding(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, ""), (2, None), (3, "B, a; A")], "id bigint, text string")
    out = {r.id: r.vector for r in providers.embed_text(df, "text", 16).collect()}
    assert out[1] is None and out[2] is None and out[0] == out[3]
    assert abs(np.linalg.norm(out[0]) - 1) < 1e-12


def test_provider_is_built_per_task_and_keeps_rows_paired(spark):
    def factory():
        return lambda texts: np.array([[float(len(t)), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(50)], "id bigint, text string").repartition(4)
    out = providers.embed_text(df, "text", 2, factory)
    assert out.where("vector[0] <> id").count() == 0 and out.count() == 50
    with pytest.raises(Exception, match="the provider gave"):
        providers.embed_text(df, "text", 3, factory).collect()


def test_classifier_answers(spark):
    def factory():
        return lambda texts: [json.dumps({"label": t.upper(), "score": 0.5}) for t in texts]

    df = spark.createDataFrame([(1, "a")], "id bigint, text string")
    row = providers.classify_text(df, "text", factory).first()
    assert tuple(row.category) == ("A", 0.5)


def test_a_failing_item_fails_the_call(spark):
    def bad(batch):
        raise RuntimeError("no such item")

    with pytest.raises(Exception, match="no such item"):
        providers.map_items(spark.range(3), bad, "id long").collect()
