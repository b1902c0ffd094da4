"""Collections that follow a stream by position."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanvec.streaming import ingest, messages
from spanvec.streaming.folded import FoldedStream

SCHEMA = "id bigint, vector array<double>, label int"


class Topic:
    def __init__(self, spark, path):
        self.spark, self.path, self.root = spark, str(path / "topic"), str(path / "stream")

    def send(self, operation, collection, *rows):
        frame = self.spark.createDataFrame([(i, [float(x)], None if label is None else str(label)) for i, x, label in rows], "id bigint, v array<double>, label string").coalesce(1)
        entries = F.map_filter(F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("label"), F.col("label")), lambda _, v: v.isNotNull())
        one = frame.select(F.array("v").alias("vectors"), F.array(entries).alias("metadata"))
        ingest.produce_messages(messages.render_messages(one, operation, collection), self.path)
        return self

    def take(self):
        source = ingest.file_source(self.spark, self.path)
        ingest.stream_ingest(source, self.root, f"{self.root}/checkpoint", available_now=True).awaitTermination()
        return FoldedStream(self.spark, self.root, SCHEMA)


def rows(stream, collection):
    return sorted((r.id, r.vector[0], r.label) for r in stream.read(collection).collect())


def test_two_collections_of_one_stream(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send("insert", "a", (1, 1, 10), (2, 2, 20)).send("insert", "b", (1, 7, 70))
    stream = topic.take()
    assert stream.position() == -1
    assert rows(stream, "a") == [(1, 1.0, 10), (2, 2.0, 20)] and rows(stream, "b") == [(1, 7.0, 70)]
    first = stream.fold()
    assert stream.position() == first and rows(stream, "a") == [(1, 1.0, 10), (2, 2.0, 20)]
    topic.send("update", "a", (1, 5, None)).send("delete", "b", (1, 0, None)).send("insert", "b", (3, 3, 30))
    stream = topic.take()
    want = [(1, 5.0, 10), (2, 2.0, 20)], [(3, 3.0, 30)]
    assert (rows(stream, "a"), rows(stream, "b")) == want
    assert stream.fold() > first
    # A restart reads what was folded.
    stream = FoldedStream(spark, topic.root, SCHEMA)
    assert (rows(stream, "a"), rows(stream, "b")) == want
    assert {r.collection for r in stream.read().collect()} == {"a", "b"}


def test_a_removed_row_stays_removed(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    stream = topic.send("insert", "a", (1, 1, 10), (2, 2, 20)).take()
    stream.fold()
    stream.change(lambda state: state.where("id <> 1"))
    assert rows(stream, "a") == [(2, 2.0, 20)]
    position = stream.fold()
    assert rows(stream, "a") == [(2, 2.0, 20)] and stream.fold() == position
    stream.change(lambda state: state.withColumn("label", F.col("label") + 1))
    assert rows(stream, "a") == [(2, 2.0, 21)]
    # A later batch may bring it back; an update of a row that is not there does not.
    assert rows(topic.send("update", "a", (1, 9, 90)).take(), "a") == [(2, 2.0, 21)]
    assert rows(topic.send("insert", "a", (1, 9, 90)).take(), "a") == [(1, 9.0, 90), (2, 2.0, 21)]


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    stream = topic.send("insert", "a", (1, 1, 10), (2, 2, 20)).take()
    position = stream.fold()
    stream.change(lambda state: state.where("id <> 2"))
    # The batch is written again, as after a failure between its work and its commit.
    held = ingest.read_batches(spark, topic.root).where(F.col("batch_id") == position).drop("batch_id")
    again = spark.createDataFrame(held.collect(), held.schema)
    again.write.mode("overwrite").partitionBy("collection").parquet(f"{topic.root}/rows/batch_id={position}")
    assert rows(stream, "a") == [(1, 1.0, 10)] and stream.fold() == position
    assert rows(FoldedStream(spark, topic.root, SCHEMA), "a") == [(1, 1.0, 10)]


def test_folded_batches_can_go(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    stream = topic.send("insert", "a", (1, 1, 10)).take()
    stream.fold(drop_batches=True)
    stream = topic.send("insert", "a", (2, 2, 20)).send("delete", "a", (4, 0, None)).take()
    assert rows(stream, "a") == [(1, 1.0, 10), (2, 2.0, 20)]
    stream.fold(drop_batches=True)
    assert rows(stream, "a") == [(1, 1.0, 10), (2, 2.0, 20)]
    assert ingest.read_batches(spark, topic.root).count() == 0


def test_what_does_not_fit_is_named(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    stream = topic.send("insert", "a", (1, 1, "x")).send("update", "b", (None, 1, 1)).take()
    assert sorted((r.collection, r.reason) for r in stream.rejects().collect()) == [("a", "label is not of type int"), ("b", "no id")]
    assert rows(stream, "a") == []
