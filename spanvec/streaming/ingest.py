"""Structured Streaming ingestion into collections.

Every micro-batch writes its own ``batch_id`` folder in overwrite mode. A
batch that is replayed after a failure therefore replaces its own output and
adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanvec.session import materialize
from spanvec.sources.tables import SnapshotTable
from spanvec.streaming.messages import (
    apply_operations,
    fold_batches,
    latest_operations,
    stream_explode,
    stream_parse,
    stream_rejects,
)

# An operation comes after another by these columns.
ORDER = ("batch_id", "seq", "part", "pos")
# Fixed value: a batch is taken at least this often.
TRIGGER = "1 second"
# Ids that the stream gives to inserts without one.
OWN_IDS = 1 << 62


def kafka_source(
    spark: SparkSession,
    servers: str,
    topics: str,
    max_offsets: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Message texts of topics from the earliest offset. Needs the Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
        .options(**(options or {}))
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def file_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message texts from files, one message per line."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def produce_messages(
    messages: DataFrame,
    target: str,
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery | None:
    """Write message texts to a topic, or to files when ``target`` is a path.

    A streaming frame is written as it grows and gives its query; it needs a
    checkpoint folder.
    """
    to_topic = "kafka.bootstrap.servers" in (options or {})
    texts = messages.select("value")
    if messages.isStreaming:
        writer = texts.writeStream.option("checkpointLocation", checkpoint)
        if to_topic:
            return writer.format("kafka").option("topic", target).options(**options).start()
        return writer.format("text").option("path", target).trigger(availableNow=True).start()
    if to_topic:
        texts.write.format("kafka").option("topic", target).options(**options).save()
    else:
        texts.write.mode("append").text(target)
    return None


def _each_batch(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    return writer.start()


def _ordered(batch: DataFrame) -> DataFrame:
    """Messages with their place in the batch, ``seq`` and ``part``.

    A topic orders messages by offset inside a partition. Files give only the
    order in which the batch reads them; writing the rows fixes it.
    """
    if "offset" in batch.columns:
        return batch.select("value", F.col("offset").alias("seq"), F.col("partition").alias("part"))
    return batch.select("value", F.monotonically_increasing_id().alias("seq"), F.lit(0).alias("part"))


def stream_ingest(
    source: DataFrame, root: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Messages to rows under ``root/rows``, unusable texts to ``root/rejects``.

    Rows lie in ``collection`` folders inside the folder of their batch.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        # Read once from the source, used for the rows and for the rejects.
        batch = batch.persist()
        rows = stream_explode(stream_parse(_ordered(batch)))
        rows.write.mode("overwrite").partitionBy("collection").parquet(f"{root}/rows/batch_id={batch_id}")
        rejects = stream_rejects(batch).select("value", "reason")
        rejects.write.mode("overwrite").parquet(f"{root}/rejects/batch_id={batch_id}")
        batch.unpersist()

    return _each_batch(source, work, checkpoint, available_now)


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """The operations of all collections so far, with ``collection`` and ``batch_id``."""
    # An explicit schema: a batch without rows leaves no file to infer it from.
    schema = (
        "seq bigint, part int, operation string, pos int, vector array<double>, "
        "metadata map<string,string>, batch_id bigint, collection string"
    )
    return spark.read.schema(schema).parquet(f"{root}/rows")


def read_ingested(spark: SparkSession, root: str, collection: str) -> DataFrame:
    """The operations of one collection so far; only its folders are read."""
    return read_batches(spark, root).where(F.col("collection") == collection).drop("collection")


def split_operations(
    base: DataFrame, operations: DataFrame, id_key: str = "id", also: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Operations in the types of a collection, and those that do not fit it with the reason.

    ``also`` names columns of the operations that both keep.

    The id of an operation is the entry ``id_key`` of its metadata, and entries named
    like a column of the collection are its values. An insert without an id gets one:
    its place in the stream, hashed, so it stays the same as the stream goes on;
    such ids lie from ``OWN_IDS`` on.
    """
    kinds = {f.name: f.dataType for f in base.schema.fields}
    fields = [c for c in base.columns if c not in ("id", "vector")]
    raw = lambda c: F.try_element_at("metadata", F.lit(c))
    value = {c: raw(c).try_cast(kinds[c]) for c in fields}
    named, place = raw(id_key), [F.col(c).alias(f"_{c}") for c in ORDER]
    own = F.xxhash64(*ORDER).bitwiseAND(F.lit(OWN_IDS - 1)).bitwiseOR(F.lit(OWN_IDS))
    reason = (
        F.when(named.isNotNull() & named.try_cast("bigint").isNull(), F.lit(f"{id_key} is not a number"))
        .when(named.isNull() & (F.col("operation") != "insert"), F.lit(f"no {id_key}"))
    )
    for c in fields:
        reason = reason.when(raw(c).isNotNull() & value[c].isNull(), F.lit(f"{c} is not of type {kinds[c].simpleString()}"))
    checked = operations.withColumn("_reason", reason)
    good = checked.where(F.col("_reason").isNull()).select(
        F.coalesce(named.try_cast("bigint"), own).alias("id"),
        "operation",
        # The element type only: an array type may also forbid NULL elements.
        F.col("vector").cast(T.ArrayType(kinds["vector"].elementType)).alias("vector"),
        *[v.alias(c) for c, v in value.items()],
        *place,
        *also,
    )
    rejects = checked.where(F.col("_reason").isNotNull())
    return good, rejects.select("operation", "vector", "metadata", F.col("_reason").alias("reason"), *place, *also)


def current_state(base: DataFrame, operations: DataFrame, id_key: str = "id") -> DataFrame:
    """A collection after the ingested operations that fit it; ``split_operations`` has the others.

    A micro-batch only appends its operations; the collection is folded when
    it is read, or rewritten from this state by ``fold_operations``. An insert
    puts every column, an update those it names of a row that is there, a
    delete removes the row. Inside a batch the last operation of an id counts;
    batches follow one another.
    """
    keyed, _ = split_operations(base, operations, id_key)
    per_batch = latest_operations(keyed, ["id", "_batch_id"], *[f"_{c}" for c in ORDER[1:]])
    named = [c for c in base.columns if c != "id"]
    return apply_operations(base, fold_batches(per_batch, "id", "_batch_id", named), "id", named)


def fold_operations(table: SnapshotTable, operations: DataFrame) -> int:
    """Make the table hold its state after the operations.

    Folding the same operations again changes nothing, as long as no other
    change came in between.
    """
    return table.replace(current_state(table.read(), materialize(operations)))
