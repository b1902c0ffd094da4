"""Sources, sinks, tables and streams on data derived from the given tables.

Each of these writes to a folder of its own under the shared folder, runs the
operator on what it wrote, and returns what the operator gives back.
"""

from __future__ import annotations

import io
import uuid
from datetime import datetime
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanvec.operators import ivf, rows
from spanvec.operators.aggregates import vector_mean
from spanvec.operators.quality import Rules
from spanvec.operators.search import QuerySet
from spanvec.plans.base import ORACLES, collection, hits, query, r6, table
from spanvec.plans.metric_plans import MESSAGE_ROWS, message_texts
from spanvec.plans.search_plans import source_queries
from spanvec.session import shared_dir
from spanvec.sources import object_store, snapshots
from spanvec.sources.files import (
    SourceConfig,
    read_contents,
    read_npz,
    scan_by_config,
    scan_csv,
    split_rejects,
)
from spanvec.sources.tables import SnapshotTable
from spanvec.streaming import ingest, messages
from spanvec.streaming.folded import FoldedStream


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


TOTAL = "round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS total"
ROWS_SQL = f"SELECT vec_id, label, {TOTAL} FROM embeddings"


def with_total(df: DataFrame, *more: str) -> DataFrame:
    total = F.aggregate(F.col("vector").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return df.select(*more, "vec_id", "label", r6(total).alias("total"))


def doubles(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select(F.col("embedding").cast("array<double>").alias("vector"), "vec_id", "label")


TYPES = "vector array<double>, vec_id bigint, label int"
FIELDS = ["vec_id", "label"]


# --- file sources -------------------------------------------------------------------


@query("scan_csv", ROWS_SQL + " WHERE label <> 9")
def scan_csv_(spark, sf):
    path = scratch(spark, "csv")
    text = F.concat(F.lit("["), F.array_join(F.transform("vector", lambda x: x.cast("string")), ", "), F.lit("]"))
    literal = F.when(F.col("label") == 9, F.lit("no vector")).otherwise(text)
    doubles(spark, sf).withColumn("vector", literal).write.option("header", True).option("escape", '"').csv(path)
    df = scan_csv(spark, SourceConfig("csv", path, "vector", FIELDS, TYPES.replace("array<double>", "string")))
    return with_total(split_rejects(df)[0])


def _chunk_files(spark, sf, name: str, columnar: bool) -> str:
    """JSON files of 64 records each, as an array of objects or an object of arrays."""
    path = scratch(spark, name)
    chunks = rows.gather_batches(doubles(spark, sf), 64, "vec_id", "vector", "vec_id", "label")
    record = lambda s: F.struct(s["vector"].alias("vector"), s["vec_id"].alias("vec_id"), s["label"].alias("label"))
    if columnar:
        # A field of an array of structs is the array of that field.
        columns = [F.col(f"items.{c}").alias(c) for c in ("vector", "vec_id", "label")]
        body = F.to_json(F.struct(*columns))
    else:
        body = F.to_json(F.transform("items", record))
    chunks.select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return path


def _scanned(spark, sf, kind: str, columnar: bool) -> DataFrame:
    path = _chunk_files(spark, sf, kind, columnar)
    return with_total(scan_by_config(spark, SourceConfig(kind, path, "vector", FIELDS, TYPES)))


@query("scan_json_records", ROWS_SQL)
def scan_json_records(spark, sf):
    return _scanned(spark, sf, "json", False)


@query("scan_json_columnar", ROWS_SQL)
def scan_json_columnar(spark, sf):
    return _scanned(spark, sf, "json_columnar", True)


@query("scan_yaml", ROWS_SQL)
def scan_yaml(spark, sf):
    # JSON text is YAML text.
    return _scanned(spark, sf, "yaml", False)


@query("scan_npz", ROWS_SQL)
def scan_npz(spark, sf):
    """Archives of 64 rows each. Spark has no sink for them, so they lie in a column."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    chunks = rows.gather_batches(e, 64, "vec_id", "vector", "vec_id", "label")

    def pack(batches):
        for batch in batches:
            for items in batch["items"]:
                body = io.BytesIO()
                np.savez(
                    body,
                    vector=np.array([list(i["vector"]) for i in items]),
                    vec_id=np.array([i["vec_id"] for i in items]),
                    label=np.array([i["label"] for i in items]),
                )
                yield pd.DataFrame({"content": [body.getvalue()]})

    path = scratch(spark, "npz")
    chunks.select("items").mapInPandas(pack, "content binary").write.parquet(path)
    config = SourceConfig("npz", path, "vector", FIELDS, TYPES)
    return with_total(read_contents(spark.read.parquet(path), config, read_npz))


@query("scan_by_config", ROWS_SQL)
def scan_by_type(spark, sf):
    path = scratch(spark, "parquet")
    doubles(spark, sf).write.parquet(path)
    return with_total(scan_by_config(spark, SourceConfig("PARQUET", path, "vector", FIELDS)))


# --- object storage -------------------------------------------------------------------


def _stored(spark, sf) -> str:
    root = scratch(spark, "store")
    rows_ = collection(spark, sf)
    object_store.upload_collection(rows_, root, "all")
    object_store.upload_collection(rows_.where("label >= 5"), root, "all_high")
    return root


@query("scan_object_store", "SELECT vec_id AS id, CAST(len(embedding) AS INT) AS dim FROM embeddings")
def scan_object_store(spark, sf):
    df = object_store.scan_object_store(spark, "FILE", _stored(spark, sf), "all/vectors")
    return df.select("id", F.size("vector").alias("dim"))


@query("list_objects", "SELECT 'metadata' AS part, true AS held, true AS sized UNION ALL SELECT 'vectors', true, true")
def list_objects(spark, sf):
    listed = object_store.list_objects(spark, _stored(spark, sf), "all/")
    part = F.split("key", "/")[1]
    data = listed.where(F.col("key").endswith(".parquet"))
    return data.groupBy(part.alias("part")).agg(
        (F.count("*") > 0).alias("held"), (F.min("length") > 0).alias("sized")
    )


@query("list_stored_collections", "SELECT 'all' AS collection UNION ALL SELECT 'all_high'")
def list_stored_collections(spark, sf):
    return object_store.list_stored_collections(spark, _stored(spark, sf))


@query(
    "upload_collection",
    """SELECT 'vectors' AS part, count(*) AS n FROM embeddings UNION ALL SELECT 'metadata', count(*) FROM embeddings""",
)
def upload_collection(spark, sf):
    root = _stored(spark, sf)
    parts = [
        spark.read.parquet(f"{root}/all/{part}").agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
        for part in ("vectors", "metadata")
    ]
    return parts[0].unionByName(parts[1])


@query("download_collection", ROWS_SQL)
def download_collection(spark, sf):
    df = object_store.download_collection(spark, _stored(spark, sf), "all")
    return with_total(df.withColumnRenamed("id", "vec_id"))


@query("upload_download_collection", "SELECT vec_id AS id, label, CAST(len(embedding) AS INT) AS dim FROM embeddings")
def upload_download_collection(spark, sf):
    df = object_store.download_collection(spark, _stored(spark, sf), "all")
    return df.select("id", "label", F.size("vector").alias("dim"))


@query("sync_collections", "SELECT vec_id AS id, label FROM embeddings WHERE label < 5")
def sync_collections(spark, sf):
    root = _stored(spark, sf)
    stored = object_store.download_collection(spark, root, "all")
    return object_store.missing_rows(stored, object_store.download_collection(spark, root, "all_high")).select("id", "label")


# --- tables: the state after a run of mutations ------------------------------------------


@query(
    "table_mutations",
    """WITH base AS (SELECT vec_id AS id, label FROM embeddings),
    d AS (SELECT * FROM base WHERE label <> 3),
    u AS (SELECT id, CASE WHEN label = 5 THEN 500 ELSE label END AS label FROM d),
    p AS (SELECT coalesce(l.doc_id, u.id) AS id, CASE WHEN l.doc_id IS NOT NULL THEN l.quality + 700 ELSE u.label END AS label
      FROM u FULL OUTER JOIN labels l ON u.id = l.doc_id),
    n AS (SELECT (SELECT max(id) FROM p) + row_number() OVER (ORDER BY doc_id) AS id, CAST(n_chars AS INT) AS label FROM documents)
    SELECT id, label FROM p UNION ALL SELECT id, label FROM n""",
)
def table_mutations(spark, sf):
    t = SnapshotTable(spark, scratch(spark, "table"))
    t.create(collection(spark, sf))
    t.delete("label == 3")
    t.update("label == 5", {"label": 500})
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    # Each id has an earlier change that does not count.
    changes = [labels.select("id", (F.col("quality") + n).alias("label"), F.lit(at).alias("at")) for n, at in ((300, 1), (700, 2))]
    t.upsert(reduce(DataFrame.unionByName, changes), order_by="at")
    new = table(spark, sf, "documents").select(
        "doc_id", F.col("n_chars").cast("int").alias("label"), F.lit(None).cast("array<float>").alias("vector")
    )
    t.insert(new, order_by="doc_id")
    return t.read().select("id", "label")


@query("batch_insert", "SELECT vec_id AS id, label FROM embeddings UNION ALL SELECT vec_id + 1000000, label FROM embeddings")
def batch_insert(spark, sf):
    t = SnapshotTable(spark, scratch(spark, "table"), partition_by=["label"])
    t.create(collection(spark, sf))
    t.batch_insert(collection(spark, sf).withColumn("id", F.col("id") + 1_000_000), 100)
    return t.read().select("id", "label")


@query("table_drop_partition", "SELECT vec_id AS id, label FROM embeddings WHERE label NOT IN (2, 7)")
def table_drop_partition(spark, sf):
    t = SnapshotTable(spark, scratch(spark, "table"), partition_by=["label"])
    t.create(collection(spark, sf))
    t.drop_partition([2, 7])
    return t.read().select("id", "label")


@query(
    "table_compact",
    """SELECT 'before' AS state, count(*) AS row_count FROM embeddings
    UNION ALL SELECT 'after', count(*) FROM embeddings WHERE label <> 9""",
)
def table_compact(spark, sf):
    t = SnapshotTable(spark, scratch(spark, "table"))
    t.create(collection(spark, sf))
    return t.compact("label == 9").select("state", "row_count")


# --- export, import, backup ----------------------------------------------------------------


@query("export_json", "SELECT doc_id AS id, lang, n_chars, md5(text) AS body FROM documents")
def export_json(spark, sf):
    path = scratch(spark, "export")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars", "text")
    snapshots.export_collection(docs, path, "json", compressed=True)
    back = snapshots.read_records(spark, path, "id bigint, lang string, n_chars bigint, text string")
    return back.select("id", "lang", "n_chars", F.md5("text").alias("body"))


@query(
    "import_records",
    """WITH p AS (SELECT doc_id AS id, lang, n_chars FROM documents)
    SELECT 'accepted' AS kind, id, lang, n_chars, CAST(NULL AS VARCHAR) AS error FROM p WHERE n_chars BETWEEN 50 AND 5000
    UNION ALL SELECT 'rejected', id, NULL, NULL, 'Record ' || id || ': Value for field n_chars ' || CASE WHEN n_chars < 50 THEN 'below minimum: 50' ELSE 'above maximum: 5000' END
      FROM p WHERE n_chars NOT BETWEEN 50 AND 5000
    UNION ALL SELECT 'rejected', NULL, NULL, NULL, 'not a record' FROM p
    UNION ALL SELECT 'rejected', NULL, NULL, NULL, 'not a list' FROM (SELECT DISTINCT id // 4000 FROM p)
    UNION ALL SELECT 'rejected', NULL, NULL, NULL, 'empty list'""",
)
def import_records(spark, sf):
    """Every document as a line or in a list; beside them all their lines cut off, lists without brackets, an empty list."""
    path = scratch(spark, "export")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    record = F.to_json(F.struct("id", "lang", "n_chars")).alias("value")
    in_list = F.coalesce(F.pmod("id", F.lit(2)) == 1, F.lit(False))

    def joined(rows_: DataFrame, begin: str, end: str) -> DataFrame:
        """A file of at most 4,000 records, with line breaks between them."""
        each = rows_.groupBy((F.col("id") / 4000).cast("bigint").alias("g")).agg(F.array_sort(F.collect_list(record)).alias("r"))
        return each.select(F.concat(F.lit(begin), F.array_join("r", ",\n"), F.lit(end)).alias("value"))

    docs.where(~in_list).select(record).write.text(f"{path}/lines")
    docs.select(record).select(F.substring("value", 1, 5).alias("value")).write.text(f"{path}/cut")
    joined(docs.where(in_list), "[\n", "\n]").write.option("maxRecordsPerFile", 1).text(f"{path}/lists")
    joined(docs, "", "").write.option("maxRecordsPerFile", 1).text(f"{path}/objects")
    spark.range(1, numPartitions=1).select(F.lit(" [ ] ").alias("value")).write.text(f"{path}/none")
    rules = Rules(required_fields=["id", "lang"], value_ranges={"n_chars": (50, 5000)})
    t = SnapshotTable(spark, scratch(spark, "table"))
    t.create(docs.limit(0))
    rejected = []
    for folder, layout in (("lines", "lines"), ("cut", "lines"), ("lists", "array"), ("objects", "array"), ("none", "array")):
        _, rejects = snapshots.import_records(t, f"{path}/{folder}", docs.schema, rules, {"*.txt": layout})
        rejected.append(rejects)
    none = F.lit(None)
    accepted = t.read().select(F.lit("accepted").alias("kind"), "id", "lang", "n_chars", none.cast("string").alias("error"))
    others = reduce(DataFrame.unionByName, rejected).select(
        F.lit("rejected").alias("kind"), "id", none.cast("string").alias("lang"), none.cast("bigint").alias("n_chars"), "error"
    )
    return accepted.unionByName(others)


@query(
    "validate_import",
    """SELECT 'bad' AS kind, count(*) AS n FROM documents WHERE lang = 'fr'
    UNION ALL SELECT 'record', count(*) FROM documents WHERE lang <> 'fr'""",
)
def validate_import(spark, sf):
    """Lines of which some are cut off; those are reported, not imported."""
    path = scratch(spark, "lines")
    docs = table(spark, sf, "documents")
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang"))
    cut = F.when(F.col("lang") == "fr", F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    docs.select("lang", line.alias("line")).select(cut.alias("value")).write.text(path)
    good, bad = snapshots.split_corrupt(snapshots.read_records(spark, path, "id bigint, lang string"))
    count = F.count("*").alias("n")
    return bad.agg(count).select(F.lit("bad").alias("kind"), "n").unionByName(
        good.agg(count).select(F.lit("record").alias("kind"), "n")
    )


def _backup(spark, sf, form: str) -> DataFrame:
    root = scratch(spark, "backup")
    name = snapshots.backup(collection(spark, sf), root, "my_vectors", datetime(2024, 1, 31), form)
    t = SnapshotTable(spark, scratch(spark, "table"))
    snapshots.restore(t, root, name)
    return with_total(t.read().withColumnRenamed("id", "vec_id"))


@query("backup", ROWS_SQL)
def backup(spark, sf):
    return _backup(spark, sf, "json")


@query("restore", ROWS_SQL)
def restore(spark, sf):
    return _backup(spark, sf, "parquet")


@query(
    "backup_info",
    """SELECT 'my_vectors_20240131_000000' AS name, 'my_vectors' AS collection, '20240131_000000' AS stamp, true AS sized
    UNION ALL SELECT 'my_vectors_20240130_000000', 'my_vectors', '20240130_000000', true""",
)
def backup_info(spark, sf):
    root = scratch(spark, "backup")
    for name, day in (("my_vectors", 30), ("my_vectors", 31), ("my", 31)):
        snapshots.backup(collection(spark, sf), root, name, datetime(2024, 1, day))
    info = snapshots.backup_info(spark, root, "my_vectors")
    return info.select("name", "collection", "stamp", (F.col("size") > 0).alias("sized"))


# --- clustered index on disk -----------------------------------------------------------------


@query("ivf_search_stored", ORACLES["ivf_search"])
def ivf_search_stored(spark, sf):
    """The clustered search on a written index: only probed cells are listed."""
    path = scratch(spark, "ivf")
    rows_ = collection(spark, sf)
    centroids = ivf.centroid_set(vector_mean(rows_, ["label"]), "label")
    ivf.write_index(ivf.assign_cells(rows_, centroids), path)
    stored = spark.read.parquet(path)
    return hits(ivf.ivf_search(stored, centroids, source_queries(spark, sf), nprobe=4, k=5))


@query("knn_large_query_set", ORACLES["knn_batch"])
def knn_large_query_set(spark, sf):
    """The batch search with more queries than may travel: block by block."""
    from spanvec.operators.search import knn
    from spanvec.plans.search_plans import batch_queries

    queries = batch_queries(spark, sf)
    large = QuerySet(queries.frame, queries.dim, None, None)
    return hits(knn(collection(spark, sf), large, 10, "L2"))


# --- streams ---------------------------------------------------------------------------------


def _messages_on_disk(spark, sf) -> str:
    path = scratch(spark, "topic")
    texts = message_texts(spark, sf)
    ingest.produce_messages(messages.render_messages(texts, "insert", "vectors"), path)
    # Half of the traffic is no message at all.
    broken = texts.select(F.concat(F.lit("lost "), F.to_json("metadata")).alias("value"))
    ingest.produce_messages(broken, path)
    return path


@query("stream_produce", f"WITH {MESSAGE_ROWS}, b AS (SELECT batch, count(*) AS c FROM m GROUP BY batch) SELECT CAST(c AS INT) AS vectors, 'insert' AS operation, 'vectors' AS collection FROM b")
def stream_produce(spark, sf):
    read = messages.stream_parse(spark.read.text(_messages_on_disk(spark, sf)))
    return read.select(F.size("vectors").alias("vectors"), "operation", "collection")


@query("stream_source", f"WITH {MESSAGE_ROWS} SELECT DISTINCT batch, 'vectors' AS collection FROM m")
def stream_source(spark, sf):
    """The texts of a topic as a stream, two files at a time, kept as they come."""
    source, out = _messages_on_disk(spark, sf), scratch(spark, "raw")
    stream = ingest.file_source(spark, source, max_files=2)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
    writer.option("path", f"{out}/rows").trigger(availableNow=True).start().awaitTermination()
    read = messages.stream_parse(spark.read.parquet(f"{out}/rows"))
    # The first metadata entry of a message tells its place.
    first = F.col("metadata")[0]["id"].cast("bigint")
    placed = rows.batch_assign(table(spark, sf, "embeddings").select("vec_id"), "vec_id", 16)
    return read.join(placed, first == placed["vec_id"]).select("batch", "collection")


def _ingested(spark, sf) -> str:
    root = scratch(spark, "stream")
    source = ingest.file_source(spark, _messages_on_disk(spark, sf), max_files=2)
    ingest.stream_ingest(source, root, f"{root}/checkpoint", available_now=True).awaitTermination()
    return root


@query(
    "stream_ingest",
    f"""WITH {MESSAGE_ROWS}, l AS (SELECT batch, max(pos) AS last FROM m GROUP BY batch)
    SELECT pos, CASE WHEN pos < last THEN CAST(vec_id AS VARCHAR) END AS id,
    round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS total FROM m JOIN l USING (batch)""",
)
def stream_ingest(spark, sf):
    out = ingest.read_ingested(spark, _ingested(spark, sf), "vectors")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return out.select("pos", F.col("metadata")["id"].alias("id"), r6(total).alias("total"))


@query(
    "stream_ingest_rejects",
    f"WITH {MESSAGE_ROWS} SELECT 'malformed message' AS reason, count(DISTINCT batch) AS n FROM m",
)
def stream_ingest_rejects(spark, sf):
    rejects = spark.read.parquet(f"{_ingested(spark, sf)}/rejects")
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "stream_fold",
    """SELECT vec_id, CASE WHEN label = 5 THEN 105 ELSE label END AS label,
    round(CASE WHEN label = 5 THEN 2.0 ELSE 1.0 END * list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS total
    FROM embeddings WHERE label <> 3
    UNION ALL SELECT vec_id + 1000000, label, round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0
    FROM embeddings WHERE label = 8""",
)
def stream_fold(spark, sf):
    """Updates, deletes and inserts through a stream, folded into the collection."""
    e = doubles(spark, sf)
    topic = scratch(spark, "topic")

    def send(rows_, operation, vector, **entries):
        pairs = [x for k, v in entries.items() for x in (F.lit(k), v.cast("string"))]
        one = rows_.select(F.array(vector).alias("vectors"), F.array(F.create_map(*pairs)).alias("metadata"))
        ingest.produce_messages(messages.render_messages(one, operation, "vectors"), topic)

    doubled = F.transform("vector", lambda x: x * 2)
    send(e.where("label = 5"), "update", doubled, id=F.col("vec_id"), label=F.lit(105))
    send(e.where("label = 3"), "delete", F.col("vector"), id=F.col("vec_id"))
    send(e.where("label = 8"), "insert", F.col("vector"), id=F.col("vec_id") + 1_000_000, label=F.col("label"))
    root = scratch(spark, "stream")
    source = ingest.file_source(spark, topic, max_files=2)
    ingest.stream_ingest(source, root, f"{root}/checkpoint", available_now=True).awaitTermination()
    base = e.withColumnRenamed("vec_id", "id")
    state = ingest.current_state(base, ingest.read_ingested(spark, root, "vectors"))
    return with_total(state.withColumnRenamed("id", "vec_id"))


@query(
    "stream_fold_position",
    """WITH e AS (SELECT vec_id, label, list_sum(CAST(embedding AS DOUBLE[])) AS total FROM embeddings)
    SELECT 'low' AS collection, vec_id, label, round(total, 6) + 0.0 AS total FROM e WHERE label < 5 AND label <> 3
    UNION ALL SELECT 'high', vec_id, CASE WHEN label = 5 THEN 105 ELSE label END,
      round(CASE WHEN label = 5 THEN 2.0 ELSE 1.0 END * total, 6) + 0.0 FROM e WHERE label >= 5 AND label <> 8
    UNION ALL SELECT 'high', vec_id + 1000000, label, round(total, 6) + 0.0 FROM e WHERE label = 3""",
)
def stream_fold_position(spark, sf):
    """Two collections of one stream: folded, changed directly, streamed on, folded twice."""
    topic, root = scratch(spark, "topic"), scratch(spark, "stream")
    e = doubles(spark, sf)

    def send(rows_, operation, collection_, vector, **entries):
        pairs = [x for k, v in entries.items() for x in (F.lit(k), v.cast("string"))]
        one = rows_.select(F.array(vector).alias("vectors"), F.array(F.create_map(*pairs)).alias("metadata"))
        ingest.produce_messages(messages.render_messages(one, operation, collection_), topic)

    def take():
        source = ingest.file_source(spark, topic)
        ingest.stream_ingest(source, root, f"{root}/checkpoint", available_now=True).awaitTermination()

    vector, label = F.col("vector"), F.col("label")
    send(e.where("label < 5"), "insert", "low", vector, id=F.col("vec_id"), label=label)
    send(e.where("label >= 5"), "insert", "high", vector, id=F.col("vec_id"), label=label)
    take()
    stream = FoldedStream(spark, root, "id bigint, vector array<double>, label int")
    stream.change(lambda state: state.where("label <> 3"))
    send(e.where("label = 5"), "update", "high", F.transform("vector", lambda x: x * 2), id=F.col("vec_id"), label=F.lit(105))
    send(e.where("label = 8"), "delete", "high", vector, id=F.col("vec_id"))
    send(e.where("label = 3"), "insert", "high", vector, id=F.col("vec_id") + 1_000_000, label=label)
    take()
    stream.fold()
    stream.fold()
    return with_total(stream.read().withColumnRenamed("id", "vec_id"), "collection")


@query(
    "stream_fold_messages",
    f"""WITH {MESSAGE_ROWS}, l AS (SELECT batch, max(pos) AS last FROM m GROUP BY batch)
    SELECT 'row' AS kind, CASE WHEN pos < last THEN vec_id END AS id, CASE WHEN pos < last THEN label END AS label,
    round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS total FROM m JOIN l USING (batch)
    UNION ALL SELECT 'no id', NULL, NULL, round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 FROM embeddings WHERE label = 3
    UNION ALL SELECT 'id is not a number', NULL, NULL, round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 FROM embeddings WHERE label = 4""",
)
def stream_fold_messages(spark, sf):
    """Messages of 16 vectors whose last has no metadata, and operations that do not fit, into an empty collection."""
    topic, root = scratch(spark, "topic"), scratch(spark, "stream")
    e = doubles(spark, sf)
    ingest.produce_messages(messages.render_messages(message_texts(spark, sf), "insert", "vectors"), topic)

    def send(rows_, operation, key, value):
        one = rows_.select(F.array("vector").alias("vectors"), F.array(F.create_map(F.lit(key), value)).alias("metadata"))
        ingest.produce_messages(messages.render_messages(one, operation, "vectors"), topic)

    send(e.where("label = 3"), "update", "label", F.lit("1"))
    send(e.where("label = 4"), "insert", "id", F.concat(F.lit("v"), F.col("vec_id").cast("string")))
    source = ingest.file_source(spark, topic, max_files=2)
    ingest.stream_ingest(source, root, f"{root}/checkpoint", available_now=True).awaitTermination()
    operations = ingest.read_ingested(spark, root, "vectors")
    base = e.withColumnRenamed("vec_id", "id").limit(0)
    total = r6(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)).alias("total")
    given = F.when(F.col("id") < ingest.OWN_IDS, F.col("id")).alias("id")
    state = ingest.current_state(base, operations).select(F.lit("row").alias("kind"), given, "label", total)
    rejects = ingest.split_operations(base, operations)[1]
    none = F.lit(None)
    return state.unionByName(rejects.select(F.col("reason").alias("kind"), none.cast("bigint").alias("id"), none.cast("int").alias("label"), total))


@query("stream_metric_windows", ORACLES["metric_stream"])
def stream_metric_windows(spark, sf):
    """The metric windows as a streaming query over the events, read back as a table."""
    from spanvec.plans.metric_plans import _measures, failed
    from spanvec.streaming.metrics import metric_stream

    root = scratch(spark, "windows")
    events = table(spark, sf, "events")
    source = scratch(spark, "events")
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows")

    # A watermark needs an instant; these are wall-clock times.
    rolled = metric_stream(stream, "ts", "1 day", "value", failed(), late=None)
    writer = rolled.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/checkpoint")
    writer.foreachBatch(publish).trigger(availableNow=True).start().awaitTermination()
    return _measures(spark.read.parquet(f"{root}/rows"))
