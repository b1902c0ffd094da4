"""Plans and layouts: what reaches the scan, what is cut before a shuffle, what is split."""

from __future__ import annotations

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from spanvec.operators import ivf, mutations
from spanvec.operators.aggregates import vector_mean
from spanvec.operators.search import QuerySet, attach_fields, knn, most_hits
from spanvec.session import materialize
from spanvec.sources.tables import SnapshotTable
from spanvec.streaming.metrics import metric_stream

QUERIES = entry.queries()


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("scan_query", "EqualTo(lang,en), GreaterThan(n_chars,500)"),
        ("filter_in", "In(source, [src1,src12,src5])"),
        ("filter_date_range", "GreaterThanOrEqual(ts,2024-01-05"),
        ("filter_partitions", "In(label, [1,2])"),
        ("filter_operation", "EqualTo(event_type,click)"),
        ("metric_retention", "GreaterThan(ts,2024-01-24"),
        ("knn_in_partitions", "In(label, [0,1])"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("scan_all", "struct<vec_id:bigint,label:int>"),
        ("collection_stats", "struct<label:int>"),
        ("batch_update", "struct<vec_id:bigint,label:int>"),
        ("metric_summary", "struct<ts:timestamp_ntz,event_type:string,value:double>"),
        ("batch_assign", "struct<vec_id:bigint>"),
        ("validation_summary", "struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SMALL))
    read = plan.split("ReadSchema: ")[1:]
    allowed = set(columns[7:-1].split(","))
    assert read and all(set(r.split("\n")[0][7:-1].split(",")) <= allowed for r in read)


@pytest.mark.parametrize("name", ["last_n_history", "newest_n_snapshots", "topk_per_query", "knn_l2"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    cut = plan.index("Partial", plan.index("Exchange hashpartitioning"))
    assert cut > 0 and plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["metric_summary", "dedup_records", "latest_per_type", "validation_summary", "error_rate"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert plan.count("Aggregate(") >= 2 and "partial_" in plan.split("Exchange")[-1]


@pytest.mark.parametrize(
    "name", ["delete_where", "batch_delete", "batch_update", "validate_records", "vec_normalize", "derive_metadata", "check_type"]
)
def test_row_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SMALL))


def test_few_changes_do_not_shuffle_the_collection(spark, collection, tmp_path):
    path = str(tmp_path / "c")
    collection.write.parquet(path)
    stored = spark.read.parquet(path)
    changes = materialize(spark.createDataFrame([(1, 9), (999, 9)], "id bigint, label int"))
    out = mutations.upsert(stored, changes)
    assert "SortMergeJoin" not in plan_of(out) and "hashpartitioning" not in plan_of(out)
    assert out.count() == 201


def test_attached_fields_do_not_shuffle_the_entities(spark, collection):
    queries = QuerySet.of(vector_mean(collection, ["label"]), "label")
    assert most_hits(queries, 5) == 20
    out = attach_fields(knn(collection, queries, 5), collection, ["category"], 20, how="inner")
    plan = plan_of(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_python_runs_once_per_row(spark, collection):
    queries = QuerySet.of(vector_mean(collection, ["label"]), "label")
    indexed = ivf.assign_cells(collection, queries)
    plan = plan_of(indexed.where("centroid_id is not null and centroid_id in (0, 1)"))
    assert plan.count("ArrowEvalPython") == 1
    assert plan_of(QUERIES["embed_text"](spark, SMALL)).count("ArrowEvalPython") == 1


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60_000).select(
        "id",
        F.sha2(F.col("id").cast("string"), 512).alias("body"),
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 30).cast("int").alias("label"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        t = SnapshotTable(spark, str(tmp_path / "t"), partition_by=["label"])
        t.create(rows.repartition(8))
    finally:
        spark.conf.set(key, before)
    files = t.read().select("label", F.input_file_name().alias("f")).groupBy("label").agg(F.countDistinct("f").alias("n"))
    per_label = {r.label: r.n for r in files.collect()}
    # Split where it is large, yet far from one file per task and partition.
    assert per_label[0] >= 3 and sum(per_label.values()) < 40
    assert t.read().count() == 60_000


def test_windows_close_behind_the_watermark(spark, tmp_path):
    source, out = str(tmp_path / "events"), str(tmp_path / "out")

    def write(first_minute, minutes):
        spark.sql(
            f"select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id + {first_minute} as int)) as ts, "
            f"cast(id as double) as value, id % 4 = 0 as bad from range({minutes})"
        ).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("ts timestamp, value double, bad boolean").parquet(source)
        rolled = metric_stream(stream, "ts", "1 hour", "value", F.col("bad"), late="10 minutes")
        writer = rolled.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "check"))
        writer.format("parquet").option("path", out).trigger(availableNow=True).start().awaitTermination()

    write(0, 120)
    run()
    write(300, 5)
    run()
    closed = {r.window_start.hour: (r.query_count, r.error_count) for r in spark.read.parquet(out).collect()}
    assert closed == {0: (60, 15), 1: (60, 15)}


def test_package_reaches_workers_from_any_folder(spark, collection, monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    assert knn(collection, QuerySet.literal(spark, [[0.0] * 8]), 1).count() == 1


def test_a_filter_given_to_a_provider_reaches_the_scan(spark):
    from spanvec.operators import providers

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    plan = plan_of(providers.embed_text(docs, "text", 8, where="lang = 'de'"))
    assert "EqualTo(lang,de)" in plan
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    centroids = ivf.centroid_set(vector_mean(rows.withColumnRenamed("embedding", "vector"), ["label"]), "label")
    plan = plan_of(ivf.assign_cells(rows.withColumnRenamed("embedding", "vector"), centroids, where="label = 3"))
    assert "EqualTo(label,3)" in plan


def test_written_frames_are_deleted_when_discarded(spark):
    from pathlib import Path

    from spanvec.session import discard, materialize

    written = materialize(spark.range(5))
    (folder,) = {Path(f.removeprefix("file:")).parent for f in written.inputFiles()}
    assert written.count() == 5 and folder.exists()
    discard(written, spark.range(3), written)
    assert not folder.exists()
