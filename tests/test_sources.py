from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
import yaml
from pyspark.sql import functions as F

from spanvec.errors import CollectionError, SourceError
from spanvec.operators.quality import Rules
from spanvec.sources import object_store as store
from spanvec.sources import snapshots
from spanvec.sources.files import (
    SourceConfig,
    load_config,
    scan_by_config,
    scan_csv,
    split_rejects,
)
from spanvec.sources.generate import generate_collection
from spanvec.sources.tables import SnapshotTable

VECTORS = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
CATEGORY, SCORE = ["A", "B"], [0.8, 0.9]
TYPES = "vector array<double>, category string, score double"


def config(kind, path, **more):
    base = dict(vector_field="vector", metadata_fields=["category", "score"], schema=TYPES)
    return SourceConfig(type=kind, path=str(path), **{**base, **more})


def write_sample(kind, folder):
    path = folder / f"sample.{kind}"
    records = [
        {"vector": v, "category": c, "score": s} for v, c, s in zip(VECTORS, CATEGORY, SCORE)
    ]
    columns = {"vector": VECTORS, "category": CATEGORY, "score": SCORE}
    if kind == "csv":
        frame = pd.DataFrame(records)
        frame["vector"] = frame["vector"].map(str)
        frame.to_csv(path, index=False)
    elif kind == "json":
        path.write_text(json.dumps(records))
    elif kind == "json_columnar":
        path.write_text(json.dumps(columns))
    elif kind == "npz":
        np.savez(path, vector=np.array(VECTORS), category=np.array(CATEGORY), score=np.array(SCORE))
    elif kind == "yaml":
        path.write_text(yaml.safe_dump(records))
    elif kind == "yaml_columnar":
        path.write_text(yaml.safe_dump(columns))
    else:
        pd.DataFrame(records).to_parquet(path)
    return path


def values(df):
    return [(list(r.vector), r.category, r.score) for r in df.orderBy("score").collect()]


SAMPLE = list(zip(VECTORS, CATEGORY, SCORE))


@pytest.mark.parametrize("kind", ["csv", "json", "json_columnar", "npz", "yaml", "parquet"])
def test_every_format_gives_the_same_rows(spark, tmp_path, kind):
    path = write_sample(kind, tmp_path)
    schema = TYPES.replace("array<double>", "string") if kind == "csv" else TYPES
    for name in (kind, kind.upper()):
        assert values(scan_by_config(spark, config(name, path, schema=schema))) == SAMPLE


def test_yaml_columns(spark, tmp_path):
    path = write_sample("yaml_columnar", tmp_path)
    assert values(scan_by_config(spark, config("yaml", path))) == SAMPLE


def test_many_npz_files(spark, tmp_path):
    for i in range(5):
        np.savez(tmp_path / f"{i}.npz", vector=np.full((2, 3), i), category=np.array(["x", "y"]), score=np.array([0.1, 0.2]))
    df = scan_by_config(spark, config("numpy", tmp_path))
    assert df.count() == 10 and df.select("vector").distinct().count() == 5


def test_pickled_npz_content_is_refused(spark, tmp_path):
    np.savez(tmp_path / "p.npz", vector=np.array([{"a": 1}], dtype=object), category=np.array(["x"]), score=np.array([0.1]))
    with pytest.raises(Exception, match="allow_pickle"):
        scan_by_config(spark, config("npz", tmp_path)).collect()


def test_inferred_csv(spark, tmp_path):
    path = write_sample("csv", tmp_path)
    assert values(scan_by_config(spark, config("csv", path, schema=None))) == SAMPLE


def test_csv_with_an_unreadable_vector(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('vector,category,score\n"[1.0, 2.0]",A,0.8\nnot a vector,B,0.9\n')
    df = scan_csv(spark, config("csv", path, schema="vector string, category string, score double"))
    good, bad = split_rejects(df)
    assert good.count() == 1 and [r.category for r in bad.collect()] == ["B"]


def test_unknown_type_and_missing_fields(spark, tmp_path):
    with pytest.raises(ValueError):
        scan_by_config(spark, config("xml", tmp_path))
    path = tmp_path / "no_vector.csv"
    path.write_text("category,score\nA,0.8\n")
    with pytest.raises(SourceError):
        scan_by_config(spark, config("csv", path, schema=None))
    path = tmp_path / "no_metadata.csv"
    path.write_text('vector\n"[1.0]"\n')
    with pytest.raises(SourceError):
        scan_by_config(spark, config("csv", path, schema=None))
    df = scan_by_config(spark, config("csv", path, schema=None), missing="null")
    assert df.first().asDict() == {"vector": [1.0], "category": None, "score": None}


def test_config_files(tmp_path):
    raw = {"type": "CSV", "path": "x.csv", "vector_field": "v", "metadata_fields": ["a"], "batch_size": 1000}
    (tmp_path / "c.json").write_text(json.dumps(raw))
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(raw))
    a, b = load_config(str(tmp_path / "c.json")), load_config(str(tmp_path / "c.yaml"))
    assert a == b and a.vector_field == "v" and a.type == "CSV"


def test_generated_rows_do_not_depend_on_partitioning(spark):
    a = generate_collection(spark, 100, 8).select("id", "vector")
    b = generate_collection(spark, 100, 8).repartition(7).select("id", "vector")
    assert a.exceptAll(b).count() == 0
    assert generate_collection(spark, 10, 128).where("size(vector) <> 128").count() == 0
    row = generate_collection(spark, 4, 2).where("id = 3").first()
    assert row.metadata == {"field_0": "value_3_0", "field_1": "value_3_1"}
    assert all(0 <= x < 1 for x in row.vector)


# --- object storage ---------------------------------------------------------------


def test_provider_uris():
    assert store.store_uri("AWS", "b", "k/x") == "s3a://b/k/x"
    assert store.store_uri("gcp", "b", "/k") == "gs://b/k"
    assert store.store_uri("Azure", "c@a.dfs.core.windows.net", "k") == "abfss://c@a.dfs.core.windows.net/k"
    with pytest.raises(ValueError):
        store.store_uri("other", "b")


def test_listing_and_round_trip(spark, collection, tmp_path):
    root = f"file://{tmp_path}/test"
    for name in ("collection1", "collection2", "other"):
        store.upload_collection(collection, root, name)
    names = {r.collection for r in store.list_stored_collections(spark, root).collect()}
    assert names == {"collection1", "collection2", "other"}
    some = store.list_objects(spark, root, "collection1/vectors")
    assert some.count() > 0 and some.where("length <= 0").count() == 0
    assert "content" not in some.columns
    back = store.download_collection(spark, root, "collection1")
    assert back.select(*collection.columns).exceptAll(collection).count() == 0 and back.count() == 200
    parts = {r.part for r in store.file_counts(spark, root, "collection1").collect()}
    assert parts == {"vectors", "metadata"}
    read = store.scan_object_store(spark, "file", str(tmp_path), "test/other/vectors")
    assert read.count() == 200


def test_sync_brings_only_missing_rows(spark, collection, tmp_path):
    store.upload_collection(collection, str(tmp_path), "c")
    stored = store.download_collection(spark, str(tmp_path), "c")
    missing = store.missing_rows(stored, collection.where("id < 150"))
    assert sorted(r.id for r in missing.collect()) == list(range(150, 200))


# --- tables -------------------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "table"))
    rows = spark.range(1000).select(
        "id", F.array((F.col("id") / 10).cast("float")).alias("vector"), F.col("id").alias("value")
    )
    t.create(rows)
    return t


def test_delete_counts_and_survivors(table):
    assert table.delete("value < 500") == 500
    assert table.read().count() == 500 and table.read().where("value < 500").count() == 0
    version = table.version()
    assert table.delete("value < 0") == 0 and table.version() == version


def test_update_changes_only_the_named_column(table):
    before = table.read().select("id", "vector")
    assert table.update("value < 500", {"value": 999}) == 500
    after = table.read()
    assert after.where("value = 999").count() == 501 and after.count() == 1000
    assert after.select("id", "vector").exceptAll(before).count() == 0


def test_update_of_an_unknown_column_changes_nothing(table):
    version = table.version()
    with pytest.raises(CollectionError):
        table.update("value < 500", {"nonexistent": 1})
    assert table.version() == version and table.read().where("value = 999").count() == 1


def test_a_failed_rewrite_leaves_the_old_version(table):
    broken = table.read().withColumn("value", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.version() == 1 and table.read().count() == 1000
    assert table.delete("value = 1") == 1 and table.version() == 2


def test_insert_gives_following_ids(spark, table):
    new = spark.range(50).select(
        F.col("id").alias("at"), F.array(F.lit(1.0).cast("float")).alias("vector"), F.col("id").alias("value")
    )
    assert table.insert(new, order_by="at") == 50
    added = table.read().where("id >= 1000").orderBy("id").collect()
    assert [(r.id, r.value) for r in added] == [(1000 + i, i) for i in range(50)]
    before = table.read()
    assert table.delete("id >= 1000") == 50
    assert table.read().count() == before.count() - 50 == 1000


def test_batch_insert_writes_chunks(spark, table):
    new = table.read().withColumn("id", F.col("id") + 5000).coalesce(1)
    files = len(table.read().inputFiles())
    assert table.batch_insert(new, 100) == 1000
    assert len(table.read().inputFiles()) == files + 10 and table.read().count() == 2000


def test_upsert_replaces_and_adds(spark, table):
    changes = spark.createDataFrame([(1, -1), (2000, -2)], "id bigint, value bigint")
    table.upsert(changes)
    rows = {r.id: r for r in table.read().where("id in (1, 2, 2000)").collect()}
    assert rows[1].value == -1 and rows[1].vector is not None
    assert rows[2].value == 2 and rows[2000].vector is None and table.read().count() == 1001


def test_compaction_reports_both_states(table):
    report = {r.state: r for r in table.compact("value >= 900", files=1).collect()}
    assert (report["before"].row_count, report["after"].row_count) == (1000, 900)
    assert report["after"].file_count == 1 <= report["before"].file_count


def test_partitioned_table(spark, collection, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "p"), partition_by=["category"])
    t.create(collection)
    assert t.drop_partition(["A"]) == 67
    left = t.read()
    assert left.count() == 133 and dict(left.dtypes)["category"] == "string"
    plan = left.where("category = 'B'")._jdf.queryExecution().executedPlan().toString()
    # All of it is decided from folder names: no filter is left for the rows.
    assert "PartitionFilters: [" in plan and "Filter (" not in plan
    t.insert(collection.where("category = 'A'"))
    assert t.read().count() == 200


def files_of(table):
    return set(table.read().select(F.input_file_name().alias("f")).distinct().toPandas()["f"])


def test_mutations_rewrite_only_the_partitions_they_touch(spark, collection, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "p"), partition_by=["category"])
    t.create(collection)
    before = files_of(t)
    assert t.delete("id = 3") == 1  # category A
    after = files_of(t)
    assert {f for f in before if "category=A" not in f} <= after
    assert not {f for f in before if "category=A" in f} & after
    # Dropping a partition writes no data file at all.
    assert t.drop_partition(["B"]) == 67 and files_of(t) < after
    assert t.read().count() == 200 - 1 - 67
    assert t.update("id = 2", {"category": "A"}) == 1  # moves from C to A
    assert t.read().where("id = 2").first().category == "A" and t.read().count() == 132
    assert t.update("label >= 0", {"label": 9}) == 132
    assert t.read().where("label <> 9").count() == 0 and t.read().count() == 132


def test_upsert_on_a_partitioned_table(spark, collection, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "p"), partition_by=["category"])
    t.create(collection)
    b = {f for f in files_of(t) if "category=B" in f}
    changes = spark.createDataFrame([(0, "C", 7), (900, "A", 8)], "id bigint, category string, label int")
    assert t.upsert(changes) == 2
    rows = {r.id: r for r in t.read().where("id in (0, 3, 900)").collect()}
    assert (rows[0].category, rows[0].label) == ("C", 7) and rows[0].vector is not None
    assert (rows[900].category, rows[900].vector) == ("A", None) and rows[3].category == "A"
    assert t.read().count() == 201 and b <= files_of(t)


def test_a_failed_insert_is_not_seen(spark, table):
    bad = table.read().withColumn("value", F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        table.insert(bad)
    assert table.read().count() == 1000 and table.version() == 1


def test_insert_without_ids_or_order(spark, table):
    new = spark.range(30).select(F.array(F.lit(1.0).cast("float")).alias("vector"), F.lit(5).cast("bigint").alias("value"))
    assert table.insert(new.repartition(3)) == 30
    ids = [r.id for r in table.read().select("id").collect()]
    assert sorted(ids) == list(range(1030))


def test_reads_and_versions_do_not_grow_with_history(spark, collection, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "p"), partition_by=["category"])
    t.create(collection.repartition(1))
    for n in range(6):
        t.update("id = 0", {"label": 100 + n})
    live = t._current().live
    # Only the write that holds a replaced partition remembers it.
    assert all(len(gone) <= 1 for gone in live.values())
    plan = t.read().where("category = 'B'")
    assert len(plan.inputFiles()) <= len(live) + 2 and t.read().where("id = 0").first().label == 105
    assert t.delete("label >= 0 or true") == 200 and t.read().count() == 0
    assert t.insert(collection) == 200 and t.read().count() == 200


def test_more_partitions_than_can_be_listed(spark, collection, tmp_path, monkeypatch):
    from spanvec.sources import tables

    monkeypatch.setattr(tables, "LISTED_PARTITIONS", 1)
    t = SnapshotTable(spark, str(tmp_path / "p"), partition_by=["category"])
    t.create(collection)
    assert t.update("label = 1", {"label": 9}) == 50 and t.delete("label = 2") == 50
    changes = spark.createDataFrame([(0, -1), (1, -2), (900, -3)], "id bigint, label int")
    assert t.upsert(changes) == 3 and t.drop_partition(["A", "C"]) > 0
    rows = {r.id: r.label for r in t.read().collect()}
    kept = {r.id: r for r in collection.collect() if r.category == "B" and r.label != 2}
    assert rows == {i: -2 if i == 1 else 9 if r.label == 1 else r.label for i, r in kept.items()} | {900: -3}


def test_the_last_change_of_an_id_counts(spark, table):
    changes = spark.createDataFrame([(1, -1, 2), (1, -9, 1), (2000, 5, 1), (2000, 6, 2)], "id bigint, value bigint, at int")
    assert table.upsert(changes, order_by="at") == 2
    rows = {r.id: r.value for r in table.read().where("id in (1, 2000)").collect()}
    assert rows == {1: -1, 2000: 6} and table.read().count() == 1001
    with pytest.raises(Exception, match="two changes of id 1"):
        table.upsert(changes.select("id", "value").where("id = 1"))
    assert table.upsert(changes.selectExpr("id", "7 as value")) == 2 and table.read().count() == 1001


def test_an_existing_collection_is_not_created_again(table):
    with pytest.raises(CollectionError):
        table.create(table.read())


def test_everything_deleted(table):
    assert table.delete("value >= 0") == 1000
    assert table.read().count() == 0 and table.delete("value >= 0") == 0


def test_reading_before_creation(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "none"))
    assert t.version() == 0
    with pytest.raises(CollectionError):
        t.read()


# --- export, import, backup ------------------------------------------------------------


RECORDS = "id bigint, text string, category string, score double"


def sample_records(spark):
    return spark.createDataFrame([(1, "a", "X", 0.5), (2, "b", "Y", 0.7)], RECORDS)


@pytest.mark.parametrize("compressed", [False, True])
def test_export_import_round_trip(spark, tmp_path, compressed):
    df = sample_records(spark)
    snapshots.export_collection(df, str(tmp_path / "out"), "json", compressed)
    back = snapshots.read_records(spark, str(tmp_path / "out"), RECORDS).drop("_corrupt_record", "_reason")
    assert back.exceptAll(df).count() == 0 and back.count() == 2


def test_unknown_export_format(spark, tmp_path):
    with pytest.raises(SourceError):
        snapshots.export_collection(sample_records(spark), str(tmp_path / "x"), "xml")


def test_csv_export_of_vectors(spark, collection, tmp_path):
    snapshots.export_collection(collection, str(tmp_path / "csv"), "csv")
    back = scan_csv(
        spark,
        SourceConfig("csv", str(tmp_path / "csv"), "vector", ["id", "category"], "id bigint, vector string, label int, category string"),
    )
    assert back.count() == 200 and back.where("size(vector) <> 8").count() == 0


def test_import_of_an_array_with_rejects(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text(json.dumps([{"id": 1, "text": "a", "category": "X", "score": 0.5}, {"id": 2, "category": "Y", "score": 3.0}]))
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.create(sample_records(spark).limit(0))
    rules = Rules(required_fields=["id", "text"], value_ranges={"score": (0, 1)})
    count, errors = snapshots.import_records(t, str(path), RECORDS, rules, {"*.json": "array"})
    assert count == 1 and [r.error for r in errors.collect()] == ["Record 2: Missing required field: text"]
    assert t.read().count() == 1


def test_empty_import(spark, tmp_path):
    path = tmp_path / "empty.json"
    path.write_text("[]")
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.create(sample_records(spark).limit(0))
    count, rejects = snapshots.import_records(t, str(path), RECORDS, layouts={None: "array"})
    assert count == 0 and [(r.error, r.text) for r in rejects.collect()] == [("empty list", "[]")]


def test_import_reports_every_text_it_does_not_take(spark, tmp_path):
    """Lines and lists in one folder, each under its own layout."""
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n{"id": 2\n{"id": 3}\n')
    (tmp_path / "b.json").write_text('[{"id": 4},\n 5, null, {"id": 6}]')
    (tmp_path / "c.json").write_text('{"id": 7}\n{"id": 8}\n')
    (tmp_path / "d.json").write_text('[{"id": 9}, {"id": "x"}]')
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.create(spark.createDataFrame([], "id bigint"))
    count, rejects = snapshots.import_records(t, str(tmp_path), "id bigint", layouts={"*.jsonl": "lines", "*.json": "array"})
    assert count == 5 and sorted(r.id for r in t.read().collect()) == [1, 3, 4, 6, 9]
    assert sorted((r.error, r.text.strip()) for r in rejects.collect()) == [
        ("not a list", '{"id": 7}\n{"id": 8}'), ("not a record", '{"id": 2'), ("not a record", '{"id":"x"}'),
        ("not a record: 1", "5"), ("not a record: 2", "null"),
    ]


def test_backup_keeps_the_newest(spark, collection, tmp_path):
    from datetime import datetime

    for day in (1, 2, 3, 4):
        snapshots.backup(collection.limit(5), str(tmp_path), "c", datetime(2024, 1, day), keep=2)
    snapshots.backup(collection.limit(5), str(tmp_path), "c_d", datetime(2023, 1, 1), keep=2)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["c_20240103_000000", "c_20240104_000000", "c_d_20230101_000000"]


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_backup_and_restore(spark, collection, tmp_path, form):
    root = str(tmp_path / "backups")
    name = snapshots.backup(collection, root, "my_coll", datetime(2024, 1, 2, 3, 4, 5), form)
    assert name == "my_coll_20240102_030405"
    t = SnapshotTable(spark, str(tmp_path / "restored"))
    snapshots.restore(t, root, name)
    back = t.read()
    assert back.schema.simpleString() == collection.schema.simpleString()
    assert back.exceptAll(collection).count() == 0 and back.count() == 200


def test_backup_info_and_retention(spark, collection, tmp_path):
    root = str(tmp_path / "backups")
    few = collection.limit(3)
    for day in (1, 2, 3):
        snapshots.backup(few, root, "a", datetime(2024, 1, day))
    snapshots.backup(few, root, "a_b", datetime(2024, 1, 9))
    info = snapshots.backup_info(spark, root, "a").collect()
    assert [r.name for r in info] == ["a_20240103_000000", "a_20240102_000000", "a_20240101_000000"]
    assert all(r.size > 0 for r in info)
    gone = snapshots.backup_retention(snapshots.backup_info(spark, root).select("name", "collection"), 2)
    assert [r.name for r in gone.collect()] == ["a_20240101_000000"]
