"""Export, import, backup and restore."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.errors import SourceError
from spanvec.functions.text import parse_backup_name
from spanvec.operators.quality import Rules, validate_records
from spanvec.operators.series import expired_snapshots
from spanvec.session import delete_folder
from spanvec.sources.object_store import list_objects
from spanvec.sources.tables import SnapshotTable, saved_schema, schema_of

# The forms of an export.
EXPORT_FORMATS = ("json", "parquet", "csv")
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def export_collection(df: DataFrame, path: str, form: str = "json", compressed: bool = False) -> None:
    """A folder of part files; nested columns are JSON text in a CSV export."""
    if form not in EXPORT_FORMATS:
        raise SourceError(f"unsupported export format: {form}")
    writer_of = df
    if form == "csv":
        texts = {
            f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, NESTED)
        }
        writer_of = df.withColumns(texts) if texts else df
    writer = writer_of.write.mode("errorifexists")
    if form == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if compressed and form != "parquet":
        writer = writer.option("compression", "gzip")
    writer.format(form).save(path)


LAYOUTS = ("lines", "array")


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, layout: str = "lines", files: str | None = None) -> DataFrame:
    """JSON records with what is wrong with a text: ``_corrupt_record`` and ``_reason``.

    The caller names the layout: ``lines`` has a record in each line, ``array``
    one list in each file, which one task reads whole. ``files`` is a file name
    pattern, so a folder may hold both. An array file that is no list or an
    empty one is reported whole, an element that is no record by its place.
    """
    if layout not in LAYOUTS:
        raise SourceError(f"unknown layout: {layout}")
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*declared.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read if files is None else spark.read.option("pathGlobFilter", files)
    if layout == "lines":
        rows = reader.schema(wide).json(path)
        return rows.withColumn("_reason", F.when(F.col("_corrupt_record").isNotNull(), F.lit("not a record")))
    whole = reader.text(path, wholetext=True)
    size = F.json_array_length("value")
    listed = whole.withColumn("_size", F.when(F.ltrim("value").startswith("["), size))
    items = F.when(F.col("_size") > 0, F.from_json("value", "array<string>"))
    each = listed.select("value", "_size", F.posexplode_outer(items).alias("_at", "_item"))
    record = F.ltrim("_item").startswith("{")
    reason = (
        F.when(F.col("_size").isNull(), F.lit("not a list"))
        .when(F.col("_size") == 0, F.lit("empty list"))
        .when(~F.coalesce(record, F.lit(False)), F.concat(F.lit("not a record: "), F.col("_at").cast("string")))
    )
    text = F.when(F.col("_size") > 0, F.coalesce("_item", F.lit("null"))).otherwise(F.col("value"))
    parsed = each.select(F.from_json(F.when(reason.isNull(), F.col("_item")), wide, {"mode": "PERMISSIVE"}).alias("r"), reason.alias("_reason"), text.alias("_text"))
    broken = F.col("_reason").isNotNull() | F.col("r._corrupt_record").isNotNull()
    return parsed.select(
        *[F.col("r")[f.name].alias(f.name) for f in declared.fields],
        F.when(broken, F.col("_text")).alias("_corrupt_record"),
        F.when(broken, F.coalesce("_reason", F.lit("not a record"))).alias("_reason"),
    )


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records, and the texts that are none with the reason.

    Spark refuses to read the corrupt column of raw files alone, so the test
    also looks at a field, without regard to its value.
    """
    field = next(c for c in rows.columns if c not in ("_corrupt_record", "_reason"))
    looked = F.coalesce(F.length(F.col(field).cast("string")) >= 0, F.lit(True))
    broken = F.col("_corrupt_record").isNotNull() & looked
    return rows.where(~broken).drop("_corrupt_record", "_reason"), rows.where(broken).select("_corrupt_record", "_reason")


def import_records(
    table: SnapshotTable,
    path: str,
    schema: T.StructType | str,
    rules: Rules | None = None,
    layouts: Mapping[str | None, str] | None = None,
) -> tuple[int, DataFrame]:
    """Read records, append the valid ones; return their number and ``id, error, text`` of all others.

    ``layouts`` names the layout of the files of each name pattern; all are lines without it.
    """
    parts = [read_records(table.spark, path, schema, layout, files) for files, layout in (layouts or {None: "lines"}).items()]
    good, broken = split_corrupt(reduce(DataFrame.unionByName, parts))
    if rules is None:
        valid, errors = good, good.limit(0).select("id", F.lit("").alias("error"))
    else:
        valid, errors = validate_records(good, rules)
    texts = broken.select(F.lit(None).cast(good.schema["id"].dataType).alias("id"), F.col("_reason").alias("error"), F.col("_corrupt_record").alias("text"))
    rejects = errors.withColumn("text", F.lit(None).cast("string")).unionByName(texts)
    return table.insert(valid), rejects


def backup(
    df: DataFrame, root: str, collection: str, at: datetime, form: str = "parquet", keep: int | None = None
) -> str:
    """A snapshot folder ``<collection>_<stamp>`` with data and schema.

    With ``keep`` only that many of the collection's backups stay, the newest.
    """
    name = f"{collection}_{at:%Y%m%d_%H%M%S}"
    base = f"{root}/{name}"
    writer = df.write.mode("errorifexists")
    if form == "json":
        writer = writer.option("compression", "gzip")
    writer.format(form).save(f"{base}/data")
    described = df.sparkSession.createDataFrame(
        [(saved_schema(df), form)], "schema string, form string"
    )
    described.coalesce(1).write.json(f"{base}/schema")
    if keep is not None:
        for old in expired_backups(df.sparkSession, root, collection, keep):
            delete_folder(df.sparkSession, f"{root}/{old}")
    return name


def expired_backups(spark: SparkSession, root: str, collection: str, keep: int) -> list[str]:
    """Names of a collection's backups beyond the newest ``keep``, by the stamp in the name."""
    names = backup_info(spark, root, collection).select("name").orderBy(F.desc("name"))
    return [r.name for r in names.offset(keep).collect()]


def read_backup(spark: SparkSession, root: str, name: str) -> DataFrame:
    base = f"{root}/{name}"
    described = spark.read.schema("schema string, form string").json(f"{base}/schema").first()
    return spark.read.schema(schema_of(described.schema)).format(described.form).load(f"{base}/data")


def restore(table: SnapshotTable, root: str, name: str) -> int:
    """Make the table hold what the backup holds; create it if need be."""
    return table.replace(read_backup(table.spark, root, name))


def backup_info(spark: SparkSession, root: str, collection: str | None = None) -> DataFrame:
    """``name, collection, stamp, size, created`` of each backup, newest first."""
    listed = list_objects(spark, root)
    named = listed.withColumn("name", F.split("key", "/")[0])
    grouped = named.groupBy("name").agg(
        F.sum("length").alias("size"), F.min("modificationTime").alias("created")
    )
    parts = grouped.withColumn("p", parse_backup_name("name")).select("name", "p.*", "size", "created")
    if collection is not None:
        # Not only a prefix: ``a_`` also starts the backups of ``a_b``.
        parts = parts.where(F.col("name").startswith(collection + "_") & (F.col("collection") == collection))
    return parts.orderBy(F.col("created").desc(), F.col("name").desc())


def backup_retention(listing: DataFrame, keep: int) -> DataFrame:
    """Names of the backups beyond the newest ``keep`` of each collection."""
    return expired_snapshots(listing, keep)
