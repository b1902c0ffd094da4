"""Collections in object storage, through Spark's own file-system connectors.

Layout of a stored collection: ``<prefix>/<collection>/vectors`` holds ids and
vectors, ``<prefix>/<collection>/metadata`` everything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanvec.errors import SourceError
from spanvec.operators.joins import anti_delete
from spanvec.session import has_folder

# The URI scheme of each provider.
SCHEMES = {"aws": "s3a", "gcp": "gs", "azure": "abfss", "file": "file"}


def store_uri(provider: str, bucket: str, key: str = "") -> str:
    """``s3a://bucket/key`` and so on; the provider's name in any case."""
    scheme = SCHEMES.get(provider.lower())
    if scheme is None:
        raise ValueError(f"unsupported cloud provider: {provider}")
    root = f"file://{bucket}" if scheme == "file" else f"{scheme}://{bucket}"
    return f"{root.rstrip('/')}/{key.lstrip('/')}" if key else root


def scan_object_store(
    spark: SparkSession, provider: str, bucket: str, key: str, form: str = "parquet"
) -> DataFrame:
    return spark.read.format(form).load(store_uri(provider, bucket, key))


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """``path, length, modificationTime`` of the objects whose key has a prefix.

    The listing is a scan without the content column, of the folder that the
    prefix names only.
    """
    folder = f"{root}/{prefix.rpartition('/')[0]}".rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if has_folder(spark, folder):
        listed = reader.load(folder).select("path", "length", "modificationTime")
    else:
        listed = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    base = root.split("://", 1)[-1].rstrip("/")
    key = F.regexp_replace(F.substring_index(F.col("path"), base, -1), "^/", "")
    return listed.withColumn("key", key).where(F.col("key").startswith(prefix))


def list_stored_collections(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Distinct collection names, the first folder under the prefix."""
    head = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    keys = list_objects(spark, root, head)
    rest = F.expr(f"substring(key, {len(head) + 1})")
    parts = F.split(rest, "/")
    return keys.where(F.size(parts) > 1).select(parts[0].alias("collection")).distinct()


def upload_collection(df: DataFrame, root: str, collection: str) -> None:
    base = f"{root}/{collection}"
    df.select("id", "vector").write.mode("overwrite").parquet(f"{base}/vectors")
    df.drop("vector").write.mode("overwrite").parquet(f"{base}/metadata")


def download_collection(spark: SparkSession, root: str, collection: str) -> DataFrame:
    base = f"{root}/{collection}"
    vectors = spark.read.parquet(f"{base}/vectors")
    return vectors.join(spark.read.parquet(f"{base}/metadata"), "id", "left")


def file_counts(spark: SparkSession, root: str, collection: str) -> DataFrame:
    """Files per part of a stored collection."""
    listed = list_objects(spark, root, f"{collection}/")
    part = F.split("key", "/")[1]
    data = listed.where(F.col("key").endswith(".parquet"))
    return data.groupBy(part.alias("part")).agg(F.count("*").alias("file_count"))


def missing_rows(stored: DataFrame, local: DataFrame) -> DataFrame:
    """Stored rows the local collection does not have yet."""
    return anti_delete(stored, local)


def collection_uri(provider: str, bucket: str, prefix: str, collection: str) -> str:
    if not collection:
        raise SourceError("a stored collection needs a name")
    return store_uri(provider, bucket, "/".join(p for p in (prefix.strip("/"), collection) if p))
