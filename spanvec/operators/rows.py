"""Row numbers over a whole table without meeting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.session import materialize


GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 256


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each key with their rank.

    For ``rank <= n`` Spark cuts every map task to ``n`` rows per key before
    the shuffle, so a key that holds most rows does not meet in one task. It
    does so up to a limit on ``n``; beyond that the key is first cut down in
    salted parts, whose best ``n`` hold the best ``n`` of the whole.
    """
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT_KEY, "1000")):
        # Spark does not hash maps and variants.
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(SALTS)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_part", F.row_number().over(part)).where(F.col("_part") <= n)
        df = df.drop("_salt", "_part")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(whole)).where(F.col(out) <= n)


def global_row_number(df: DataFrame, key: str, out: str = "pos") -> DataFrame:
    """1-based position of each row in the order of a unique numeric key.

    A row without a key is an error.

    Quantiles of the key cut the rows into ranges. The range of a row depends
    on its key alone, so a task that is run again numbers its rows the same.
    Counting the ranges gives each one its offset; only that table, one row
    per range, is ordered as a whole.
    """
    spark = df.sparkSession
    # Several ranges per task even out how they fall on the tasks.
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / ranges for i in range(1, ranges)]
    nameless = F.raise_error(F.lit(f"row without a {key}")).cast("double")
    number = F.coalesce(F.col(key).cast("double"), nameless)
    keyed = df.select(number.alias("_key"))
    cuts = sorted(set(keyed.approxQuantile("_key", steps, 1.0 / (4 * ranges))))
    split = Bucketizer(
        splits=[-float("inf"), *(cuts or [0.0]), float("inf")], inputCol="_key", outputCol="_range"
    )
    ranged = split.transform(df.withColumn("_key", number))
    counts = split.transform(keyed).groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(key)
    # One row per range: the number of shuffle partitions bounds this side.
    numbered = ranged.join(F.broadcast(offsets), "_range").withColumn(
        out, F.row_number().over(inside) + F.col("_offset")
    )
    return numbered.drop("_key", "_range", "_offset")


def assign_ids(new_rows: DataFrame, order_by: str, highest: int | None, id_col: str = "id") -> DataFrame:
    """New rows with ids following the highest one in use, in key order."""
    numbered = global_row_number(new_rows, order_by, "_pos")
    first = 0 if highest is None else highest + 1
    return numbered.withColumn(id_col, F.col("_pos") - 1 + F.lit(first)).drop("_pos")


def number_rows(rows: DataFrame, first: int, id_col: str = "id") -> DataFrame:
    """Rows as they come with consecutive ids from ``first`` on.

    The rows are written with the number of their task and their place in it, so a task
    that runs again numbers the same rows; the counts of the tasks give each its first id.
    """
    placed = materialize(rows.withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_task", F.shiftright("_place", 33))
    counts = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    at = F.col("_offset") + F.col("_place") - F.shiftleft("_task", 33) + F.lit(first)
    # One row per task of the write: the number of tasks bounds this side.
    return placed.join(F.broadcast(offsets), "_task").withColumn(id_col, at).drop("_place", "_task", "_offset")


def batch_assign(df: DataFrame, key: str, batch_size: int) -> DataFrame:
    """Chunk number and position inside the chunk: chunk *i* holds rows ``i*b`` on."""
    at = F.col("_pos") - 1
    return (
        global_row_number(df, key, "_pos")
        .withColumn("batch", F.floor(at / batch_size).cast("bigint"))
        .withColumn("batch_pos", F.pmod(at, F.lit(batch_size)).cast("bigint"))
        .drop("_pos")
    )


def zip_by_position(
    vectors: DataFrame, metadata: DataFrame, vector_key: str, metadata_key: str
) -> DataFrame:
    """Pair the i-th vector with the i-th metadata row; a missing one is NULL."""
    left = global_row_number(vectors, vector_key)
    right = global_row_number(metadata, metadata_key)
    return left.join(right, "pos", "left")


def gather_batches(df: DataFrame, batch_size: int, key: str, *columns: str) -> DataFrame:
    """One row per chunk holding its rows in order; a chunk has a fixed size."""
    item = F.struct("batch_pos", *columns)
    return (
        batch_assign(df, key, batch_size)
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )


def flatten_batches(batches: DataFrame, items: str = "items") -> DataFrame:
    """Chunk results back to rows, with their place in the whole."""
    return batches.select("batch", F.inline(items))
