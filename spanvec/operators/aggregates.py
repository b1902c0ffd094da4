"""Aggregations over collections and metric series.

All of them are plain ``groupBy`` aggregates, so Spark combines rows on the
map side first and a key that holds most rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_mean_parts(df: DataFrame, keys: Sequence[str], vector_col: str = "vector") -> DataFrame:
    """Element-wise mean per key, one row per (key, position from 1)."""
    parts = df.select(*keys, F.posexplode(vector_col).alias("p", "x"))
    means = parts.groupBy(*keys, "p").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    return means.select(*keys, (F.col("p") + 1).alias("pos"), "mean")


def vector_mean(df: DataFrame, keys: Sequence[str], vector_col: str = "vector") -> DataFrame:
    """Element-wise mean vector per key; a group here is one row per position."""
    parts = vector_mean_parts(df, keys, vector_col)
    ordered = F.sort_array(F.collect_list(F.struct("pos", "mean")))
    out = parts.groupBy(*keys).agg(F.transform(ordered, lambda s: s["mean"]).alias("vector"))
    return out


def collection_stats(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows per partition and, with a NULL partition, in total."""
    return df.rollup(partition_col).agg(
        F.count("*").alias("row_count"), F.grouping(partition_col).cast("int").alias("is_total")
    )


def list_partitions(catalog: DataFrame, df: DataFrame, partition_col: str) -> DataFrame:
    """Each declared partition with its entity count, 0 when it is empty."""
    counts = df.groupBy(partition_col).agg(F.count("*").alias("num_entities"))
    joined = catalog.join(counts, catalog["name"] == counts[partition_col], "left")
    return joined.select(*catalog.columns, F.coalesce("num_entities", F.lit(0)).alias("num_entities"))


def partition_stats(
    catalog: DataFrame, df: DataFrame, partition_col: str, name: str, is_loaded: bool = False
) -> DataFrame:
    one = list_partitions(
        catalog.where(F.col("name") == name), df.where(F.col(partition_col) == name), partition_col
    )
    return one.withColumn("is_loaded", F.lit(is_loaded))


def metric_summary(
    events: DataFrame, group: Sequence[Column], value: Column, is_error: Column
) -> DataFrame:
    """Average value, query count, error count and error rate per group."""
    return events.groupBy(*group).agg(
        F.count("*").alias("query_count"),
        F.count_if(is_error).alias("error_count"),
        F.avg(value).alias("avg_latency"),
        error_rate(is_error).alias("error_rate"),
    )


def error_rate(is_error: Column) -> Column:
    """Errors in percent of all rows, as an aggregate."""
    return F.lit(100.0) * F.count_if(is_error) / F.count("*")


def profile_summary(events: DataFrame, operation: str, duration: str) -> DataFrame:
    return events.groupBy(operation).agg(
        F.count("*").alias("calls"),
        F.avg(duration).alias("mean_duration"),
        F.max(duration).alias("max_duration"),
        (F.max(duration) - F.min(duration)).alias("duration_spread"),
    )


def batch_report(
    outcomes: DataFrame, keys: Sequence[str], failed: Column, seconds: Column, error: Column
) -> DataFrame:
    """Totals of a batch run from one outcome row per item.

    Messages are counted apart by ``error_counts``; they are never gathered
    into one row, which would grow with the data.
    """
    return outcomes.groupBy(*keys).agg(
        F.count("*").alias("total_items"),
        F.count_if(~failed).alias("successful_items"),
        F.count_if(failed).alias("failed_items"),
        F.sum(seconds).alias("total_time"),
        F.avg(seconds).alias("average_time"),
        F.min(F.when(failed, error)).alias("first_error"),
    )


def error_counts(outcomes: DataFrame, keys: Sequence[str], error: Column) -> DataFrame:
    named = outcomes.withColumn("error", error).where(F.col("error").isNotNull())
    return named.groupBy(*keys, "error").agg(F.count("*").alias("occurrences"))
