"""Metric streams: rolling windows over event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.operators.aggregates import error_rate


def metric_stream(
    events: DataFrame,
    at: str,
    interval: str,
    value: str,
    is_error: Column,
    late: str | None = "10 minutes",
) -> DataFrame:
    """Count, errors, average and error rate per time window.

    On a stream the watermark closes a window ``late`` after its end; on a
    static frame it has no effect.
    """
    rows = events.withWatermark(at, late) if events.isStreaming and late else events
    windows = rows.groupBy(F.window(at, interval)).agg(
        F.count("*").alias("query_count"),
        F.count_if(is_error).alias("error_count"),
        F.avg(value).alias("avg_latency"),
        error_rate(is_error).alias("error_rate"),
    )
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "query_count",
        "error_count",
        "avg_latency",
        "error_rate",
    )
