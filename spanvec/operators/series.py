"""Metric and trace series: selection, latest points, alerts, retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.operators.filters import apply_filter, in_time
from spanvec.operators.rows import top_per_key


def select_series(
    df: DataFrame,
    type_col: str,
    name: str | None = None,
    at: str = "ts",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """One series, or all, within optional inclusive bounds."""
    rows = df if name is None else df.where(F.col(type_col) == name)
    return apply_filter(rows, in_time(at, start, end))


def latest_per_type(
    df: DataFrame, type_col: str, at: str, tie: str, fields: Sequence[str]
) -> DataFrame:
    """The newest row of each type; an aggregate, so no group is gathered."""
    newest = F.max_by(F.struct(at, *fields), F.struct(at, tie))
    out = df.groupBy(type_col).agg(newest.alias("newest"))
    return out.select(type_col, "newest.*")


def last_n(df: DataFrame, type_col: str, at: str, tie: str, n: int) -> DataFrame:
    """The newest ``n`` rows per type with their rank."""
    return top_per_key(df, [type_col], [F.col(at).desc(), F.col(tie).desc()], n)


def newest_snapshots(listing: DataFrame, keep: int, collection: str = "collection") -> DataFrame:
    """The newest ``keep`` names of each collection; a name ends with its stamp."""
    return top_per_key(listing, [collection], [F.col("name").desc()], keep)


def expired_snapshots(listing: DataFrame, keep: int, collection: str = "collection") -> DataFrame:
    """The names retention drops: all but the newest ``keep``.

    Written as everything without the kept ones, because ranking the whole
    listing would sort a long-lived collection in one task.
    """
    kept = newest_snapshots(listing, keep, collection).select(collection, "name")
    return listing.join(kept, [collection, "name"], "left_anti")


def alert_rules(
    latest: DataFrame, thresholds: Mapping[str, float], metric: str = "metric", value: str = "value"
) -> DataFrame:
    """A row with a message for each metric strictly over its threshold."""
    rules = latest.sparkSession.createDataFrame(
        [(m, float(t)) for m, t in thresholds.items()], "metric string, threshold double"
    )
    # One row per configured threshold.
    hit = latest.join(F.broadcast(rules), latest[metric] == rules["metric"]).where(
        F.col(value) > F.col("threshold")
    )
    message = F.concat(
        F.lit("Alert: "),
        rules["metric"],
        F.lit(" exceeded threshold ("),
        F.col(value).cast("string"),
        F.lit(" > "),
        F.col("threshold").cast("string"),
        F.lit(")"),
    )
    return hit.select(rules["metric"], F.col(value).alias("value"), "threshold", message.alias("message"))


def metric_retention(df: DataFrame, at: str, now: Column, keep: str) -> DataFrame:
    """Rows strictly newer than ``now`` minus an interval such as ``7 days``."""
    return df.where(F.col(at) > now - F.expr(f"INTERVAL '{keep}'"))
