"""Radius search: all rows within a distance of each query, however many there are.

Every row is stored with its nearest pivot and its distance to it, in that order. By
the triangle inequality a row within ``radius`` of a query differs from it by at most
``radius`` in the distance to any pivot, and its own pivot is at most two radii farther
from the query than the query's nearest one. So a query meets a few bands of a few
pivots, on an equi-key, and the range of bands reaches the scan of the stored table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.errors import SearchError
from spanvec.functions.vectors import vec_finite, vec_l2
from spanvec.operators.ivf import assign_cells
from spanvec.operators.search import QuerySet
from spanvec.operators.topk import matrix

DEFAULT_PIVOTS = 16
#: Distances are compared with this relative slack before the exact one decides.
SLACK = 1e-6


def choose_pivots(collection: DataFrame, n: int = DEFAULT_PIVOTS, id_col: str = "id", vector_col: str = "vector") -> QuerySet:
    """``n`` vectors of the collection, the same ones in each run."""
    usable = collection.where(vec_finite(vector_col)).select(F.col(id_col).cast("bigint").alias("query_id"), vector_col)
    chosen = usable.orderBy(F.xxhash64("query_id"), "query_id").limit(n)
    return QuerySet.of(chosen, "query_id", vector_col)


def with_pivots(collection: DataFrame, pivots: QuerySet, vector_col: str = "vector") -> DataFrame:
    """The rows that have a finite vector, with ``pivot`` and ``pivot_distance``."""
    usable = collection.where(vec_finite(vector_col))
    places = QuerySet(pivots.frame, pivots.dim, np.arange(len(pivots.ids)), pivots.block)
    near = assign_cells(usable, places, "L2", vector_col).withColumnRenamed("centroid_id", "pivot")
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(pivots.block)]
    vectors = collection.sparkSession.createDataFrame(rows, "pivot int, pivot_vector array<double>")
    # As many rows as pivots, which the query set has bounded.
    near = near.join(F.broadcast(vectors), "pivot")
    return near.withColumn("pivot_distance", vec_l2(vector_col, "pivot_vector")).drop("pivot_vector")


def write_by_pivot(rows: DataFrame, path: str) -> None:
    """Files in the order of pivot and distance, so that their statistics tell what they hold."""
    order = ["pivot", "pivot_distance"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def _reach(x: np.ndarray, block: np.ndarray, radius: float) -> tuple[np.ndarray, ...]:
    """Query, pivot, least and largest pivot distance of the rows that each query may reach."""
    apart = np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in block], 1))
    slack = SLACK * (1 + apart + radius)
    query, pivot = np.nonzero(apart <= apart.min(1, keepdims=True) + 2 * radius + slack)
    at, wide = apart[query, pivot], radius + slack[query, pivot]
    return query, pivot, np.maximum(at - wide, 0), at + wide


def _in_reach(pivots: QuerySet, queries: QuerySet, radius: float) -> Column:
    _, pivot, low, high = _reach(queries.block, pivots.block, radius)
    at = F.col("pivot_distance")
    bands = [
        (F.col("pivot") == int(p)) & at.between(float(low[pivot == p].min()), float(high[pivot == p].max()))
        for p in np.unique(pivot)
    ]
    return reduce(lambda a, b: a | b, bands, F.lit(False))


def radius_search(
    rows: DataFrame, pivots: QuerySet, queries: QuerySet, radius: float, id_col: str = "id", vector_col: str = "vector"
) -> DataFrame:
    """``query_id, id, distance`` of all rows within L2 distance ``radius``, the end included.

    ``rows`` come from ``with_pivots`` under the same pivots. Rows and queries without a
    finite vector have no hits; an empty side gives no rows.
    """
    if not (math.isfinite(radius) and radius >= 0):
        raise SearchError("a radius is a finite number that is not negative")
    if queries.small and len(pivots.ids) and len(queries.ids):
        rows = rows.where(_in_reach(pivots, queries, radius))
    width, block = radius or 1.0, pivots.block

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(block):
                continue
            query, pivot, low, high = _reach(matrix(batch.column("vector"), block.shape[1]), block, radius)
            first, last = (np.floor(v / width).astype(np.int64) for v in (low, high))
            count = last - first + 1
            each = np.repeat(np.arange(len(query)), count)
            band = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            asked = batch.select(["query_id", "vector"]).take(pa.array(query[each]))
            yield pa.RecordBatch.from_arrays(
                [*asked.columns, pa.array(pivot[each], pa.int32()), pa.array(band)],
                ["query_id", "query", "pivot", "band"],
            )

    usable = queries.frame.where(vec_finite("vector"))
    asked = usable.mapInArrow(spread, "query_id bigint, query array<double>, pivot int, band bigint")
    band = F.floor(F.col("pivot_distance") / width).cast("bigint")
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), "pivot", band.alias("band"))
    met = own.join(asked, ["pivot", "band"]).select("query_id", "id", vec_l2("query", "vector").alias("distance"))
    return met.where(F.col("distance") <= radius)
