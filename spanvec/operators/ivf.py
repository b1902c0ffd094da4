"""Clustered approximate search: rows live in cells, a search reads few cells.

The index is the collection plus a ``centroid_id`` column, written with one
directory per cell. Centroids are a small table whose size is checked; a hot
cell is read and written by as many tasks as its size asks for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.errors import SearchError
from spanvec.functions.vectors import as_double, run_once, vec_finite, vec_norm
from spanvec.operators.search import (
    DEFAULT_TOP_K,
    HITS,
    QuerySet,
    block_topk,
    check_metric,
    check_top_k,
    hits_batch,
    keep_topk,
)
from spanvec.operators.topk import RunningTopK, matrix

# The default index.
DEFAULT_NLIST = 1024
DEFAULT_NPROBE = 10
INDEX_TYPE = "IVF_FLAT"

# Centroids travel to every task.
MAX_CELLS = 65_536
MAX_CELL_BYTES = 128 << 20


def centroid_set(centroids: DataFrame, id_col: str = "centroid_id", vector_col: str = "vector") -> QuerySet:
    """Centroids as a block; more than the limit is an error, not a slow plan."""
    found = QuerySet.of(centroids, id_col, vector_col, max_queries=MAX_CELLS, max_bytes=MAX_CELL_BYTES)
    if not found.small:
        raise SearchError(f"an index holds at most {MAX_CELLS} cells")
    return found


def train_centroids(
    collection: DataFrame,
    nlist: int = DEFAULT_NLIST,
    metric: str = "L2",
    iterations: int = 20,
    seed: int = 42,
    vector_col: str = "vector",
) -> DataFrame:
    """``centroid_id, vector`` from k-means over the rankable vectors, read once per iteration."""
    usable = collection.where(vec_finite(vector_col))
    if check_metric(metric) == "COSINE":
        usable = usable.where(vec_norm(vector_col) > 0)
    points = usable.select(array_to_vector(as_double(vector_col)).alias("features"))
    distance = "cosine" if metric == "COSINE" else "euclidean"
    model = KMeans(k=nlist, maxIter=iterations, seed=seed, distanceMeasure=distance).fit(points)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return collection.sparkSession.createDataFrame(rows, "centroid_id int, vector array<double>")


def assign_cells(
    collection: DataFrame,
    centroids: QuerySet,
    metric: str = "L2",
    vector_col: str = "vector",
    where: Column | str | None = None,
) -> DataFrame:
    """The rows that ``where`` selects with the cell of each; a tie takes the smaller id.

    A later filter does not reach the scan: name the rows here, or store the result first.

    Rows that cannot be ranked (NULL vector, zero norm under COSINE) get a
    NULL cell and stay in the table.
    """
    collection = collection if where is None else collection.where(where)
    cids, block = centroids.ids, centroids.block
    check_metric(metric)

    def nearest(vectors: pa.Array) -> pa.Array:
        usable = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        # Here rows ask and centroids answer: the nearest one per row.
        best = RunningTopK(metric, matrix(vectors.drop_null(), block.shape[1]), 1)
        best.add(cids, block)
        cell = np.zeros(len(vectors), np.int32)
        missing = np.ones(len(vectors), bool)
        at = usable[best.row]
        cell[at], missing[at] = best.id, False
        return pa.array(cell, pa.int32(), mask=missing)

    cell_of = run_once(F.arrow_udf(nearest, "int"))
    return collection.withColumn("centroid_id", cell_of(F.col(vector_col)))


def write_index(indexed: DataFrame, path: str) -> None:
    """One directory per cell; large cells are split over tasks, small ones packed."""
    indexed.hint("rebalance", "centroid_id").write.partitionBy("centroid_id").parquet(path)


def describe_index(
    indexed: DataFrame, field: str = "vector", metric: str = "L2", nlist: int | None = None
) -> DataFrame:
    """Field, kind and metric of the index with the size of each cell."""
    sizes = indexed.groupBy("centroid_id").agg(F.count("*").alias("cell_rows"))
    described = sizes.select(
        F.lit(field).alias("field"),
        F.lit(INDEX_TYPE).alias("index_type"),
        F.lit(metric).alias("metric"),
        "centroid_id",
        "cell_rows",
    )
    return described if nlist is None else described.withColumn("nlist", F.lit(nlist))


def probe_cells(
    queries: DataFrame, centroids: QuerySet, nprobe: int = DEFAULT_NPROBE, metric: str = "L2"
) -> DataFrame:
    """``query_id, vector, cell``: the ``nprobe`` nearest cells of each query."""
    cids, block = centroids.ids, centroids.block
    check_metric(metric)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), block.shape[1])
            best = RunningTopK(metric, x, nprobe)
            best.add(cids, block)
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": batch.column("query_id").take(pa.array(best.row)),
                    "vector": batch.column("vector").take(pa.array(best.row)),
                    "cell": pa.array(best.id, pa.int32()),
                }
            )

    return queries.mapInArrow(scan, "query_id bigint, vector array<double>, cell int")


def ivf_search(
    indexed: DataFrame,
    centroids: QuerySet,
    queries: QuerySet,
    nprobe: int = DEFAULT_NPROBE,
    k: int = DEFAULT_TOP_K,
    metric: str = "L2",
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """Exact top-k among the rows of each query's ``nprobe`` nearest cells.

    With a small query set the probed cells are known before the scan, which
    then lists only their directories. With ``nprobe`` equal to the number of
    cells the result is that of ``knn``.
    """
    check_top_k(k)
    check_top_k(nprobe)
    rows = indexed.where(F.col(vector_col).isNotNull() & F.col("centroid_id").isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).alias("vector"),
        F.col("centroid_id").alias("cell"),
    )
    if not queries.small:
        probes = probe_cells(queries.frame, centroids, nprobe, metric)
        found = block_topk(rows, probes, queries.dim, k, [metric])
    else:
        found = _scan_cells(rows, centroids, queries, nprobe, k, metric)
    ranked = keep_topk(found, k, descending=metric != "L2")
    return ranked.select("query_id", "rank", "id", "distance")


def _scan_cells(
    rows: DataFrame, centroids: QuerySet, queries: QuerySet, nprobe: int, k: int, metric: str
) -> DataFrame:
    qids, block = queries.ids, queries.block
    nearest = RunningTopK(check_metric(metric), block, nprobe)
    nearest.add(centroids.ids, centroids.block)
    asking = {int(c): nearest.row[nearest.id == c] for c in np.unique(nearest.id)}

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = RunningTopK(metric, block, k)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            ids = batch.column("id").to_numpy()
            x = matrix(batch.column("vector"), block.shape[1])
            order = np.argsort(cells, kind="stable")
            found, starts = np.unique(cells[order], return_index=True)
            for cell, at in zip(found, np.split(order, starts[1:])):
                best.offer(ids[at], x[at], asking[int(cell)])
            best.settle()
        yield hits_batch(qids, best)

    return rows.where(F.col("cell").isin(list(asking))).mapInArrow(scan, HITS + ", metric string")
