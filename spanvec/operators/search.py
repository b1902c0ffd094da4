"""Exact nearest-neighbour search.

The collection is never crossed with the queries as rows. Each scan task
scores its batches against a block of query vectors and emits its own top
``k``; a window keeps the best ``k`` of those. The block travels to the tasks
only while it is under a checked size; a larger query set is joined to the
collection block by block on an equi-key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanvec.errors import SearchError
from spanvec.functions.vectors import as_double, similarity
from spanvec.operators.rows import top_per_key
from spanvec.operators.topk import RunningTopK, matrix

# The metric names, and the default result size.
METRICS = ("L2", "IP", "COSINE")
DEFAULT_TOP_K = 10

# A query block travels to every task while it is at most this large.
BLOCK_QUERIES = 4096
BLOCK_BYTES = 64 << 20
MIN_BLOCK_ROWS = 4096
# Hits joined back to their collection are broadcast up to this many rows.
BROADCAST_HITS = 1_000_000

HITS = "query_id bigint, id bigint, distance double"
PAIRS = "i bigint, j bigint, value double"


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise SearchError(f"metric must be one of {', '.join(METRICS)}: {metric}")
    return metric


def check_top_k(k: int) -> int:
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise SearchError("top_k must be a positive integer")
    return k


@dataclass(frozen=True)
class QuerySet:
    """Query vectors, with a block of them when it is small enough to send."""

    frame: DataFrame
    dim: int
    ids: np.ndarray | None
    block: np.ndarray | None

    @property
    def small(self) -> bool:
        return self.block is not None

    @classmethod
    def of(
        cls,
        queries: DataFrame,
        id_col: str = "query_id",
        vector_col: str = "vector",
        max_queries: int = BLOCK_QUERIES,
        max_bytes: int = BLOCK_BYTES,
    ) -> QuerySet:
        frame = queries.where(F.col(vector_col).isNotNull()).select(
            F.col(id_col).cast("bigint").alias("query_id"), as_double(vector_col).alias("vector")
        )
        head = frame.limit(max_queries + 1).toArrow()
        first = head["vector"].slice(0, 1).to_pylist()
        dim = len(first[0]) if first else 0
        if head.num_rows > max_queries or head.nbytes > max_bytes:
            return cls(frame, dim, None, None)
        return cls(frame, dim, head["query_id"].to_numpy(), matrix(head["vector"]))

    @classmethod
    def literal(cls, spark: SparkSession, vectors: Sequence[Sequence[float]]) -> QuerySet:
        """Vectors given by the caller; ``query_id`` is their position."""
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
        frame = spark.createDataFrame(rows, "query_id bigint, vector array<double>")
        if len({len(v) for _, v in rows}) != 1:
            raise SearchError("query vectors must have one dimension")
        block = np.array([v for _, v in rows])
        if len(rows) > BLOCK_QUERIES or block.nbytes > BLOCK_BYTES:
            return cls(frame, block.shape[1], None, None)
        return cls(frame, block.shape[1], np.arange(len(rows)), block)


def most_hits(queries: QuerySet, k: int) -> int | None:
    """The most hits a search can give, if its query set is a small one."""
    return len(queries.ids) * k if queries.small else None


def _slim(collection: DataFrame, id_col: str, vector_col: str, *extra: Column) -> DataFrame:
    return collection.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), *extra
    )


def keep_topk(
    hits: DataFrame,
    k: int,
    descending: bool,
    keys: Sequence[str] = ("query_id",),
    score: str = "distance",
) -> DataFrame:
    """The first ``k`` of each key by score, ties by id, with their rank."""
    best = F.col(score).desc() if descending else F.col(score).asc()
    return top_per_key(hits, keys, [best, F.col("id").asc()], k)


def knn(
    collection: DataFrame,
    queries: QuerySet,
    k: int = DEFAULT_TOP_K,
    metric: str = "L2",
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """``query_id, rank, id, distance`` of the ``k`` nearest rows per query.

    Rows whose vector is NULL or whose distance is not a number are not
    ranked. A filtered search is this on ``collection.where(...)``: the
    predicate then reaches the scan.
    """
    found = _partial(collection, queries, check_top_k(k), [check_metric(metric)], id_col, vector_col)
    ranked = keep_topk(found, k, descending=metric != "L2")
    return ranked.select("query_id", "rank", "id", "distance")


def knn_multi_metric(
    collection: DataFrame,
    queries: QuerySet,
    k: int = DEFAULT_TOP_K,
    metrics: Sequence[str] = METRICS,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """The ``k`` nearest per query under each metric, from one pass."""
    wanted = [check_metric(m) for m in metrics]
    found = _partial(collection, queries, check_top_k(k), wanted, id_col, vector_col)
    key = F.when(F.col("metric") == "L2", F.col("distance")).otherwise(-F.col("distance"))
    ranked = keep_topk(found.withColumn("key", key), k, False, ("metric", "query_id"), "key")
    return ranked.select("metric", "query_id", "rank", "id", "distance")


def knn_range(hits: DataFrame, metric: str, low: float, high: float) -> DataFrame:
    """Hits whose bigger-is-better score lies in [low, high]."""
    scored = hits.withColumn("score", similarity("distance", check_metric(metric)))
    return scored.where(F.col("score").between(low, high))


def attach_fields(
    hits: DataFrame,
    entities: DataFrame,
    fields: Sequence[str],
    hit_bound: int | None = None,
    id_col: str = "id",
    how: str = "left",
) -> DataFrame:
    """Hits with fields of the entity they point at.

    ``hit_bound`` is the most hits there can be, see ``most_hits``. Under the
    limit the hits are sent to the entities, which then need no shuffle.
    """
    wanted = entities.select(F.col(id_col).cast("bigint").alias("id"), *fields)
    if hit_bound is None or hit_bound > BROADCAST_HITS:
        return hits.join(wanted, "id", how)
    if how == "inner":
        return F.broadcast(hits).join(wanted, "id", "inner")
    # A left join cannot send its left side, so look the ids up first.
    looked = wanted.join(F.broadcast(hits.select("id").distinct()), "id", "left_semi")
    return hits.join(looked, "id", how)


def nested(hits: DataFrame) -> DataFrame:
    """One row per query holding its hits in rank order."""
    hit = F.struct("rank", "id", "distance")
    return hits.groupBy("query_id").agg(F.sort_array(F.collect_list(hit)).alias("hits"))


# --- the work inside tasks -------------------------------------------------


def _partial(
    collection: DataFrame,
    queries: QuerySet,
    k: int,
    metrics: Sequence[str],
    id_col: str,
    vector_col: str,
) -> DataFrame:
    slim = _slim(collection, id_col, vector_col)
    schema = HITS + ", metric string"
    if not queries.small:
        return block_topk(slim, queries.frame, queries.dim, k, metrics)
    qids, block = queries.ids, queries.block

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [RunningTopK(m, block, k) for m in metrics]
        for batch in batches:
            ids = batch.column("id").to_numpy()
            x = matrix(batch.column("vector"), block.shape[1]) if len(block) else None
            for b in best:
                if len(block):
                    b.add(ids, x)
        for b in best:
            yield hits_batch(qids, b)

    return slim.mapInArrow(scan, schema)


def hits_batch(qids: np.ndarray, best: RunningTopK) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "query_id": pa.array(qids[best.row], pa.int64()),
            "id": pa.array(best.id, pa.int64()),
            "distance": pa.array(best.distances(), pa.float64()),
            "metric": pa.array([best.metric] * len(best.row), pa.string()),
        }
    )


def cut_blocks(
    left: DataFrame, right: DataFrame, left_rows: int, right_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Give both sides block numbers so that equal ``cell, lb, rb`` meet once.

    The number of blocks of a cell follows from its own row count, so a cell
    that holds most rows is spread over many groups of bounded size. Frames
    without cells are one cell as a whole.
    """
    if "cell" not in left.columns:
        rows, asked = left.count(), right.count()
        blocks = max(1, -(-asked // right_rows))
        # Enough pairs of blocks to keep the cluster busy, but none tiny.
        wanted = -(-2 * left.sparkSession.sparkContext.defaultParallelism // blocks)
        fill = max(MIN_BLOCK_ROWS, -(-rows // wanted))
        nl, nr = F.lit(max(1, -(-rows // min(left_rows, fill)))), F.lit(blocks)
        left, right = left.withColumn("cell", F.lit(0)), right.withColumn("cell", F.lit(0))
        lsized, rsized = left, right
    else:
        # One row per cell of an index, of which there are few.
        lsizes = left.groupBy("cell").agg(F.ceil(F.count("*") / left_rows).alias("nl"))
        rsizes = right.groupBy("cell").agg(F.ceil(F.count("*") / right_rows).alias("nr"))
        sizes = F.broadcast(lsizes.join(rsizes, "cell"))
        lsized, rsized = left.join(sizes, "cell"), right.join(sizes, "cell")
        nl, nr = F.col("nl"), F.col("nr")
    lcut = lsized.select(
        *left.columns,
        F.pmod(F.xxhash64("id"), nl).cast("int").alias("lb"),
        F.explode(F.sequence(F.lit(0), nr.cast("int") - 1)).alias("rb"),
    )
    rcut = rsized.select(
        *right.columns,
        F.explode(F.sequence(F.lit(0), nl.cast("int") - 1)).alias("lb"),
        F.pmod(F.xxhash64("query_id"), nr).cast("int").alias("rb"),
    )
    return lcut, rcut


def block_topk(
    left: DataFrame, right: DataFrame, dim: int, k: int, metrics: Sequence[str]
) -> DataFrame:
    """Partial top-k of every pair of blocks that share a cell, if there are cells."""
    keys = ("cell", "lb", "rb")
    rows = max(1, BLOCK_BYTES // (8 * max(1, dim)))
    lcut, rcut = cut_blocks(left, right, rows, min(BLOCK_QUERIES, rows))

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asked.num_rows:
            block = matrix(asked["vector"])
            x = matrix(rows["vector"], block.shape[1])
            ids, qids = rows["id"].to_numpy(), asked["query_id"].to_numpy()
            for m in metrics:
                best = RunningTopK(m, block, k)
                # Piece by piece: the best so far spare the work on the rest.
                for lo in range(0, len(ids), MIN_BLOCK_ROWS):
                    best.add(ids[lo : lo + MIN_BLOCK_ROWS], x[lo : lo + MIN_BLOCK_ROWS])
                out.append(hits_batch(qids, best))
        else:
            out.append(hits_batch(np.empty(0, np.int64), RunningTopK(metrics[0], np.empty((0, 0)), k)))
        return pa.Table.from_batches(out)

    return (
        lcut.groupBy(*keys)
        .cogroup(rcut.groupBy(*keys))
        .applyInArrow(meet, HITS + ", metric string")
    )


def _products(metric: str, x: np.ndarray, block: np.ndarray) -> np.ndarray:
    """All products of the rows of two blocks; under COSINE a zero norm gives NaN."""
    value = x @ block.T
    if metric == "COSINE":
        norms = np.sqrt((x * x).sum(1))[:, None] * np.sqrt((block * block).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(norms > 0, value / norms, np.nan)
    return value


def pair_matrix(
    first: DataFrame,
    second: QuerySet,
    metric: str,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """The product matrix ``i, j, value`` of a set with a second, small set.

    The whole matrix is the result, so the second set has to stay under the
    block limit and the output grows with the first one only.
    """
    if check_metric(metric) == "L2":
        raise SearchError("the product matrix is defined for IP and COSINE")
    if not second.small:
        raise SearchError("the second set of a product matrix must fit one query block")
    qids, block = second.ids, second.block

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            x = matrix(batch.column("vector"), block.shape[1])
            step = max(1, 200_000 // max(1, len(block)))
            for lo in range(0, len(ids), step):
                rows = len(ids[lo : lo + step])
                value = _products(metric, x[lo : lo + step], block).reshape(-1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "i": pa.array(np.repeat(ids[lo : lo + step], len(block)), pa.int64()),
                        "j": pa.array(np.tile(qids, rows), pa.int64()),
                        # A zero norm leaves no number: NULL, never NaN.
                        "value": pa.array(value, pa.float64(), mask=np.isnan(value)),
                    }
                )

    return _slim(first, id_col, vector_col).mapInArrow(scan, PAIRS)
