"""Approximate nearest neighbours by a permutation index.

Pivots are taken from a bounded sample of the vectors, leaving out those that lie
close to one already taken; their number grows with the root of the rows. Every vector
is represented by the order of its nearest pivots and posted, with its place in that
order, in the inverted files of those pivots. A query walks the files of its own nearest
pivots and gathers the Spearman footrule distance of the orders; the vectors nearest by
that distance, as many as grow with the root of the rows, are compared exactly, together
with all that are as near as the last of them.

For the inner product as nearness, vectors get one more component that makes them
equally long and queries a zero there: the largest inner product is then the smallest
angle. Scores are inner products of the original vectors in double precision.

Equal vectors are indexed once, with the smallest ids that an answer may name, so a group
of copies costs one entry. Vectors lie in shards of bounded bytes by a hash; a query is
sent to all shards and each hands on the best of its own. A task holds one shard; its
queries stream by.

Defined results for odd input: a vector that is NULL, empty, zero or holds a NULL or
a non-finite component, or has no id, takes no part; vectors of different length do
not meet; equal scores go to the smaller id; every row that is asked with has an answer,
for which all other rows are candidates, also those with its id or its vector; only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanvec.llm.nn_descent import usable
from spanvec.llm.runs import matrix
from spanvec.session import materialize

SHARD_BYTES = 8 << 20
SHARD_ROWS = 16_384
SAMPLE_ROWS = 4096
#: Rows of one answer to the JVM.
ANSWER_ROWS = 8192
APART = 0.8

#: Pivots and compared vectors as multiples of the root of the rows, and their bounds.
PIVOTS, FEWEST_PIVOTS, MOST_PIVOTS = 10, 256, 2048
COMPARED, FEWEST_COMPARED = 10, 800


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Rows of the sample, in its order, that are not close to one taken before; then others if there are too few."""
    unit = sample / np.sqrt((sample * sample).sum(1, keepdims=True))
    taken, held = [], np.empty((min(pivots, len(unit)), unit.shape[1]))
    for i, v in enumerate(unit):
        if len(taken) < len(held) and (not taken or (held[: len(taken)] @ v).max() < APART):
            held[len(taken)] = v
            taken.append(i)
    rest = np.setdiff1d(np.arange(len(unit)), taken)
    held[len(taken) :] = unit[rest[: len(held) - len(taken)]]
    return held


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component that makes every row as long as the longest."""
    return np.concatenate([x, np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0))[:, None]], 1)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, the nearest first, equal ones by number."""
    near = x @ pivots.T
    length = min(length, len(pivots))
    if length < len(pivots):
        some = np.sort(np.argpartition(-near, length - 1, axis=1)[:, :length], 1)
    else:
        some = np.broadcast_to(np.arange(length), near.shape)
    order = np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


class InvertedFiles:
    """Postings of the rows of one shard: for each pivot, the rows near it and their places in the order."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.rows, self.length = orders.shape
        flat = orders.reshape(-1)
        by_pivot = np.argsort(flat, kind="stable")
        self.row = by_pivot // self.length
        #: A pivot at place i of an order of n counts n - i, one outside it 0.
        self.weight = (self.length - by_pivot % self.length).astype(np.int16)
        self.start = np.searchsorted(flat[by_pivot], np.arange(pivots + 1)).tolist()

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of each row's order to this one; a pivot outside an order stands behind its last place.

        With weights a and b of a pivot, |a - b| = a + b - 2 min(a, b), so only the files of
        the pivots in this order are walked.
        """
        shared = np.zeros(self.rows, np.int32)
        for place, pivot in enumerate(order.tolist()):
            at = slice(self.start[pivot], self.start[pivot + 1])
            shared[self.row[at]] += np.minimum(self.weight[at], np.int16(self.length - place))
        return self.length * (self.length + 1) - 2 * shared


def search_shard(x: np.ndarray, ids: list[list[int]], files: InvertedFiles, q: np.ndarray, q_id: int, own: int | None, order: np.ndarray, k: int, compared: int) -> list[tuple[int, float]]:
    """Ids and scores of the nearest ``k`` found in one shard; ``own`` is the entry that holds the asking row."""
    far = files.footrule(order)
    if compared < len(far):
        rows = np.flatnonzero(far <= np.partition(far, compared - 1)[compared - 1])
    else:
        rows = np.arange(len(far))
    # As the exact comparison of all rows would have it, whatever rows are compared here.
    score = np.einsum("ij,j->i", x[rows], q)
    if k < len(rows):
        # An entry more than k, as one of them may name the asking row alone.
        best = np.flatnonzero(score >= np.partition(score, max(len(rows) - k - 1, 0))[max(len(rows) - k - 1, 0)])
        rows, score = rows[best], score[best]
    found = []
    for row, value in zip(rows.tolist(), score.tolist(), strict=True):
        held = ids[row]
        if row == own and q_id in held:
            held = held.copy()
            held.remove(q_id)
        found += [(-value, i) for i in held[:k]]
    return [(i, -value) for value, i in sorted(found)[:k]]


def _prepared(vectors: DataFrame) -> DataFrame:
    good = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    wide = F.transform("embedding", lambda v: v.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", "embedding").where(good).select(F.col("vec_id").cast("bigint").alias("id"), wide.alias("vec"), F.size("embedding").alias("dim"))
    return rows.withColumn("node", F.xxhash64("vec"))


def entries(rows: DataFrame, most: int) -> DataFrame:
    """``dim, node, vec, ids``: distinct vectors with their ``most`` smallest ids; larger ids name no answer."""
    turn = F.row_number().over(Window.partitionBy("dim", "node", "vec").orderBy("id"))
    first = rows.withColumn("turn", turn).where(F.col("turn") <= most)
    return first.groupBy("dim", "node", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def fit_pivots(nodes: DataFrame, sizes: dict[int, int], seed: int) -> dict[int, tuple[float, np.ndarray]]:
    """For each vector length: the longest norm, and the pivots, from at most ``SAMPLE_ROWS`` entries of the length."""
    order = Window.partitionBy("dim").orderBy(F.xxhash64("node", F.lit(seed)), "node")
    sample = nodes.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SAMPLE_ROWS)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))
    longest = {r.dim: r.norm for r in nodes.groupBy("dim").agg(F.max(norm).alias("norm")).collect()}
    found: dict[int, list] = {}
    for r in sample.select("dim", "turn", "vec").collect():
        found.setdefault(r.dim, []).append((r.turn, r.vec))
    out = {}
    for d, f in found.items():
        many = int(min(MOST_PIVOTS, max(FEWEST_PIVOTS, np.ceil(PIVOTS * np.sqrt(sizes[d])))))
        out[d] = (longest[d], choose_pivots(lengthened(np.array([v for _, v in sorted(f)]), longest[d]), many))
    return out


def build_index(nodes: DataFrame, fitted: dict[int, tuple[float, np.ndarray]], length: int) -> DataFrame:
    """``dim, node, ids, vec, near``: each entry with its order of nearest pivots."""
    sent = nodes.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                longest, pivots = sent.value[int(dim)]
                near = nearest_pivots(lengthened(matrix(part.column(3)), longest), pivots, length)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))], ["dim", "node", "ids", "vec", "near"])

    return nodes.select("dim", "node", "ids", "vec").mapInArrow(run, "dim int, node bigint, ids array<bigint>, vec array<double>, near array<int>")


class Shard:
    """The entries of a shard, gathered from batches, and their inverted files."""

    def __init__(self, held: list[pa.RecordBatch], table: np.ndarray):
        rows = pa.Table.from_batches(held)
        self.at = {node: i for i, node in enumerate(rows.column("node").to_pylist())}
        self.ids = rows.column("ids").to_pylist()
        self.x, self.table = matrix(rows.column("vec")), table
        self.files = InvertedFiles(matrix(rows.column("near")).astype(np.int64), len(table))


def search(index: DataFrame, queries: DataFrame, fitted: dict[int, tuple[float, np.ndarray]], sizes: dict[int, int], k: int, length: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``k`` found of each of ``dim, id, node, turn, vec``."""
    pivots = index.sparkSession.sparkContext.broadcast(fitted)

    def shards(dim: int) -> int:
        return -(-sizes[dim] // max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * dim))))

    def compared(dim: int) -> int:
        """Of each shard, a fifth more than its part, as the nearest do not lie evenly."""
        whole = max(FEWEST_COMPARED, k, COMPARED * np.sqrt(sizes[dim]))
        return int(np.ceil(whole if shards(dim) == 1 else 1.2 * whole / shards(dim) + k))

    def per_dim(values: dict[int, int]) -> Column:
        table = [F.lit(x) for pair in values.items() for x in pair]
        return F.create_map(*table)[F.col("dim")] if table else F.lit(None).cast("int")

    of_shards = per_dim({d: shards(d) for d in sizes})
    many = {d: compared(d) for d in sizes}
    rows = index.withColumn("shard", F.pmod(F.xxhash64("node", F.lit(7)), of_shards).cast("int"))
    none = F.lit(None).cast("bigint")
    rows = rows.select("dim", "shard", F.lit(0).alias("side"), none.alias("id"), "node", none.alias("turn"), "vec", "ids", "near")
    asks = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), of_shards - 1)))
    asks = asks.select("dim", "shard", F.lit(1).alias("side"), "id", "node", F.col("turn").cast("bigint").alias("turn"), "vec", F.lit(None).cast("array<bigint>").alias("ids"), F.lit(None).cast("array<int>").alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        out: list[tuple] = []

        def answer() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.float64())], ["query_id", "node", "turn", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            begin = 0
            while begin < batch.num_rows:
                same = (keys[begin:] != keys[begin]).any(1)
                end = begin + int(same.argmax()) if same.any() else batch.num_rows
                part, begin, (dim, number, side) = batch.slice(begin, end - begin), end, keys[begin].tolist()
                if (dim, number) != key:
                    key, held, shard = (dim, number), [], None
                if side == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if shard is None:
                    shard = Shard(held, pivots.value[dim][1])
                x = matrix(part.column("vec"))
                orders = nearest_pivots(np.concatenate([x, np.zeros((len(x), 1))], 1), shard.table, length)
                asking = zip(x, part.column("id").to_pylist(), part.column("node").to_pylist(), part.column("turn").to_pylist(), orders, strict=True)
                for q, q_id, node, turn, order in asking:
                    found = search_shard(shard.x, shard.ids, shard.files, q, q_id, shard.at.get(node), order, k, many[dim])
                    out += [(q_id, node, turn, i, score) for i, score in found]
                    if len(out) >= ANSWER_ROWS:
                        yield answer()
        yield answer()

    met = rows.unionByName(asks).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "side")
    found = met.mapInArrow(run, "query_id bigint, node bigint, turn bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "node", "turn").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, query: Column, *, k: int = 20, length: int = 128, seed: int = 23) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``query`` (over ``id``) selects, against all rows."""
    rows = materialize(_prepared(vectors))
    nodes = materialize(entries(rows, k + 1))
    sizes = {r.dim: r.n for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    fitted = fit_pivots(nodes, sizes, seed)
    index = materialize(build_index(nodes, fitted, length))
    turn = F.row_number().over(Window.partitionBy("dim", "node", "vec", "id").orderBy("id"))
    return search(index, rows.where(query).withColumn("turn", turn), fitted, sizes, k, length)
