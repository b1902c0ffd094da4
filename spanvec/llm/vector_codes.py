"""Compression of vectors to codes of their parts, trained by dual-tree Lloyd rounds.

Each component becomes the integer ``floor(scale * x)``; a vector is cut into ``parts``
equal consecutive parts, and each part position has a codebook of ``entries`` entries. It
starts as that part of the first vectors by id. A round gives every part to its nearest
entry by squared distance, ties to the lower index, and makes each entry the
componentwise floor of the mean of its parts; an entry without parts stays.

A round is one pass. A task holds a block of vectors and plants a balanced tree over the
block's parts of every position, each node with its box, its count and its sum; another
tree is planted over the entries. Pairs of nodes go down both trees, a level at a time. A
pair is pruned if no distance between its boxes is as small as one that a rival surely
keeps to. A node of parts that has a single entry left is assigned as a whole by its
cached sum; at the leaves the entries left are compared in integers. Only counts and
sums leave a task, and the codebooks, ``entries`` rows as long as a vector, are all that the
driver holds.

Defined results for odd input: a vector that is NULL or holds a NULL or a non-finite
component is dropped, as is one with an integer beyond 2**26, whose distances could not be
counted exactly in 64 bits; shorter vectors, empty ones too, are filled up with zeros to the
longest length, that to a multiple of ``parts``; rows without an id come after all others;
vectors of one id are ordered by their components; repeated rows are coded each; with fewer
vectors than entries the codebooks are shorter; only ``vec_id``, ``embedding``, ``label``
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanvec.session import materialize

LARGEST = 1 << 26
#: Components of a block of vectors, and of the pairs compared at the leaves at a time.
BLOCK_CELLS = 1 << 19
PAIR_CELLS = 1 << 20
LEAF = 16


@dataclass(frozen=True)
class Tree:
    """Balanced trees over the points of each of P sets, as arrays over sets and nodes of a level."""

    points: np.ndarray  # P, n, d in tree order
    order: np.ndarray  # P, n: places in the given order
    starts: list[np.ndarray]  # of each level's nodes, and the end

    @staticmethod
    def plant(points: np.ndarray, leaf: int) -> Tree:
        """Nodes are halved along their widest side until they have at most twice ``leaf`` points."""
        p, n, d = points.shape
        order = np.broadcast_to(np.arange(n), (p, n)).copy()
        points = points.copy()
        levels = max(0, int(np.log2(max(n // leaf, 1))))
        starts = [np.arange((1 << level) + 1) * n >> level for level in range(levels + 1)]
        if not d:
            return Tree(points, order, starts)
        for begin in starts[:-1]:
            node = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
            low = np.minimum.reduceat(points, begin[:-1], axis=1)
            side = (np.maximum.reduceat(points, begin[:-1], axis=1) - low).argmax(2)[:, node]
            key = np.take_along_axis(points, side[:, :, None], 2)[:, :, 0]
            key = key - np.take_along_axis(low[:, node], side[:, :, None], 2)[:, :, 0]
            moved = np.argsort((node << 28) + key, axis=1, kind="stable")
            points = np.take_along_axis(points, moved[:, :, None], 1)
            order = np.take_along_axis(order, moved, 1)
        return Tree(points, order, starts)

    def boxes(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        begin = self.starts[level][:-1]
        return np.minimum.reduceat(self.points, begin, axis=1), np.maximum.reduceat(self.points, begin, axis=1)

    def sums(self, level: int) -> np.ndarray:
        return np.add.reduceat(self.points, self.starts[level][:-1], axis=1)


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin, as many as its size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)


def _pruned(part: np.ndarray, node: np.ndarray, entry: np.ndarray, low, high, entry_low, entry_high) -> np.ndarray:
    """Which pairs, sorted by part and node, may hold a nearest entry."""
    a, b = low[part, node], high[part, node]
    c, d = entry_low[part, entry], entry_high[part, entry]
    apart = np.maximum(np.maximum(c - b, a - d), 0)
    least = (apart * apart).sum(1)
    reach = np.maximum(np.abs(d - a), np.abs(b - c))
    most = (reach * reach).sum(1)
    first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (node[1:] != node[:-1])]))
    sure = np.repeat(np.minimum.reduceat(most, first), np.diff(np.append(first, len(part))))
    return least <= sure


@dataclass
class Assignment:
    """Nearest entries of one block: whole nodes, and points of leaves, in tree order."""

    code: np.ndarray  # P, n
    count: np.ndarray  # P, entries
    total: np.ndarray  # P, entries, d
    whole: int = 0  # points assigned by a node


def assign(tree: Tree, codebooks: np.ndarray) -> Assignment:
    """Each point's nearest entry of its set's codebook, ties to the lower index."""
    p, n, d = tree.points.shape
    m = codebooks.shape[1]
    found = Assignment(np.zeros((p, n), np.int64), np.zeros((p, m), np.int64), np.zeros((p, m, d), np.int64))
    if not d:
        found.count[:, 0] = n
        return found
    entries = Tree.plant(codebooks, 1)
    part, node, entry = np.arange(p), np.zeros(p, np.int64), np.zeros(p, np.int64)
    depth, bottom = len(tree.starts) - 1, len(entries.starts) - 1
    for step in range(max(depth, bottom) + 1):
        level, entry_level = min(step, depth), min(step, bottom)
        if step:
            # Both nodes of a pair part, unless they are leaves; pairs stay sorted by part and node.
            if step <= depth:
                part, entry = np.repeat(part, 2), np.repeat(entry, 2)
                node = np.stack([2 * node, 2 * node + 1], 1).reshape(-1)
            if step <= bottom:
                part, node = np.repeat(part, 2), np.repeat(node, 2)
                entry = np.stack([2 * entry, 2 * entry + 1], 1).reshape(-1)
            order = np.lexsort((entry, node, part))
            part, node, entry = part[order], node[order], entry[order]
        kept = _pruned(part, node, entry, *tree.boxes(level), *entries.boxes(entry_level))
        part, node, entry = part[kept], node[kept], entry[kept]
        # A node of points with one entry left is assigned by its sum.
        begin, ends = entries.starts[entry_level][entry], entries.starts[entry_level][entry + 1]
        changes = np.concatenate([[True], (part[1:] != part[:-1]) | (node[1:] != node[:-1]), [True]])
        sure = changes[:-1] & changes[1:] & (ends - begin == 1)
        if sure.any():
            at, which = part[sure], entries.order[part[sure], begin[sure]]
            first = tree.starts[level][node[sure]]
            sizes = tree.starts[level][node[sure] + 1] - first
            np.add.at(found.count, (at, which), sizes)
            np.add.at(found.total, (at, which), tree.sums(level)[at, node[sure]])
            found.code[np.repeat(at, sizes), _ranges(first, sizes)] = np.repeat(which, sizes)
            found.whole += int(sizes.sum())
            part, node, entry = part[~sure], node[~sure], entry[~sure]
        if not len(part):
            return found
    _leaves(tree, entries, codebooks, found, part, node, entry)
    return found


def _leaves(tree: Tree, entries: Tree, codebooks: np.ndarray, found: Assignment, part, node, entry) -> None:
    """Compare the points of each leaf with the entries left for it, in integers."""
    sizes = np.diff(entries.starts[-1])[entry]
    which = entries.order[np.repeat(part, sizes), _ranges(entries.starts[-1][entry], sizes)]
    part, node = np.repeat(part, sizes), np.repeat(node, sizes)
    order = np.lexsort((which, node, part))
    part, node, which = part[order], node[order], which[order]
    first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (node[1:] != node[:-1])]))
    left = np.diff(np.append(first, len(part)))
    part, node = part[first], node[first]
    begin = tree.starts[-1][node]
    points = tree.starts[-1][node + 1] - begin
    # Runs of leaves with a bounded number of compared components.
    cost = np.cumsum(points * left * tree.points.shape[2])
    run = cost // PAIR_CELLS
    for at in np.split(np.arange(len(part)), np.flatnonzero(np.diff(run)) + 1):
        owner = np.repeat(at, points[at])
        place = _ranges(begin[at], points[at])
        each = left[owner]
        candidate = which[_ranges(first[owner], each)]
        who = np.repeat(np.arange(len(owner)), each)
        apart = tree.points[part[owner], place][who] - codebooks[part[owner][who], candidate]
        square = (apart * apart).sum(1)
        segment = np.cumsum(each) - each
        nearest = np.flatnonzero(square == np.repeat(np.minimum.reduceat(square, segment), each))
        # Candidates are in the order of their index: the first of the nearest is the lowest.
        chosen = nearest[np.concatenate([[True], who[nearest][1:] != who[nearest][:-1]])]
        code = candidate[chosen]
        found.code[part[owner], place] = code
        np.add.at(found.count, (part[owner], code), 1)
        np.add.at(found.total, (part[owner], code), tree.points[part[owner], place])


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, index]``: integer components."""

    entries: np.ndarray
    scale: int

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, scale: int, dim: int | None = None) -> DataFrame:
    """``vec_id, label, x``: integer components of the vectors that can be coded, filled up to ``dim``."""
    e = F.col("embedding")
    number = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * scale <= LARGEST))
    kept = vectors.select("vec_id", "label", e).where(F.coalesce(number, F.lit(False)))
    x = F.transform(e, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    if dim is not None:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size(x)))
    return kept.select("vec_id", "label", x.alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], x_at: int, dim: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in blocks of bounded size, with their components."""
    rows = max(1, BLOCK_CELLS // max(dim, 1))
    held: list[pa.RecordBatch] = []
    size = 0

    def whole() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        flat = table.column(x_at).combine_chunks().flatten().to_numpy()
        return table, flat.reshape(table.num_rows, dim)

    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            if size + part.num_rows > rows and size:
                yield whole()
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if size:
        yield whole()


def _sets(x: np.ndarray, parts: int) -> np.ndarray:
    """Parts of the rows by position."""
    return np.ascontiguousarray(x.reshape(len(x), parts, x.shape[1] // parts).transpose(1, 0, 2))


def _one_round(rows: DataFrame, books: Codebooks) -> Codebooks:
    parts, entries, width = books.entries.shape
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = total = None
        for _, x in _blocks(batches, 0, parts * width):
            found = assign(Tree.plant(_sets(x, parts), LEAF), sent.value.entries)
            count = found.count if count is None else count + found.count
            total = found.total if total is None else total + found.total
        if count is not None:
            at, which = np.nonzero(count)
            both = np.concatenate([count[at, which][:, None], total[at, which]], 1)
            yield pa.RecordBatch.from_pydict({"part": pa.array(at, pa.int32()), "entry": pa.array(which, pa.int32()), "sums": pa.array(list(both), pa.list_(pa.int64()))})

    made = rows.select("x").mapInArrow(run, "part int, entry int, sums array<bigint>")
    each = made.select("part", "entry", F.posexplode("sums").alias("place", "v")).groupBy("part", "entry", "place")
    summed = each.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    after = books.entries.copy()
    held: dict[tuple[int, int], dict[int, int]] = {}
    # At most as many rows as the codebooks have components, and a count for each entry.
    for r in summed.collect():
        held.setdefault((r.part, r.entry), {})[r.place] = int(r.v)
    for (part, entry), values in held.items():
        after[part, entry] = [values[i + 1] // values[0] for i in range(width)]
    return Codebooks(after, books.scale)


def first_codebooks(rows: DataFrame, parts: int, entries: int, dim: int, scale: int) -> Codebooks:
    """The parts of the first vectors by id."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r.x for r in first], np.int64).reshape(len(first), dim)
    return Codebooks(_sets(x, parts), scale)


def train(vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, Codebooks]:
    """The written integer vectors (``vec_id, label, x``) and the codebooks after the rounds."""
    longest = vectors.agg(F.max(F.size("embedding")).alias("n")).first().n or 0
    dim = -(-max(longest, 0) // parts) * parts
    rows = materialize(integer_vectors(vectors, scale, dim))
    books = first_codebooks(rows, parts, entries, dim, scale)
    for _ in range(rounds if books.entries.size else 0):
        books = _one_round(rows, books)
    return rows, books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of integer vectors: an index for each part as two hex digits, the squared distance."""
    parts, entries, width = books.entries.shape
    if entries > 256:
        raise ValueError("an index has two hex digits")
    sent = rows.sparkSession.sparkContext.broadcast(books)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, x in _blocks(batches, 2, parts * width):
            tree = Tree.plant(_sets(x, parts), LEAF)
            found = assign(tree, sent.value.entries)
            apart = tree.points - sent.value.entries[np.arange(parts)[:, None], found.code]
            square = (apart * apart).sum(2)
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for i in range(parts):
                code[tree.order[i], i] = found.code[i]
                error[tree.order[i]] += square[i]
            codes = [c.tobytes().hex() for c in code]
            out = pa.table({"vec_id": table.column(0), "label": table.column(1), "code": pa.array(codes, pa.string()), "error": pa.array(error, pa.int64())})
            yield from out.to_batches()

    return rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """The rows of ``code`` with the vector it stands for as column ``vector``."""
    parts, _, width = books.entries.shape
    sent = codes.sparkSession.sparkContext.broadcast(books)

    def run(held: pa.Array) -> pa.Array:
        index = np.array([list(bytes.fromhex(c)) for c in held.to_pylist()], np.int64).reshape(len(held), parts)
        x = sent.value.entries[np.arange(parts), index].reshape(len(held), parts * width)
        return pa.array(list((x + 0.5) / sent.value.scale), pa.list_(pa.float64()))

    return codes.withColumn("vector", F.arrow_udf(run, "array<double>")(F.col("code")))


def compress(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every vector that can be coded.

    The error of a label is the sum over its vectors, those without a label together; a sum beyond
    64 bits is NULL.
    """
    rows, books = train(vectors, **options)
    coded = materialize(encode(rows, books))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
