"""Per-task helpers for nearest-neighbour work on Arrow batches.

Spark partitions the collection; a task sees a stream of batches and one
block of query vectors whose size the caller has checked. What leaves a task
is at most ``k`` rows per query and metric.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Largest number of cells of one score matrix held at a time.
MATRIX_CELLS = 2_000_000
PAIR_ROWS = 65_536


def matrix(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """A list column without NULL rows as a (rows, dim) matrix of DOUBLE."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if rows == 0:
        return flat.reshape(0, dim or 0)
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths[0]) if dim is None else dim
    if not (lengths == width).all():
        raise ValueError(f"vector dimension mismatch: expected {width}")
    return flat.reshape(rows, width)


def augmented(metric: str, v: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose plain products order the pairs, and which rows are usable.

    For L2 the product is ``q.x - |x|^2 / 2``, which grows as the distance
    shrinks; for COSINE rows are scaled to norm 1. Products carry rounding, so
    they only select candidates; ``exact`` gives the value that is ranked.
    """
    squares = (v * v).sum(1)
    usable = np.isfinite(squares)
    if metric == "COSINE":
        usable &= squares > 0
        norm = np.sqrt(np.where(usable, squares, 1.0))
        return np.where(usable[:, None], v / norm[:, None], 0.0), usable
    plain = v if usable.all() else np.where(usable[:, None], v, 0.0)
    if metric == "IP":
        return plain, usable
    last = np.ones(len(v)) if query else np.where(usable, squares, 0.0) / -2.0
    return np.hstack([plain, last[:, None]]), usable


def exact(metric: str, q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smaller-is-better key of the pairs of rows ``i`` of ``q`` and ``j`` of ``x``.

    Rows are gathered in short runs: many ties make many pairs.
    """
    out = np.empty(len(i))
    for lo in range(0, len(i), PAIR_ROWS):
        a, b = q[i[lo : lo + PAIR_ROWS]], x[j[lo : lo + PAIR_ROWS]]
        if metric == "L2":
            out[lo : lo + PAIR_ROWS] = np.sqrt(((a - b) ** 2).sum(1))
            continue
        key = -(a * b).sum(1)
        if metric == "COSINE":
            key = key / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        out[lo : lo + PAIR_ROWS] = key
    return out


class RunningTopK:
    """The best ``k`` rows per query over all batches of one task."""

    def __init__(self, metric: str, queries: np.ndarray, k: int):
        self.metric, self.queries, self.k = metric, queries, k
        self.asked, self.usable = augmented(metric, queries, query=True)
        self.squares = np.where(self.usable, (queries * queries).sum(1), 0.0)
        self.worst = np.full(len(queries), np.inf)
        self.row = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.key = np.empty(0)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending_pairs = 0

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Offer a batch to all queries."""
        self.offer(ids, x, np.arange(len(self.queries)))
        self.settle()

    def offer(self, ids: np.ndarray, x: np.ndarray, rows: np.ndarray) -> None:
        """Offer rows to the queries at some positions; ``settle`` ranks them."""
        with np.errstate(over="ignore", invalid="ignore"):
            held, usable = augmented(self.metric, x, query=False)
        if not usable.all():
            ids, x, held = ids[usable], x[usable], held[usable]
        rows = rows[self.usable[rows]]
        if len(ids) == 0 or len(rows) == 0:
            return
        largest = float((x * x).sum(1).max())
        step = max(1, MATRIX_CELLS // len(ids))
        for lo in range(0, len(rows), step):
            found = self._candidates(rows[lo : lo + step], ids, x, held, largest)
            self.pending.append(found)
            self.pending_pairs += len(found[0])
            if self.pending_pairs > MATRIX_CELLS:
                self.settle()

    def _candidates(
        self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, held: np.ndarray, largest: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that may be among the best, with their exact key."""
        product = self.asked[rows] @ held.T
        # What a product must reach to beat the worst row kept so far.
        worst, squares = self.worst[rows], self.squares[rows]
        need = (squares - worst * np.abs(worst)) / 2.0 if self.metric == "L2" else -worst
        if len(ids) > self.k and not np.isfinite(need).all():
            kth = np.partition(product, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            need = np.maximum(need, kth)
        # Wider than the rounding of the product, so no true neighbour is lost.
        slack = 1e-9 * (1.0 if self.metric == "COSINE" else squares.max() + largest)
        at, pos = np.nonzero(product >= (need - slack)[:, None])
        return rows[at], ids[pos], exact(self.metric, self.queries, x, rows[at], pos)

    def settle(self) -> None:
        """Rank what was offered and keep the best of it."""
        found, self.pending = self.pending, []
        if not self.pending_pairs:
            return
        self.pending_pairs = 0
        row = np.concatenate([self.row, *(f[0] for f in found)])
        ids = np.concatenate([self.id, *(f[1] for f in found)])
        key = np.concatenate([self.key, *(f[2] for f in found)])
        order = np.lexsort((ids, key, row))
        row, ids, key = row[order], ids[order], key[order]
        first = np.searchsorted(row, row, side="left")
        rank = np.arange(len(row)) - first
        best = rank < self.k
        last = rank == self.k - 1
        self.worst[row[last]] = key[last]
        self.row, self.id, self.key = row[best], ids[best], key[best]

    def distances(self) -> np.ndarray:
        return self.key if self.metric == "L2" else 0.0 - self.key
