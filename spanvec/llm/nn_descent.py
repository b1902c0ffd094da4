"""Near-duplicate embeddings by NN-descent.

Vectors of one label are nodes; equal vectors are one node with a weight. Each
node keeps a list of its nearest neighbours found so far. The first lists come from
windows over several sorted orders (sign bits of random projections, read as a number);
how many follows from the rows of the label and the miss rate allowed. Then the lists
are refined: what a node's neighbours hold is compared with the node, until little
changes. A node whose whole list lies above the threshold is saturated and gets a
list of twice the length; near entries beyond it are not followed, but stay as links.
Entries below ``floor`` lead to no near duplicate and are not followed.

Links give the components. A near pair gets lost only if both ends had no room for it,
so the nodes with ``k`` near entries are searched again for entries outside their own
component, which joins components until a search finds no more. The number of links of
each vector is
then counted exactly among all vectors of its component, block by block, so no list
length limits it. An audit compares nodes with all vectors of their label, more of them
until it has seen ``audit_links`` links of nodes with few and of nodes with many links,
or ``most_audited`` nodes. While either kind is not found to ``recall``, the search goes
on with twice as many new projections; if it never is, an error says so.

Defined results for odd input: a vector that is NULL, empty, zero or holds a NULL
or a non-finite component, or has no label or no id, has no links and is its own
component; vectors of different length do not compare; repeated rows and equal
vectors are linked vectors of their own; only ``vec_id``, ``embedding`` and
``label`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanvec.llm.graph import components
from spanvec.llm.runs import matrix, runs
from spanvec.session import discard, materialize

#: Bits of an order, more than the rows of any label tell apart.
BITS = 40
WINDOW = 256
#: Rows of a block of a large component, and neighbours of a node in one task.
BLOCK = 1024
#: Nodes of a label that one task of an audit compares.
AUDITED_ROWS = 8192
_EDGE = "u bigint, v bigint, cos double"


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.array(v.as_py(), np.float64) for v in batch.column(3)]
        scaled = [v / np.abs(v).max() for v in vectors]
        unit = [v / np.sqrt(v @ v) for v in scaled]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(unit, pa.list_(pa.float64()))], ["grp", "node", "weight", "vec"])


def nodes_of(rows: DataFrame) -> DataFrame:
    """``grp, node, weight, vec``: distinct unit vectors of ``grp, node, embedding``."""
    distinct = rows.groupBy("grp", "node").agg(F.count("*").alias("weight"), F.first("embedding").alias("vec"))
    return distinct.mapInArrow(_unit, "grp bigint, node bigint, weight bigint, vec array<double>")


def _best(cos: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest entries of each row that reach ``floor``."""
    if cos.shape[1] > k:
        chosen = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    else:
        chosen = np.broadcast_to(np.arange(cos.shape[1]), cos.shape)
    row = np.repeat(np.arange(len(cos)), chosen.shape[1])
    column = chosen.reshape(-1)
    good = cos[row, column] >= floor
    return row[good], column[good]


def _edges(u: np.ndarray, v: np.ndarray, cos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "cos": pa.array(cos, pa.float64())})


def orders(rows: int, threshold: float, recall: float) -> int:
    """Sorted orders after which a pair at the threshold has met in a window with half the misses allowed.

    Nodes that agree in the first ``depth`` bits are half a step of the windows, so they meet;
    two nodes agree in a bit with the chance that no random plane parts them.
    """
    return _orders_at(max(0, math.ceil(math.log2(max(rows, 1) * 2 / WINDOW))), threshold, recall)


def _orders_at(depth: int, threshold: float, recall: float) -> int:
    meet = (1 - math.acos(max(-1.0, min(threshold, 1.0))) / math.pi) ** depth
    return 1 if meet >= 1 else math.ceil(math.log((1 - recall) / 2) / math.log1p(-meet))


def first_lists(nodes: DataFrame, k: int, threshold: float, floor: float, tables: int, recall: float, seed: int) -> DataFrame:
    """Neighbours within windows of sorted orders, ``tables`` at least, outside the node's own component."""
    by_depth = F.array(*[F.lit(max(tables, _orders_at(depth, threshold, recall))) for depth in range(BITS + 1)])
    depth = F.ceil(F.log2(F.col("n") * 2 / WINDOW)).cast("int")
    depth = F.least(F.greatest(depth, F.lit(0)), F.lit(BITS))
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n")).select("grp", by_depth[depth].alias("orders"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                x = matrix(part.column(2))
                wanted = part.column(4).to_numpy()
                for t in range(wanted.max()):
                    planes = np.random.default_rng((seed, int(size), t)).normal(size=(int(size), BITS + 1))
                    here = np.flatnonzero(wanted > t)
                    seen = x[here] @ planes
                    code = (seen[:, :BITS] > 0) @ (1 << np.arange(BITS)[::-1])
                    rows = part.take(pa.array(here))
                    columns = [pa.array(np.full(len(here), t), pa.int32()), rows.column(0), pa.array(code, pa.int64()), pa.array(seen[:, BITS]), rows.column(1), rows.column(3), rows.column(2)]
                    yield pa.RecordBatch.from_arrays(columns, ["t", "grp", "code", "at", "node", "component", "vec"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def search(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for run in runs(iter(rows.combine_chunks().to_batches()), 2):
                if run.num_rows > 1:
                    x, ids, component = matrix(run.column(6)), run.column(4).to_numpy(), run.column(5).to_numpy()
                    cos = x @ x.T
                    cos[component[:, None] == component] = -2
                    row, column = _best(cos, k, floor)
                    yield _edges(ids[row], ids[column], cos[row, column])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= 2 * WINDOW:
                yield from search(held.slice(0, 2 * WINDOW))
                held = held.slice(WINDOW)
        if held is not None:
            yield from search(held)

    placed = nodes.join(sizes, "grp").select("grp", "node", "vec", "component", "orders").mapInArrow(place, "t int, grp bigint, code bigint, at double, node bigint, component bigint, vec array<double>")
    order = ["t", "grp", "code", "at", "node"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, _EDGE)


def shorten(edges: DataFrame, k: int, threshold: float) -> DataFrame:
    """``u, v, cos, listed``: the nearest ``k`` neighbours of each node; ``4 * k`` of those whose first ``k``, ``2 * k`` all are near.

    Near entries beyond the list are kept, not listed.
    """
    order = Window.partitionBy("u").orderBy(F.desc("cos"), "v")
    ranked = edges.select("u", "v", "cos").dropDuplicates(["u", "v"]).withColumn("rank", F.row_number().over(order))
    whole = Window.partitionBy("u")
    near = F.sum((F.col("cos") >= threshold).cast("int")).over(whole)
    length = F.when(near >= 2 * k, 4 * k).when(near >= k, 2 * k).otherwise(k)
    ranked = ranked.withColumn("listed", F.col("rank") <= length)
    return ranked.where(F.col("listed") | (F.col("cos") >= threshold)).select("u", "v", "cos", "listed")


def refine(nodes: DataFrame, lists: DataFrame, k: int, own: DataFrame | None = None) -> DataFrame:
    """Neighbours of neighbours: for each node v, its neighbours either way against its list.

    The list of v is short; the nodes that hold v may be many and are split. ``own`` are
    entries inside the components, which are followed as well.
    """
    least = lists.groupBy("u").agg(F.min("cos").alias("least"), F.count("*").alias("n"))
    lists = lists.select("u", "v") if own is None else lists.select("u", "v").unionByName(own.select("u", "v")).distinct()
    both = lists.select("u", "v").unionByName(lists.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    holders = both.groupBy("v").agg(F.count("*").alias("n")).select("v", F.ceil(F.col("n") / BLOCK).alias("parts"))
    of = nodes.select("node", "component", "vec")
    least = least.select(F.col("u").alias("_u"), F.when(F.col("n") >= k, F.col("least")).otherwise(-2.0).alias("least"))
    left = both.join(holders, "v").join(of, both["u"] == of["node"]).join(least, both["u"] == F.col("_u"), "left")
    part = F.pmod(F.xxhash64("u"), F.col("parts"))
    left = left.select("v", part.alias("part"), F.lit(0).alias("side"), F.col("u").alias("id"), F.coalesce("least", F.lit(-2.0)).alias("least"), "component", "vec")
    right = lists.select(F.col("u").alias("v"), F.col("v").alias("w")).join(holders, "v").join(of, F.col("w") == of["node"])
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    right = right.select("v", "part", F.lit(1).alias("side"), F.col("w").alias("id"), F.lit(-2.0).alias("least"), "component", "vec")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, 2):
            side, ids = run.column(2).to_numpy(), run.column(3).to_numpy()
            x, least, component = matrix(run.column(6)), run.column(4).to_numpy(), run.column(5).to_numpy()
            a, b = side == 0, side == 1
            if not a.any() or not b.any():
                continue
            cos = x[a] @ x[b].T
            cos[(component[a][:, None] == component[b][None, :]) | (cos <= least[a][:, None])] = -2
            row, column = _best(cos, k, -1.5)
            if len(row):
                yield _edges(ids[a][row], ids[b][column], cos[row, column])

    return left.unionByName(right).repartition("v", "part").sortWithinPartitions("v", "part", "side").mapInArrow(compare, _EDGE)


def neighbour_graph(
    nodes: DataFrame, *, k: int, threshold: float, floor: float, tables: int, rounds: int, seed: int, recall: float = 0.995, known: DataFrame | None = None, own: DataFrame | None = None
) -> DataFrame:
    """``u, v, cos, listed``: each node's list after refinement, and near entries beyond it.

    With a column ``component``, entries outside the node's component; ``own`` are lists inside.
    """
    if "component" not in nodes.columns:
        nodes = nodes.withColumn("component", F.col("node"))
    edges = first_lists(nodes, k, threshold, floor, tables, recall, seed)
    lists = materialize(shorten(edges if known is None else edges.unionByName(known.select("u", "v", "cos")), k, threshold))
    size = (F.count_if("listed"), F.sum(F.when(F.col("listed"), F.col("cos"))))
    had = lists.agg(*size).first()
    for _ in range(rounds if had[0] else 0):
        found = refine(nodes, lists.where("listed"), k, own).where(F.col("cos") >= floor)
        turned = found.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos")
        before, lists = lists, materialize(shorten(lists.select("u", "v", "cos").unionByName(found).unionByName(turned), k, threshold))
        discard(before)
        has = lists.agg(*size).first()
        if has[0] - had[0] <= 1e-3 * has[0] and abs(has[1] - had[1]) <= 1e-4 * abs(has[1]):
            break
        had = has
    return lists


def _links(lists: DataFrame, threshold: float) -> DataFrame:
    return lists.where(F.col("cos") >= threshold).select(F.col("u").alias("x"), F.col("v").alias("y"))


def _named(links: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """``node, component`` of linked nodes, ``named`` being linked already."""
    if named is not None:
        links = links.unionByName(named.select(F.col("node").alias("x"), F.col("component").alias("y")))
    return materialize(components(links).select(F.col("id").alias("node"), "component"))


def joined_components(nodes: DataFrame, lists: DataFrame, named: DataFrame | None, *, k: int, threshold: float, seed: int, **options) -> DataFrame:
    """``node, component``: components of the near entries, joined until saturated nodes are near none of another one."""
    links = _links(lists, threshold)
    named = _named(links, named)
    saturated = links.groupBy("x").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    saturated = materialize(nodes.join(saturated, nodes["node"] == saturated["x"], "left_semi"))
    here = None
    for turn in count(1):
        if here is not None:
            discard(here)
        here = saturated.join(named, "node")
        several = here.groupBy("grp").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
        here = materialize(here.join(several, "grp", "left_semi"))
        if here.isEmpty():
            break
        across = neighbour_graph(here, k=k, threshold=threshold, seed=seed + 1000 * turn, own=lists.where("listed"), **options)
        more = _links(across, threshold)
        if more.isEmpty():
            discard(across)
            break
        before, named = named, _named(more, named)
        discard(across, before)
    discard(saturated, here)
    return named


def audit_counts(nodes: DataFrame, named: DataFrame, threshold: float, rows: int, seed: int, many: int) -> dict[bool, tuple[int, int]]:
    """Links of ``rows`` nodes, found by comparing them with all, and those within a component: of nodes with ``many`` links, and of others."""
    all_named = nodes.join(named, "node", "left").select("grp", "node", F.coalesce("component", "node").alias("component"), "vec")
    chosen = materialize(nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(rows).select("node"))
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n")).select("grp", F.ceil(F.col("n") / AUDITED_ROWS).alias("parts"))
    dealt = all_named.join(sizes, "grp")
    asked = dealt.join(chosen, "node", "left_semi")
    dealt = dealt.join(asked.select("grp").distinct(), "grp", "left_semi")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    left = asked.select("grp", every.alias("part"), F.lit(0).alias("side"), "node", "component", "vec")
    right = dealt.select("grp", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("parts")).alias("part"), F.lit(1).alias("side"), "node", "component", "vec")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, 2):
            side, node, component = (run.column(i).to_numpy() for i in (2, 3, 4))
            x, b = matrix(run.column(5)), side == 1
            asked = np.flatnonzero(side == 0)
            for i in range(0, len(asked), BLOCK // 2):
                a = asked[i : i + BLOCK // 2]
                near = (x[a] @ x[b].T >= threshold) & (node[a][:, None] != node[b])
                total, inside = near.sum(1), (near & (component[a][:, None] == component[b])).sum(1)
                yield pa.RecordBatch.from_pydict({"node": pa.array(node[a], pa.int64()), "total": pa.array(total, pa.int64()), "inside": pa.array(inside, pa.int64())})

    blocks = left.unionByName(right).repartition("grp", "part").sortWithinPartitions("grp", "part", "side")
    each = blocks.mapInArrow(compare, "node bigint, total bigint, inside bigint").groupBy("node").agg(F.sum("total").alias("total"), F.sum("inside").alias("inside"))
    seen = {r.large: (r.total, r.inside) for r in each.groupBy((F.col("total") >= many).alias("large")).agg(F.sum("total").alias("total"), F.sum("inside").alias("inside")).collect()}
    discard(chosen)
    return {large: seen.get(large, (0, 0)) for large in (False, True)}


def audit(nodes: DataFrame, named: DataFrame, threshold: float, rows: int, seed: int) -> float:
    """Share of the links of ``rows`` nodes, found by comparing them with all, that lie within a component."""
    total, inside = audit_counts(nodes, named, threshold, rows, seed, 1)[True]
    return 1.0 if not total else inside / total


def count_links(nodes: DataFrame, named: DataFrame, threshold: float) -> DataFrame:
    """``node, links``: the weight of the other nodes of its component that reach the threshold, counted exactly."""
    sizes = named.groupBy("component").agg(F.count("*").alias("n"))
    rows = nodes.join(named, "node").join(sizes, "component")
    rows = rows.withColumn("parts", F.ceil(F.col("n") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    left = rows.withColumn("other", other).select("component", F.col("own").alias("a"), F.col("other").alias("b"), F.lit(0).alias("side"), "node", "weight", "vec")
    right = rows.withColumn("other", other).select("component", F.col("other").alias("a"), F.col("own").alias("b"), F.lit(1).alias("side"), "node", "weight", "vec")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, 3):
            side, ids = run.column(3).to_numpy(), run.column(4).to_numpy()
            weight, x = run.column(5).to_numpy(), matrix(run.column(6))
            a, b = side == 0, side == 1
            if a.any() and b.any():
                near = (x[a] @ x[b].T >= threshold) & (ids[a][:, None] != ids[b][None, :])
                yield pa.RecordBatch.from_pydict({"node": pa.array(ids[a], pa.int64()), "links": pa.array(near @ weight[b], pa.int64())})

    blocks = left.unionByName(right).repartition("component", "a", "b").sortWithinPartitions("component", "a", "b", "side")
    return blocks.mapInArrow(count, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(
    vectors: DataFrame, *, threshold: float = 0.93, k: int = 12, floor: float = 0.6, tables: int = 8, rounds: int = 6, recall: float = 0.995, audit_rows: int = 512, audit_links: int = 200, most_audited: int = 8192, tries: int = 4, seed: int = 11
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vec_id, embedding, label``."""
    good = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "embedding", "label").withColumn("good", good)
    rows = rows.withColumn("grp", F.when(F.col("good"), F.xxhash64("label", F.size("embedding"))))
    rows = rows.withColumn("node", F.when(F.col("good"), F.xxhash64("grp", "embedding")))
    nodes = materialize(nodes_of(rows.where("good")))
    lists = named = None
    size = nodes.count()
    for attempt in range(tries):
        options = {"k": k, "threshold": threshold, "floor": floor, "tables": tables << attempt, "rounds": rounds, "recall": 1 - (1 - recall) / 2**attempt, "seed": seed + attempt}
        known, lists = lists, neighbour_graph(nodes, known=lists, **options)
        named = joined_components(nodes, lists, named, **options)
        if known is not None:
            discard(known)
        audited = audit_rows
        while True:
            seen = audit_counts(nodes, named, threshold, audited, seed + attempt, k)
            if audited >= most_audited or audited >= size or all(total >= audit_links for total, _ in seen.values()):
                break
            audited = min(4 * audited, most_audited)
        if all(inside >= recall * total for total, inside in seen.values()):
            break
    else:
        raise RuntimeError(f"near duplicates not found to {recall}: (links, found) of {audited} nodes, by whether they have {k} links: {seen}")
    links = count_links(nodes, named, threshold)
    table = nodes.select("node", "weight").join(named, "node", "left").join(links, "node", "left")
    table = materialize(table.select("node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "node").alias("component")))
    discard(nodes, lists, named)
    found = rows.select("vec_id", "node").join(table, "node", "left")
    first = found.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("first"))
    out = found.join(first, "component", "left").withColumn("component_id", F.coalesce("first", "vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
