from __future__ import annotations

from collections import Counter

import numpy as np

from spanvec.llm import nn_descent as N

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    good = [(i, np.array(v, np.float64), l) for i, v, l in rows if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [v / np.sqrt(v @ v) for _, v, _ in good]
    n, parent, degree = len(good), list(range(len(good))), [0] * len(good)

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(n):
        for b in range(a):
            if good[a][2] == good[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                degree[a] += 1
                degree[b] += 1
                x, y = sorted((find(a), find(b)), key=lambda c: good[c][0])
                parent[y] = x
    out = Counter((good[a][0], degree[a], good[find(a)][0], good[a][0] == good[find(a)][0]) for a in range(n))
    ids = Counter(i for i, *_ in good)
    for i, *_ in rows:
        if ids[i] > 0:
            ids[i] -= 1
        else:
            out[(i, 0, i, True)] += 1
    return out


def test_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for label in range(3):
        for size in [1] * 150 + [2] * 30 + [5] * 8 + [80]:
            base = rng.normal(size=32)
            for _ in range(size):
                v = base + rng.normal(size=32) * 0.22 * rng.random() if size > 1 else base
                rows.append((i, [float(np.float32(x)) for x in v], label))
                i += 1
    rows += [(i + 1, rows[0][1], 0), (i + 2, [2 * x for x in rows[0][1]], 0), (i + 3, rows[0][1], 1)]
    got = Counter(tuple(r) for r in N.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
    assert got == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
        (7, [1.0, 0.0], None), (None, [1.0, 0.0], 0), (8, [1.0, 0.0], 0), (8, [1.0, 0.0], 0), (9, [5.0, 0.1], 0),
        (10, [1.0, 0.0, 0.0], 0), (11, [-1.0, 0.0], 0), (12, [1.0, 0.0], 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert Counter(tuple(r) for r in N.near_duplicates(docs).collect()) == brute(rows)
    wide = docs.selectExpr("*", "1 as node", "2 as grp", "3 as vec", "4 as u", "5 as component")
    assert Counter(tuple(r) for r in N.near_duplicates(wide).collect()) == brute(rows)
    assert N.near_duplicates(docs.limit(0)).count() == 0


def test_audit_sees_what_is_missing(spark):
    rows = spark.createDataFrame([(i, i, 1, [1.0, 0.001 * i]) for i in range(4)], "grp bigint, node bigint, weight bigint, vec array<double>")
    rows = rows.selectExpr("0L as grp", "node", "weight", "vec")
    split = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 2)], "node bigint, component bigint")
    assert N.audit(rows, split, 0.93, 10, 1) == 4 / 12
    assert N.audit(rows, spark.createDataFrame([(i, 0) for i in range(4)], "node bigint, component bigint"), 0.93, 10, 1) == 1.0


def test_groups_of_more_copies_than_a_list_holds(spark):
    """Two groups whose lists are full of their own copies, near each other; and two that are not."""
    rng = np.random.default_rng(8)
    rows = []
    for label, angle in ((0, 0.32), (1, 0.5)):
        a, b = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
        for i in range(600):
            v = (a if i < 300 else np.cos(angle) * a + np.sin(angle) * b) + rng.normal(size=64) * 0.002
            rows.append((1000 * label + i, [float(np.float32(x)) for x in v], label))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # whole windows
    try:
        got = {tuple(r) for r in N.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert got == set(brute(rows)) and {r[:3] for r in got if r[0] < 1000} == {(i, 599, 0) for i in range(600)}


def test_near_entries_beyond_a_list_stay(spark):
    edges = spark.createDataFrame([(1, v, 0.99 - v / 10_000) for v in range(2, 102)] + [(2, v, 0.7) for v in range(3, 50)], "u bigint, v bigint, cos double")
    got = N.shorten(edges, 12, 0.93).collect()
    assert {r.v for r in got if r.u == 1} == set(range(2, 102))
    assert [r.listed for r in sorted(got) if r.u == 1] == [True] * 48 + [False] * 52
    assert {r.v for r in got if r.u == 2} == set(range(3, 15))


def test_windows_grow_with_the_rows(spark):
    """Isolated pairs among 40,000 vectors of one label."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(0, 10_000, 2):
        other = x[i + 1] - (x[i + 1] @ x[i]) * x[i]
        x[i + 1] = 0.94 * x[i] + np.sqrt(1 - 0.94**2) * other / np.linalg.norm(other)
    nodes = N.materialize(spark.createDataFrame([(0, i, 1, v.tolist()) for i, v in enumerate(x)], "grp bigint, node bigint, weight bigint, vec array<double>"))
    lists = N.neighbour_graph(nodes, k=12, threshold=0.93, floor=0.6, tables=8, rounds=0, seed=11)
    met = {(r.u, r.v) for r in lists.where("cos >= 0.93").collect()}
    assert sum((i, i + 1) in met for i in range(0, 10_000, 2)) >= 0.997 * 5_000
    assert N.orders(100, 0.93, 0.995) == 1 and N.orders(10**6, 0.93, 0.995) > N.orders(10**4, 0.93, 0.995) > 8
