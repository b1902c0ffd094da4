from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from spanvec.llm import permutation_index as P

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        score = x @ x[ids == q][0]
        rows = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)[:k]
        out[q] = [(i, -s) for s, i in rows]
    return out


def test_footrule_is_the_sum_of_place_differences():
    rng = np.random.default_rng(1)
    orders = np.array([rng.permutation(12)[:5] for _ in range(40)])
    files = P.InvertedFiles(orders, 12)
    for order in orders[:10]:
        place = lambda o: np.array([list(o).index(p) if p in o else 5 for p in range(12)])
        assert files.footrule(order).tolist() == [int(np.abs(place(order) - place(o)).sum()) for o in orders]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[:400] = x[0] + 0.05 * rng.normal(size=(400, 24))
    x *= rng.uniform(0.5, 2, size=(3000, 1))
    x[10] = x[11]
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], SCHEMA).repartition(3)
    got = {}
    for r in P.nearest(rows, F.col("id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids = np.arange(3000)
    want = brute(ids, x.astype(np.float64), range(0, 3000, 20), 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, rows_ in got.items():
        assert [r for r, *_ in rows_] == list(range(1, 21))
        assert [(-s, i) for _, i, s in rows_] == sorted((-s, i) for _, i, s in rows_)
        for _, i, s in rows_:
            assert i != q and abs(s - x[i].astype(float) @ x[q].astype(float)) < 1e-9
        hits += len({i for _, i, _ in rows_} & {i for i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.95


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.5, 0.5]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [None, 1.0]),
        (140, [inf, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.0]), (160, [1.0, 2.0, 3.0]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute_rows(rows, 20, 20)
    for f in (frame, frame.selectExpr("*", "1 as id", "2 as vec", "3 as dim", "4 as near", "5 as shard", "6 as node", "7 as turn")):
        assert got_rows(P.nearest(f, F.col("id") % 20 == 0, k=20)) == want
    assert P.nearest(frame.limit(0), F.col("id") % 20 == 0).count() == 0


def brute_rows(rows, every, k):
    """Every row against every other one."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            found = sorted((-float(v @ w), j) for b, (j, w) in enumerate(good) if a != b and len(w) == len(v))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(found, 1)]
    return sorted(out)


def got_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_ties_and_rows_of_one_id(spark):
    """Equal scores at the last rank go to smaller ids; every row asks, and other rows of its id are candidates."""
    rows = [(i, [1.0, 0.0]) for i in range(1, 8)] + [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (0, [0.0, 2.0]), (9, [0.0, 1.0])]
    rows += [(40, [1.0, 0.0]), (60, [1.0, 5.0]), (60, [2.0, -1.0])] + [(100 + i, [1.0, 0.0]) for i in range(30)]
    want = brute_rows(rows, 20, 3)
    assert [r[2] for r in want if r[0] == 40] == [60, 0, 1]
    for parts in (1, 4):
        assert got_rows(P.nearest(spark.createDataFrame(rows, SCHEMA).repartition(parts), F.col("id") % 20 == 0, k=3)) == want


def test_many_copies_cost_one_entry(spark):
    """A third of the rows is one vector; entries hold as many ids as an answer needs."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 0.5] if i % 3 == 0 else [float(x) for x in rng.integers(-3, 4, 3)]) for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got_rows(P.nearest(frame, F.col("id") % 20 == 0, k=20)) == brute_rows(rows, 20, 20)
    held = P.entries(P._prepared(frame), 21).where(F.col("vec")[2] == 0.5).collect()
    assert [r.ids for r in held] == [[3 * i for i in range(21)]]


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ROWS", 70)
    monkeypatch.setattr(P, "ANSWER_ROWS", 50)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(500)]
    got = got_rows(P.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, k=5))
    want = brute_rows(rows, 20, 5)
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want])


def test_recall_of_the_query(spark):
    from spanvec.llm import queries

    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    want = brute_rows([(r.vec_id, list(r.embedding)) for r in rows], 20, 20)
    worst = {r[0]: r[3] for r in want}
    got = queries.op9_permutation_index(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == len(want)
    assert sum(r.score >= worst[r.query_id] - 1e-9 for r in got) >= 0.95 * len(want)
