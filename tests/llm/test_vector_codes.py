from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from spanvec.llm import queries
from spanvec.llm import vector_codes as V

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def nearest(points, entries):
    """Index of the nearest entry by exact squares, ties to the lower one."""
    out = []
    for p in points:
        squares = [sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries]
        out.append((squares.index(min(squares)), min(squares)))
    return out


def brute(rows, parts=16, size=64, rounds=2, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) and abs(x) * scale <= 1 << 26 for x in v)]
    dim = -(-max((len(v) for _, v in ((i, v) for i, v, _ in rows) if v is not None), default=0) // parts) * parts
    kept = [(i, v + [0] * (dim - len(v)), label) for i, v, label in kept]
    width = dim // parts
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books, codes, errors = [], [[] for _ in kept], [0] * len(kept)
    for p in range(parts):
        cut = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        entries = [v[p * width : (p + 1) * width] for _, v, _ in order[:size]]
        for _ in range(rounds):
            code = [c for c, _ in nearest(cut, entries)]
            held = [[x for x, c in zip(cut, code, strict=True) if c == e] for e in range(len(entries))]
            entries = [[sum(col) // len(h) for col in zip(*h, strict=True)] if h else e for h, e in zip(held, entries, strict=True)]
        books.append(entries)
        for n, (c, square) in enumerate(nearest(cut, entries)):
            codes[n].append(f"{c:02x}")
            errors[n] += square
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    of_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        of_label[label] = of_label.get(label, 0) + e
    return sorted(((i, "".join(c), e, of_label[label], sha) for (i, _, label), c, e in zip(kept, codes, errors, strict=True)), key=str)


def got(frame):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect()), key=str)


@pytest.mark.parametrize("n,m,d,reach", [(1, 1, 1, 5), (500, 64, 4, 300), (500, 64, 4, 3), (333, 7, 3, 2), (40, 50, 2, 4), (2000, 64, 1, 40)])
def test_trees_find_the_nearest_entries(n, m, d, reach):
    """Small ranges make ties and repeated points; the sums are those of the codes."""
    rng = np.random.default_rng(n + m)
    points, books = rng.integers(-reach, reach, size=(3, n, d)), rng.integers(-reach, reach, size=(3, m, d))
    points[1, : n // 2] = books[1, m // 2]
    tree = V.Tree.plant(points, V.LEAF)
    found = V.assign(tree, books)
    for p in range(3):
        want = [c for c, _ in nearest(tree.points[p], books[p])]
        assert found.code[p].tolist() == want
        assert (points[p][tree.order[p]] == tree.points[p]).all()
        assert found.count[p].tolist() == np.bincount(want, minlength=m).tolist()
        assert all((found.total[p, e] == tree.points[p][found.code[p] == e].sum(0)).all() for e in range(m))


def test_whole_nodes_are_assigned():
    """Points in tight groups around the entries: few of them are compared one by one."""
    rng = np.random.default_rng(5)
    books = rng.integers(-5000, 5000, size=(2, 16, 4))
    points = np.repeat(books, 400, axis=1) + rng.integers(-5, 6, size=(2, 6400, 4))
    found = V.assign(V.Tree.plant(points, V.LEAF), books)
    assert found.whole > 0.9 * 2 * 6400 and (found.count == 400).all()


def test_bounds_of_leaves_at_a_time(monkeypatch):
    rng = np.random.default_rng(6)
    points, books = rng.integers(-50, 50, size=(4, 700, 4)), rng.integers(-50, 50, size=(4, 64, 4))
    tree = V.Tree.plant(points, V.LEAF)
    want = V.assign(tree, books)
    monkeypatch.setattr(V, "PAIR_CELLS", 200)
    have = V.assign(tree, books)
    assert (have.code == want.code).all() and (have.total == want.total).all()


def test_query_against_brute_force(spark, monkeypatch):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(queries.op11_vector_codes(spark, SF)) == brute(rows)


def test_blocks_and_partitions_change_nothing(spark, rng):
    rows = [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in enumerate(rng.normal(size=(300, 32)))]
    rows += [(i + 300, rows[i % 7][1], None) for i in range(60)]
    want = brute(rows, parts=8, size=10, rounds=3)
    frame = spark.createDataFrame(rows, SCHEMA)
    for f in (frame, frame.repartition(7)):
        assert got(V.compress(f, parts=8, entries=10, rounds=3)) == want


def test_decoded_vectors_have_the_error(spark, rng):
    frame = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(rng.normal(size=(200, 32)))], SCHEMA)
    rows, books = V.train(frame)
    for r in V.decode(V.encode(rows, books), books).join(rows.select("vec_id", "x"), "vec_id").collect():
        assert sum((math.floor(256 * v) - x) ** 2 for v, x in zip(r.vector, r.x, strict=True)) == r.error


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, -0.001, 2.5], 0), (5, [1.0, -0.001, 2.5], 0), (1, None, 0), (2, [], 0), (3, [0.0] * 20, None), (4, [1.0, None], 0),
        (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (None, [3.0, 1.0], 1), (8, [1e30, 1.0], 1), (9, [-1.0] * 17, None), (5, [0.5, 7.0], 0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for f in (frame, frame.selectExpr("*", "1 as x", "2 as code", "3 as error", "4 as _label", "5 as part")):
        assert got(V.compress(f)) == brute(rows)
    assert V.compress(frame.limit(0)).count() == 0 and V.compress(frame.where("vec_id = 1")).count() == 0
    assert got(V.compress(frame.where("vec_id = 2"))) == [(2, "00" * 16, 0, 0, hashlib.sha256(b"").hexdigest())]
