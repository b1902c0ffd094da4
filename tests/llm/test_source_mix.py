from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanvec.llm import source_mix as M

SF = "/root/testdata/sf0.01"


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by the wording: share by weight, cut, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in names} if free else {s: most * sizes[s] for s in names}
        above = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def check(rows, docs):
    sizes, taken, of = defaultdict(int), defaultdict(int), {}
    for r in docs:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    for r in rows:
        taken[r.source] += r.taken
        of[r.source] = (r.source_size, r.target)
        assert 0 <= r.taken <= 3 * r.size
    want = filled(sizes)
    for s, n in sizes.items():
        assert of[s][0] == n and of[s][1] == pytest.approx(want[s], abs=1e-6)
        assert abs(taken[s] - want[s]) <= 1


def test_targets_are_met(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = M.mix(docs)
    rows = found.collect()
    check(rows, docs.collect())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, M.mix(docs.repartition(7)).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("block_words", [1, 7, 10_000])
def test_uneven_sources_and_any_block(spark, block_words):
    rows = [(i, "w " * (i % 9), "big" if i % 3 == 0 else f"s{i % 11}") for i in range(400)] + [(1000, "a b c", None), (1001, "x", "tiny"), (1002, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    check(M.mix(docs, block_words=block_words).collect(), docs.collect())


def test_schedule_is_low_discrepancy(spark):
    """Any prefix of the mix holds its sources in proportion, up to a few slots."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed, table, total = M.place(docs)
    slots = [r.sid for r in M.schedule(table, 64, total).orderBy("slot", "sid").collect()]
    share = {r.sid: r.target / total for r in table.collect()}
    for n in (100, 500, 1500, 4000):
        for sid, s in share.items():
            assert abs(slots[:n].count(sid) - n * s) < 6
    given = M.pieces(placed, table, total, 64).groupBy("sid", "rank").agg(F.sum("given").alias("n"))
    assert given.where("n > 64").isEmpty() and given.count() == len(slots)


def test_points(spark):
    got = [r[0] for r in spark.range(5).select(M.point(F.col("id"))).collect()] + [spark.range(1).select(M.point(F.lit(3 * 2**20 + 5))).first()[0]]
    from decimal import Decimal, getcontext

    getcontext().prec = 50
    phi = (Decimal(5).sqrt() - 1) / 2
    for i, p in zip([0, 1, 2, 3, 4, 3 * 2**20 + 5], got, strict=True):
        assert abs(p - float(phi * i % 1)) < 1e-9


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    docs = odd_docs.collect()
    for frame in (odd_docs, clashing_docs):
        rows = M.mix(frame).collect()
        assert len(rows) == len(docs) and all(r.taken == 0 for r in rows if r.size == 0)
        check(rows, docs)
        again = M.mixed_documents(frame)
        assert again.columns == frame.columns and {r.doc_id for r in again.collect()} <= {r.doc_id for r in docs}
    assert M.mix(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0
    blank = M.mix(odd_docs.where("doc_id < 4")).collect()
    assert len(blank) == 3 and {(r.size, r.target, r.taken) for r in blank} == {(0, 0.0, 0)}
