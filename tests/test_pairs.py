from __future__ import annotations

import math

import pytest
from conftest import plan_of

from spanvec.operators.pairs import pair_products

VECTORS = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, 2.0, 3.0])]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(VECTORS, "id bigint, vector array<double>").repartition(2)


def test_given_pairs_only(spark, rows):
    given = [(1, 2, "a"), (1, 2, "a"), (2, 1, "b"), (1, 1, "c")]
    pairs = spark.createDataFrame(given, "i bigint, j bigint, x string")
    got = sorted(tuple(r) for r in pair_products(pairs, rows, rows).collect())
    cosine = 1 / math.sqrt(50)
    expected = [(1, 1, "c", 0.0, 5.0, 1.0)] + [(1, 2, "a", math.sqrt(13), 1.0, cosine)] * 2 + [(2, 1, "b", math.sqrt(13), 1.0, cosine)]
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[3:] == pytest.approx(e[3:])


def test_pairs_without_a_value_stay(spark, rows):
    given = [(1, 99), (None, 1), (1, None), (1, 4), (1, 5), (1, 3)]
    pairs = spark.createDataFrame(given, "i bigint, j bigint")
    got = {(r.i, r.j): (r.ip, r.cosine) for r in pair_products(pairs, rows, rows, ["IP", "COSINE"]).collect()}
    assert got == {**dict.fromkeys(given, (None, None)), (1, 3): (0.0, None)}


def test_no_other_pairs_are_made(spark, rows):
    pairs = spark.createDataFrame([(1, 2)], "i bigint, j bigint")
    plan = plan_of(pair_products(pairs, rows, rows))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert pair_products(pairs.where("false"), rows, rows).count() == 0
