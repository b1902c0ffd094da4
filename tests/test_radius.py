from __future__ import annotations

import numpy as np
import pytest
from conftest import plan_of

from spanvec.errors import SearchError
from spanvec.operators import radius as R
from spanvec.operators.search import QuerySet

SCHEMA = "id bigint, vector array<double>"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Rows in clusters with repeated vectors, the pivots, the stored table, the vectors by id."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(6, 8)) * 3, 50, 0) + rng.normal(size=(300, 8)) * 0.4
    x[7] = x[8]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(900, None), (901, [float("nan")] * 8), (902, [None] + [0.0] * 7)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(3)
    pivots = R.choose_pivots(docs, 5)
    path = str(tmp_path_factory.mktemp("radius") / "rows")
    R.write_by_pivot(R.with_pivots(docs, pivots), path)
    return docs, pivots, spark.read.parquet(path), x


def brute(x, radius):
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    return {(int(q), int(i)) for q, i in zip(*np.nonzero(apart <= radius), strict=True)}


@pytest.mark.parametrize("radius", [0.0, 0.9, 1.7, 100.0])
def test_all_rows_within_the_radius(stored, radius):
    docs, pivots, rows, x = stored
    asked = QuerySet.of(docs.where("id < 900"), "id")
    found = R.radius_search(rows, pivots, asked, radius).collect()
    assert len(found) == len({(r.query_id, r.id) for r in found})
    assert {(r.query_id, r.id) for r in found} == brute(x, radius)


def test_a_large_query_set_meets_the_same_rows(stored):
    docs, pivots, rows, x = stored
    asked = QuerySet.of(docs.where("id < 900"), "id", max_queries=10)
    assert not asked.small
    assert {(r.query_id, r.id) for r in R.radius_search(rows, pivots, asked, 1.3).collect()} == brute(x, 1.3)


def test_the_range_of_distances_reaches_the_scan(stored):
    docs, pivots, rows, x = stored
    asked = QuerySet.of(docs.where("id = 4"), "id")
    plan = plan_of(R.radius_search(rows, pivots, asked, 0.5))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "pivot_distance" in line]
    assert pushed and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_sides_and_bad_radius(spark, stored):
    docs, pivots, rows, _ = stored
    none = QuerySet.of(docs.where("false"), "id")
    assert R.radius_search(rows, pivots, none, 1.0).count() == 0
    asked = QuerySet.of(docs.where("id = 4"), "id")
    assert R.radius_search(rows.where("false"), pivots, asked, 1.0).count() == 0
    for bad in (-1.0, float("nan"), float("inf")):
        with pytest.raises(SearchError):
            R.radius_search(rows, pivots, asked, bad)
