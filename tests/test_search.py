from __future__ import annotations

import numpy as np
import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanvec.errors import SearchError
from spanvec.operators import ivf, search
from spanvec.operators.aggregates import vector_mean
from spanvec.operators.search import QuerySet, knn, knn_multi_metric, pair_matrix
from spanvec.operators.topk import RunningTopK


def brute(ids, x, qids, q, k, metric):
    out = []
    for qid, v in zip(qids, q):
        if metric == "L2":
            key = np.sqrt(((x - v) ** 2).sum(1))
        else:
            key = -(x * v).sum(1)
            if metric == "COSINE":
                key = key / (np.sqrt((x * x).sum(1)) * np.sqrt((v * v).sum()))
        usable = np.flatnonzero(~np.isnan(key))
        order = usable[np.lexsort((ids[usable], key[usable]))][:k]
        for rank, i in enumerate(order, 1):
            out.append((int(qid), rank, int(ids[i]), round(float(key[i] if metric == "L2" else -key[i]), 9)))
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.id, round(r.distance, 9)) for r in df.collect())


def arrays(collection):
    rows = collection.orderBy("id").collect()
    return np.array([r.id for r in rows]), np.array([r.vector for r in rows])


@pytest.mark.parametrize("metric", search.METRICS)
def test_knn_equals_brute_force_with_ties(spark, collection, metric):
    ids, x = arrays(collection)
    queries = QuerySet.of(collection, "id")
    assert got(knn(collection, queries, 7, metric)) == brute(ids, x, ids, x, 7, metric)


@pytest.mark.parametrize("metric", search.METRICS)
def test_large_query_sets_give_the_same_result_block_by_block(spark, collection, metric, monkeypatch):
    queries = QuerySet.of(collection, "id")
    monkeypatch.setattr(search, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(search, "BLOCK_BYTES", 8 * 8 * 32)
    large = QuerySet.of(collection, "id", max_queries=16)
    assert not large.small and large.dim == 8
    found = knn(collection, large, 7, metric)
    assert got(found) == got(knn(collection, queries, 7, metric))
    assert "CartesianProduct" not in plan_of(found) and "BroadcastNestedLoop" not in plan_of(found)


def test_result_does_not_depend_on_partitioning(spark, collection):
    queries = QuerySet.of(collection, "id")
    expected = got(knn(collection, queries, 5))
    for n in (1, 3, 11):
        assert got(knn(collection.repartition(n), queries, 5)) == expected


def test_every_vector_is_its_own_nearest_neighbour(spark, collection):
    first = knn(collection, QuerySet.of(collection, "id"), 1)
    bad = first.where((F.round("distance", 12) != 0) | (F.col("query_id") < F.col("id")))
    assert bad.count() == 0


def test_equal_vectors_are_ranked_by_id(spark):
    rows = [(i, [0.1, 0.2, 0.3]) for i in reversed(range(10))]
    same = spark.createDataFrame(rows, "id bigint, vector array<float>")
    hits = knn(same, QuerySet.literal(spark, [[0.1, 0.2, 0.3], [1.0, 1.0, 1.0]]), 5)
    assert [(r.query_id, r.id) for r in hits.orderBy("query_id", "rank").collect()] == [
        (q, i) for q in range(2) for i in range(5)
    ]


def test_unusable_rows_are_not_ranked(spark):
    rows = [(0, None), (1, [0.0, 0.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [1.0, 1.0])]
    odd = spark.createDataFrame(rows, "id bigint, vector array<double>")
    one = QuerySet.literal(spark, [[1.0, 0.0]])
    assert [r.id for r in knn(odd, one, 5, "COSINE").collect()] == [4]
    assert [r.id for r in knn(odd, one, 5, "L2").orderBy("rank").collect()] == [1, 4]


def test_wrong_dimension_is_an_error(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0, 3.0])], "id bigint, vector array<double>")
    with pytest.raises(Exception, match="dimension mismatch"):
        knn(rows, QuerySet.literal(spark, [[1.0, 2.0]]), 1).collect()


def test_bad_parameters(spark, collection):
    one = QuerySet.literal(spark, [[0.0] * 8])
    with pytest.raises(SearchError):
        knn(collection, one, 5, "HAMMING")
    for k in (0, -1, True, 2.0):
        with pytest.raises(SearchError):
            knn(collection, one, k)


def test_empty_sides(spark, collection):
    one = QuerySet.literal(spark, [[0.0] * 8])
    assert knn(collection.limit(0), one, 5).count() == 0
    none = QuerySet.of(collection.limit(0), "id")
    assert knn(collection, none, 5).count() == 0


def test_multi_metric_is_the_union_of_single_searches(spark, collection):
    queries = QuerySet.of(vector_mean(collection, ["label"]), "label")
    together = knn_multi_metric(collection, queries, 4)
    for m in search.METRICS:
        assert got(together.where(F.col("metric") == m)) == got(knn(collection, queries, 4, m))


def test_unit_vectors_order_alike_under_l2_and_cosine(spark, collection):
    from spanvec.functions.vectors import vec_normalize

    unit = collection.withColumn("vector", vec_normalize("vector"))
    queries = QuerySet.of(vector_mean(unit, ["label"]), "label")
    l2 = {(r.query_id, r.rank): r.id for r in knn(unit, queries, 9, "L2").collect()}
    cos = {(r.query_id, r.rank): r.id for r in knn(unit, queries, 9, "COSINE").collect()}
    assert l2 == cos


def test_filter_reaches_the_scan_and_topk_is_cut_before_the_shuffle(spark, collection, tmp_path):
    path = str(tmp_path / "c")
    collection.write.partitionBy("label").parquet(path)
    stored = spark.read.parquet(path)
    one = QuerySet.literal(spark, [[0.0] * 8])
    plan = plan_of(knn(stored.where("label = 2 and category = 'A'"), one, 3))
    assert "PartitionFilters: [isnotnull(label" in plan and "EqualTo(category,A)" in plan
    assert plan.count("WindowGroupLimit") == 2 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_filtered_hits_satisfy_the_filter(spark, collection):
    rows = collection.where("category == 'B'")
    hits = knn(rows, QuerySet.of(collection, "id"), 3)
    joined = search.attach_fields(hits, collection, ["category"], 600, how="inner")
    assert joined.count() == 600 and joined.where("category <> 'B'").count() == 0


def test_attached_fields_keep_hits_without_an_entity(spark, collection):
    hits = knn(collection, QuerySet.literal(spark, [[0.0] * 8]), 20)
    some = collection.where("id < 100")
    for bound in (20, None):
        out = search.attach_fields(hits, some, ["category"], bound)
        assert out.count() == 20
        assert out.where("id >= 100 and category is not null").count() == 0
        assert out.where("id < 100 and category is null").count() == 0


def test_nested_results(spark, collection):
    hits = knn(collection, QuerySet.of(collection.where("id < 3"), "id"), 4)
    rows = search.nested(hits).collect()
    assert len(rows) == 3 and all([h["rank"] for h in r.hits] == [1, 2, 3, 4] for r in rows)


def test_pair_matrix(spark, collection):
    ids, x = arrays(collection)
    second = QuerySet.of(collection.where("id < 5"), "id")
    got_dot = {(r.i, r.j): r.value for r in pair_matrix(collection, second, "IP").collect()}
    assert len(got_dot) == 1000
    assert all(abs(got_dot[i, j] - float(x[i] @ x[j])) < 1e-9 for i, j in got_dot)
    zero = QuerySet.literal(spark, [[0.0] * 8])
    assert pair_matrix(collection, zero, "COSINE").where("value is null").count() == 200
    with pytest.raises(SearchError):
        pair_matrix(collection, QuerySet.of(collection, "id", max_queries=3), "IP")


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=40),
    st.integers(1, 6),
    st.sampled_from(search.METRICS),
    st.integers(1, 7),
)
def test_running_topk_over_batches(points, k, metric, batch):
    x = np.array(points, dtype=float)
    ids = np.arange(len(x))[::-1].copy()
    q = np.array([[1.0, 2.0], [-1.0, 0.5]])
    best = RunningTopK(metric, q, k)
    with np.errstate(divide="ignore", invalid="ignore"):
        for lo in range(0, len(x), batch):
            best.add(ids[lo : lo + batch], x[lo : lo + batch])
        expected = brute(ids, x, [0, 1], q, k, metric)
    found = sorted(
        (int(r), int(i), round(float(d), 9)) for r, i, d in zip(best.row, best.id, best.distances())
    )
    assert found == sorted((a, c, d) for a, _, c, d in expected)


# --- clustered search -------------------------------------------------------------


@pytest.fixture
def centroids(spark, collection):
    return QuerySet.of(vector_mean(collection, ["label"]), "label")


def test_assignment_is_the_nearest_centroid(spark, collection, centroids):
    ids, x = arrays(collection)
    cells = {r.id: r.centroid_id for r in ivf.assign_cells(collection, centroids).collect()}
    order = np.argsort(centroids.ids)
    c = centroids.block[order]
    expected = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
    assert [cells[int(i)] for i in ids] == expected.tolist()


def test_rows_without_a_usable_vector_keep_a_null_cell(spark, centroids):
    rows = spark.createDataFrame([(0, None), (1, [0.0] * 8)], "id bigint, vector array<double>")
    cells = {r.id: r.centroid_id for r in ivf.assign_cells(rows, centroids, "COSINE").collect()}
    assert cells == {0: None, 1: None}


def test_all_cells_equal_exact_search(spark, collection, centroids):
    queries = QuerySet.of(collection, "id")
    indexed = ivf.assign_cells(collection, centroids)
    for metric in search.METRICS:
        indexed = ivf.assign_cells(collection, centroids, metric)
        all_cells = ivf.ivf_search(indexed, centroids, queries, nprobe=4, k=5, metric=metric)
        assert got(all_cells) == got(knn(collection, queries, 5, metric))


def test_cell_search_block_by_block(spark, collection, centroids, monkeypatch):
    indexed = ivf.assign_cells(collection, centroids)
    small = ivf.ivf_search(indexed, centroids, QuerySet.of(collection, "id"), nprobe=2, k=5)
    expected = got(small)
    monkeypatch.setattr(search, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(search, "BLOCK_BYTES", 8 * 8 * 32)
    large = QuerySet.of(collection, "id", max_queries=16)
    assert got(ivf.ivf_search(indexed, centroids, large, nprobe=2, k=5)) == expected


def test_written_index_reads_only_the_probed_cells(spark, collection, centroids, tmp_path):
    path = str(tmp_path / "ivf")
    ivf.write_index(ivf.assign_cells(collection, centroids), path)
    stored = spark.read.parquet(path)
    one = QuerySet.literal(spark, [[0.0] * 8])
    found = ivf.ivf_search(stored, centroids, one, nprobe=1, k=3)
    assert "PartitionFilters: [isnotnull(centroid_id" in plan_of(found)
    assert found.count() == 3 and len(stored.inputFiles()) == 4


def test_trained_centroids_find_most_neighbours(spark, collection):
    centroids = ivf.centroid_set(ivf.train_centroids(collection, nlist=4, iterations=5))
    indexed = ivf.assign_cells(collection, centroids)
    queries = QuerySet.of(collection, "id")
    exact = {(r.query_id, r.id) for r in knn(collection, queries, 5).collect()}
    near = ivf.ivf_search(indexed, centroids, queries, nprobe=2, k=5)
    found = {(r.query_id, r.id) for r in near.collect()}
    assert len(exact & found) / len(exact) > 0.6
    sizes = ivf.describe_index(indexed, nlist=4)
    assert sizes.agg(F.sum("cell_rows")).first()[0] == 200
