from __future__ import annotations

import math
import re

import pytest

from spanvec.errors import SearchError
from spanvec.operators import filters, hybrid
from spanvec.operators.aggregates import list_partitions
from spanvec.operators.filters import Condition, FilterSpec
from spanvec.operators.hybrid import Ranking, SearchSpec
from spanvec.operators.rows import batch_assign, flatten_batches, gather_batches, global_row_number, top_per_key
from spanvec.operators.search import QuerySet
from pyspark.sql import functions as F

SCORES = "id bigint, score double"


def sides(spark, left, right):
    return spark.createDataFrame(left, SCORES), spark.createDataFrame(right, SCORES)


def test_fusion_of_equal_ids(spark):
    v, t = sides(spark, [(i, 0.9) for i in range(5)], [(i, 0.8) for i in range(5)])
    rows = hybrid.fuse_results(v, t, 0.7).collect()
    assert len(rows) == 5 and [r.id for r in rows] == list(range(5))
    assert all(abs(r.combined_score - (0.9 * 0.3 + 0.8 * 0.7)) < 1e-12 and r.score == r.combined_score for r in rows)


def test_fusion_of_one_sided_ids(spark):
    v, t = sides(spark, [(1, 1.0)], [(2, 0.5)])
    rows = {r.id: r for r in hybrid.fuse_results(v, t, 0.25).collect()}
    assert rows[1].text_score == 0 and rows[1].combined_score == 0.75
    assert rows[2].vector_score == 0 and rows[2].combined_score == 0.125
    assert hybrid.fuse_results(v.limit(0), t.limit(0), 0.5).count() == 0


def test_ranking(spark):
    rows = [(i, 0.9 - 0.1 * i, i % 2 == 0, "x") for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, score double, flag boolean, name string")
    down = hybrid.rank_weighted(df, [Ranking("score", 1.0)])
    assert [r.id for r in down.collect()] == [0, 1, 2, 3, 4]
    up = hybrid.rank_weighted(df, [Ranking("score", 1.0, "asc", max_results=2), Ranking("absent", 5.0)])
    assert [r.id for r in up.collect()] == [4, 3]
    mixed = hybrid.rank_weighted(df, [Ranking("flag", 10.0), Ranking("score"), Ranking("name", 100.0)])
    assert [r.id for r in mixed.collect()] == [0, 2, 4, 1, 3]
    both = hybrid.rank_weighted(df, [Ranking("score", 1.0), Ranking("absent", 1.0, min_score=0.65, max_results=1)])
    assert both.count() == 1 and both.first().score >= 0.65
    some = hybrid.rank_weighted(df, [Ranking("score", min_score=0.65)])
    assert [r.id for r in some.collect()] == [0, 1, 2]


def test_score_window(spark):
    df = spark.createDataFrame([(i, (9 - i) / 10) for i in range(5)], "id bigint, combined_score double")
    assert df.where(filters.score_window("combined_score", 0.7, 0.9)).count() == 3
    assert df.where(filters.score_window("combined_score", 1.0, 1.0)).count() == 0


TEXTS = ["the cat sat", "the Cat! the cat, THE CAT", "a dog", "", None, "cat" * 3, "the " * 50 + "dog"]


def bm25(query):
    docs = [re.findall(r"[^\W_]+", (t or "").lower()) for t in TEXTS]
    known = [d for t, d in zip(TEXTS, docs) if t is not None]
    mean = sum(map(len, known)) / len(known)
    scores = {}
    for i, d in enumerate(docs):
        s = 0.0
        for w in dict.fromkeys(query.lower().split()):
            df = sum(w in k for k in known)
            tf = d.count(w)
            s += math.log(1 + (len(known) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        if s > 0:
            scores[i] = s
    top = max(scores.values(), default=1)
    return {i: round(s / top, 9) for i, s in scores.items()}


@pytest.mark.parametrize("query", ["cat", "the dog", "Cat the cat", "absent"])
def test_text_search_equals_a_plain_computation(spark, query):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    found = {r.id: round(r.score, 9) for r in hybrid.text_search(docs, query, 10).collect()}
    assert found == bm25(query)


def test_text_search_needs_terms(spark):
    docs = spark.createDataFrame([(1, "x")], "id bigint, text string")
    for query in ("", " ,. "):
        with pytest.raises(SearchError):
            hybrid.text_search(docs, query)


def test_hybrid_search_without_text_uses_the_vector_score(spark, collection):
    one = QuerySet.of(collection.where("id = 3"), "id")
    rows = hybrid.hybrid_search(collection, one, None, SearchSpec(top_k=5)).collect()
    assert [r.id for r in rows][0] == 3 and rows[0].combined_score == 1.0 and len(rows) == 5


def test_hybrid_search_respects_filters_and_window(spark, collection):
    docs = collection.withColumn("text", F.concat(F.lit("row "), "category", F.lit(" end")))
    one = QuerySet.of(collection.where("id = 3"), "id")
    wanted = FilterSpec([Condition("category", "in", ["A", "B"]), Condition("label", ">=", 1)])
    spec = SearchSpec(top_k=30, use_hybrid=True, hybrid_weight=0.3, min_score=0.2)
    rows = hybrid.hybrid_search(docs, one, "a row", spec, [wanted], [Ranking("combined_score")]).collect()
    held = {r.id: r for r in collection.collect()}
    assert rows and all(held[r.id].category in "AB" and held[r.id].label >= 1 for r in rows)
    assert all(0.2 <= r.combined_score <= 1.0 for r in rows)
    assert [r.ranking_score for r in rows] == sorted((r.ranking_score for r in rows), reverse=True)


def test_filter_builders(spark):
    df = spark.createDataFrame([(1, 17, "test"), (2, 20, "test"), (3, 20, "x"), (4, None, None)], "id bigint, age int, category string")
    ids = lambda c: sorted(r.id for r in filters.apply_filter(df, c).collect())
    both = [Condition("age", ">", 18), Condition("category", "==", "test")]
    assert ids(filters.predicate(FilterSpec(both))) == [2]
    assert ids(filters.predicate(FilterSpec(both, "OR"))) == [1, 2, 3]
    assert ids(filters.predicate(FilterSpec([]))) == [1, 2, 3, 4]
    assert ids("age > 18 and category == 'test'") == [2]
    assert ids(filters.equals_fields(["age", "category"], category="x", other=1)) == [3]
    assert ids(filters.equals_fields(["age"])) == [1, 2, 3, 4]
    with pytest.raises(SearchError):
        filters.compare("age", "like", 1)
    with pytest.raises(SearchError):
        filters.combine([F.lit(True)], "xor")


def test_metadata_filter(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": "x"}), (2, {"a": "2"}), (3, {})], "id bigint, metadata map<string,string>")
    ids = lambda w: sorted(r.id for r in filters.apply_filter(df, filters.metadata_matches("metadata", w)).collect())
    assert ids({"a": 1}) == [1] and ids({"a": [1, 2]}) == [1, 2] and ids({"a": (1, 2), "b": "x"}) == [1]
    assert ids({}) == [1, 2, 3]


def test_row_numbers_under_skew(spark):
    # Two thirds of the keys lie close together, the rest far apart.
    skewed = spark.range(3000).select((F.when(F.col("id") < 2000, F.col("id")).otherwise(F.col("id") * 1000)).alias("k"))
    out = global_row_number(skewed.repartition(5), "k").collect()
    assert [p for _, p in sorted((r.k, r.pos) for r in out)] == list(range(1, 3001))
    assert global_row_number(skewed.limit(0), "k").count() == 0
    assert [r.pos for r in global_row_number(skewed.limit(1), "k").collect()] == [1]


def test_chunks(spark):
    df = spark.range(0, 100, 3).withColumn("x", F.col("id") * 2)
    chunks = {r.id: (r.batch, r.batch_pos) for r in batch_assign(df, "id", 10).collect()}
    assert chunks == {i * 3: (i // 10, i % 10) for i in range(34)}
    gathered = gather_batches(df, 10, "id", "id", "x")
    assert sorted(len(r["items"]) for r in gathered.collect()) == [4, 10, 10, 10]
    assert flatten_batches(gathered).select("id", "x").exceptAll(df).count() == 0


@pytest.mark.parametrize("n", [1, 5, 1500])
def test_top_per_key_under_skew(spark, n):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"))
    out = top_per_key(df, ["k"], [F.col("id").desc()], n)
    best = {}
    for r in sorted(df.collect(), key=lambda r: -r.id):
        best.setdefault(r.k, []).append(r.id)
    got = {}
    for r in out.collect():
        got.setdefault(r.k, {})[r.rank] = r.id
    assert got == {k: {i + 1: v for i, v in enumerate(ids[:n])} for k, ids in best.items()}


def test_partition_listing(spark):
    catalog = spark.createDataFrame([("p1", "first", ["t"]), ("p2", "second", [])], "name string, description string, tags array<string>")
    rows = spark.createDataFrame([("p1",)] * 3, "partition string")
    assert {r.name: r.num_entities for r in list_partitions(catalog, rows, "partition").collect()} == {"p1": 3, "p2": 0}
