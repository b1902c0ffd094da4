"""Text scoring, fusion of vector and text results, ranking."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.errors import SearchError
from spanvec.functions.text import split_terms, tokens
from spanvec.functions.vectors import similarity
from spanvec.operators.filters import FilterSpec, apply_filter, combine, predicate, score_window
from spanvec.operators.search import DEFAULT_TOP_K, QuerySet, attach_fields, check_top_k, knn
from spanvec.session import materialize

# The usual BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75

MAX_TERMS = 256


@dataclass(frozen=True)
class Ranking:
    field_name: str = "score"
    weight: float = 1.0
    sort_order: str = "desc"
    min_score: float | None = None
    max_results: int | None = None


@dataclass(frozen=True)
class SearchSpec:
    metric_type: str = "L2"
    top_k: int = DEFAULT_TOP_K
    min_score: float = 0.0
    max_score: float = 1.0
    use_hybrid: bool = False
    hybrid_weight: float = 0.5


def text_search(
    documents: DataFrame,
    query: str,
    k: int = DEFAULT_TOP_K,
    id_col: str = "id",
    text_col: str = "text",
) -> DataFrame:
    """``id, score`` of the best documents by BM25, the best one scoring 1.

    How often a term occurs is counted inside the row, so no token leaves its
    task: one small aggregate gives the collection statistics, and the scores
    are a projection with a top-k.
    """
    check_top_k(k)
    terms = split_terms(query)
    if not terms or len(terms) > MAX_TERMS:
        raise SearchError(f"a text query holds 1 to {MAX_TERMS} terms")
    split = documents.select(F.col(id_col).alias("id"), tokens(text_col).alias("t"))
    length = F.size("t")
    counts = [(length - F.size(F.array_remove("t", w))).alias(f"tf{i}") for i, w in enumerate(terms)]
    tf = split.select("id", length.alias("length"), *counts)
    held = [F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))]
    # The texts are cut once; what later steps need of them is a few counts.
    tf = materialize(tf)
    totals = tf.agg(F.count("length").alias("n"), F.avg("length").alias("mean_length"), *held)
    # One row by construction, so it may be read as constants of the scoring.
    stats = totals.first()
    score = reduce(
        lambda a, b: a + b,
        [_bm25(F.col(f"tf{i}"), stats[f"df{i}"], stats["n"], stats["mean_length"]) for i in range(len(terms))],
    )
    has_term = combine([F.col(f"tf{i}") > 0 for i in range(len(terms))], "or")
    scored = tf.where(has_term).select("id", score.alias("raw"))
    top = scored.orderBy(F.col("raw").desc(), F.col("id")).limit(k)
    # The window holds the k rows that are left.
    return top.select("id", (F.col("raw") / F.max("raw").over(Window.partitionBy(F.lit(0)))).alias("score"))


def _bm25(tf: Column, df: int, n: int, mean_length: float | None) -> Column:
    idf = F.log(F.lit(1.0) + F.lit(n - df + 0.5) / F.lit(df + 0.5))
    relative = F.col("length") / F.lit(float(mean_length or 1.0))
    return idf * tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * relative))


def fuse_results(vector_hits: DataFrame, text_hits: DataFrame, weight: float) -> DataFrame:
    """``id, score`` of both sides to one weighted score per id, best first."""
    left = vector_hits.groupBy("id").agg(F.max("score").alias("vector_score"))
    right = text_hits.groupBy("id").agg(F.sum("score").alias("text_score"))
    both = left.join(right, "id", "full_outer").select(
        "id",
        F.coalesce("vector_score", F.lit(0.0)).alias("vector_score"),
        F.coalesce("text_score", F.lit(0.0)).alias("text_score"),
    )
    combined = F.col("vector_score") * (1 - weight) + F.col("text_score") * weight
    fused = both.withColumn("combined_score", combined).withColumn("score", F.col("combined_score"))
    return sort_by_score(fused)


def sort_by_score(df: DataFrame, score: str = "combined_score") -> DataFrame:
    return df.orderBy(F.col(score).desc(), F.col("id"))


def _number(df: DataFrame, name: str) -> Column:
    """The numeric value of a field; anything else counts as 0."""
    if name not in df.columns:
        return F.lit(0.0)
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(0.0)
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def rank_weighted(df: DataFrame, rankings: Sequence[Ranking]) -> DataFrame:
    """Weighted sum of fields.

    The sum has one order, that of the first ranking. Each ranking's ``min_score`` is a
    bound on the sum, so the largest holds, and the smallest ``max_results`` counts.
    """
    first = rankings[0]
    least = max((r.min_score for r in rankings if r.min_score is not None), default=None)
    most = min((r.max_results for r in rankings if r.max_results is not None), default=None)
    total = reduce(lambda a, b: a + b, [_number(df, r.field_name) * r.weight for r in rankings])
    ranked = df.withColumn("ranking_score", total)
    if least is not None:
        ranked = ranked.where(F.col("ranking_score") >= least)
    score = F.col("ranking_score")
    ranked = ranked.orderBy(score.desc() if first.sort_order == "desc" else score.asc(), F.col("id"))
    return ranked if most is None else ranked.limit(most)


def hybrid_search(
    collection: DataFrame,
    queries: QuerySet,
    text_query: str | None = None,
    spec: SearchSpec = SearchSpec(),
    filters: Sequence[FilterSpec] = (),
    rankings: Sequence[Ranking] = (),
    id_col: str = "id",
    vector_col: str = "vector",
    text_col: str = "text",
    ranking_fields: DataFrame | None = None,
) -> DataFrame:
    """Filtered vector search, text search, fusion, ranking, score window.

    ``queries`` holds one vector. ``ranking_fields`` (``id`` and more columns)
    are joined to the fused hits, at most ``2 * top_k`` rows, before ranking.
    """
    if queries.ids is None or len(queries.ids) != 1:
        raise SearchError("a hybrid search takes one query vector")
    wanted = combine([p for p in map(predicate, filters) if p is not None])
    rows = apply_filter(collection, wanted)
    hits = knn(rows, queries, spec.top_k, spec.metric_type, id_col, vector_col)
    side = hits.select("id", similarity("distance", spec.metric_type).alias("score"))
    if spec.use_hybrid and text_query:
        found = text_search(rows, text_query, spec.top_k, id_col, text_col)
        results = fuse_results(side, found, spec.hybrid_weight)
    else:
        results = sort_by_score(side.withColumn("combined_score", F.col("score")))
    if ranking_fields is not None:
        fields = [c for c in ranking_fields.columns if c != "id"]
        results = attach_fields(results, ranking_fields, fields, 2 * spec.top_k)
    if rankings:
        results = rank_weighted(results, rankings)
    return results.where(score_window("combined_score", spec.min_score, spec.max_score))
