"""Vector, text and hybrid search over the given tables.

Query vectors are means over groups of the whole table: one per label, one
per document source, or one in all. Their number is that of the groups.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanvec.functions.vectors import similarity, vec_one_hot
from spanvec.operators import filters, hybrid, ivf, radius, search, text_index
from spanvec.operators.aggregates import vector_mean, vector_mean_parts
from spanvec.operators.collections import concat_modalities
from spanvec.operators.search import QuerySet, knn
from spanvec.plans.base import collection, hits, query, r6, table
from spanvec.session import shared_dir

TEXT_QUERY = "the inea of thread"


def with_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return collection(spark, sf).join(docs, F.col("id") == F.col("doc_id"))


def label_queries(spark: SparkSession, sf: str) -> QuerySet:
    return QuerySet.of(vector_mean(collection(spark, sf), ["label"]), "label")


def source_number():
    return F.expr("substring(source, 4)").cast("bigint")


def source_queries(spark: SparkSession, sf: str) -> QuerySet:
    rows = with_documents(spark, sf).withColumn("query_id", source_number())
    return QuerySet.of(vector_mean(rows, ["query_id"]))


def one_query(spark: SparkSession, sf: str) -> QuerySet:
    mean = vector_mean(collection(spark, sf).withColumn("query_id", F.lit(0)), ["query_id"])
    return QuerySet.of(mean)


# --- SQL pieces ---------------------------------------------------------------

E = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


def means(key: str, source: str, name: str = "q") -> str:
    return f"""
    {name}_x AS (SELECT {key} AS query_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {source}),
    {name}_m AS (SELECT query_id, pos, avg(x) AS m FROM {name}_x GROUP BY query_id, pos),
    {name} AS (SELECT CAST(query_id AS BIGINT) AS query_id, list(m ORDER BY pos) AS v FROM {name}_m GROUP BY query_id)"""


DISTANCE = {
    "L2": "list_distance(e.v, q.v)",
    "IP": "list_inner_product(e.v, q.v)",
    "COSINE": "list_cosine_similarity(e.v, q.v)",
}
DOCS = "ed AS (SELECT e.*, d.* FROM e JOIN documents d ON e.id = d.doc_id)"
SOURCE_KEY = "CAST(substring(source, 4) AS BIGINT)"


def topk(metric: str, k: int, rows: str = "e", condition: str = "true") -> str:
    """Top-k of ``rows`` (aliased e) for every row of q."""
    d = DISTANCE[metric]
    way = "ASC" if metric == "L2" else "DESC"
    return f"""(SELECT * FROM (SELECT q.query_id, e.id, {d} AS distance,
      row_number() OVER (PARTITION BY q.query_id ORDER BY {d} {way}, e.id) AS rank
      FROM {rows} e, q WHERE {condition}) WHERE rank <= {k})"""


def hit_sql(metric: str, k: int, with_q: str, rows: str = "e", condition: str = "true") -> str:
    return f"""WITH {with_q} SELECT query_id, CAST(rank AS INT) AS rank, id,
      round(distance, 6) + 0.0 AS distance FROM {topk(metric, k, rows, condition)}"""


LABEL_Q = E + "," + means("label", "e")
SOURCE_Q = E + "," + DOCS + "," + means(SOURCE_KEY, "ed")
ONE_Q = E + "," + means("0", "e")


# --- exact search ---------------------------------------------------------------


@query("knn_l2", hit_sql("L2", 5, LABEL_Q))
def knn_l2(spark, sf):
    return hits(knn(collection(spark, sf), label_queries(spark, sf), 5, "L2"))


@query("knn_ip", hit_sql("IP", 5, LABEL_Q))
def knn_ip(spark, sf):
    return hits(knn(collection(spark, sf), label_queries(spark, sf), 5, "IP"))


@query("knn_cosine", hit_sql("COSINE", 5, LABEL_Q))
def knn_cosine(spark, sf):
    return hits(knn(collection(spark, sf), label_queries(spark, sf), 5, "COSINE"))


@query(
    "topk_per_query",
    f"WITH {LABEL_Q} SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) + 0.0 AS distance"
    f" FROM {topk('IP', 20)}",
)
def topk_per_query(spark, sf):
    # All products with the label means, ranked per mean.
    products = search.pair_matrix(collection(spark, sf), label_queries(spark, sf), "IP")
    pairs = products.select(F.col("j").alias("query_id"), F.col("i").alias("id"), F.col("value").alias("distance"))
    return hits(search.keep_topk(pairs, 20, descending=True))


BATCH_KEY = f"label * 1000 + {SOURCE_KEY}"


def batch_queries(spark, sf) -> QuerySet:
    rows = with_documents(spark, sf).withColumn("query_id", F.col("label") * 1000 + source_number())
    return QuerySet.of(vector_mean(rows, ["query_id"]))


@query("knn_batch", hit_sql("L2", 10, E + "," + DOCS + "," + means(BATCH_KEY, "ed")))
def knn_batch(spark, sf):
    return hits(knn(collection(spark, sf), batch_queries(spark, sf), 10, "L2"))


@query(
    "knn_filtered",
    f"""WITH {LABEL_Q}, {DOCS} SELECT query_id, CAST(rank AS INT) AS rank, t.id,
    round(distance, 6) + 0.0 AS distance, d.lang, d.n_chars
    FROM {topk("L2", 5, "ed", "e.lang = 'en' AND e.n_chars > 500")} t
    JOIN documents d ON d.doc_id = t.id""",
)
def knn_filtered(spark, sf):
    queries = label_queries(spark, sf)
    rows = with_documents(spark, sf).where("lang = 'en' and n_chars > 500")
    found = hits(knn(rows, queries, 5, "L2"))
    docs = table(spark, sf, "documents")
    bound = search.most_hits(queries, 5)
    return search.attach_fields(found, docs, ["lang", "n_chars"], bound, "doc_id", "inner")


@query("knn_in_partitions", hit_sql("L2", 5, LABEL_Q, condition="e.label IN (0, 1)"))
def knn_in_partitions(spark, sf):
    rows = collection(spark, sf).where(filters.in_partitions("label", [0, 1]))
    return hits(knn(rows, label_queries(spark, sf), 5, "L2"))


@query(
    "knn_range",
    f"""WITH {LABEL_Q} SELECT query_id, CAST(rank AS INT) AS rank, id,
    round(distance, 6) + 0.0 AS distance, round(1.0 / (1.0 + distance), 6) + 0.0 AS score
    FROM {topk("L2", 50)} WHERE 1.0 / (1.0 + distance) BETWEEN 0.505 AND 1.0""",
)
def knn_range(spark, sf):
    found = knn(collection(spark, sf), label_queries(spark, sf), 50, "L2")
    kept = search.knn_range(found, "L2", 0.505, 1.0)
    return kept.select(
        "query_id", "rank", "id", r6("distance").alias("distance"), r6("score").alias("score")
    )


@query(
    "radius_search",
    f"""WITH {LABEL_Q} SELECT q.query_id, e.id, round({DISTANCE["L2"]}, 6) + 0.0 AS distance
    FROM e, q WHERE {DISTANCE["L2"]} <= 0.98""",
)
def radius_search(spark, sf):
    rows = collection(spark, sf)
    pivots = radius.choose_pivots(rows)
    path = f"{shared_dir(spark)}/radius-{uuid.uuid4().hex}"
    radius.write_by_pivot(radius.with_pivots(rows.select("id", "vector"), pivots), path)
    found = radius.radius_search(spark.read.parquet(path), pivots, label_queries(spark, sf), 0.98)
    return found.select("query_id", "id", r6("distance").alias("distance"))


@query(
    "knn_multi_metric",
    f"WITH {LABEL_Q} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, query_id, CAST(rank AS INT) AS rank, id,
        round(distance, 6) + 0.0 AS distance FROM {topk(m, 5)}"""
        for m in search.METRICS
    ),
)
def knn_multi_metric(spark, sf):
    found = search.knn_multi_metric(collection(spark, sf), label_queries(spark, sf), 5)
    return hits(found, "metric")


@query(
    "multimodal_search",
    f"""WITH {E}, c AS (SELECT id, list_concat(v, list_transform(range(0, 10),
      lambda i: CASE WHEN i = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS v, label FROM e),
    {means("label", "c")},
    cd AS (SELECT c.*, d.lang FROM c JOIN documents d ON c.id = d.doc_id)
    SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) + 0.0 AS distance
    FROM {topk("COSINE", 5, "cd", "e.lang = 'en'")}""",
)
def multimodal_search(spark, sf):
    def joined(df):
        return df.withColumn("vector", concat_modalities("vector", vec_one_hot("label", 10)))

    queries = QuerySet.of(vector_mean(joined(collection(spark, sf)), ["label"]), "label")
    rows = joined(with_documents(spark, sf).where("lang = 'en'"))
    return hits(knn(rows, queries, 5, "COSINE"))


@query(
    "probe_latency",
    hit_sql("L2", 1, E + ", q AS (SELECT 0::BIGINT AS query_id, list_transform(range(0, 64), lambda i: 0.0::DOUBLE) AS v)"),
)
def probe_latency(spark, sf):
    return hits(knn(collection(spark, sf), QuerySet.literal(spark, [[0.0] * 64]), 1, "L2"))


@query(
    "project_output_fields",
    f"""WITH {LABEL_Q} SELECT t.query_id, t.id, round(t.distance, 6) + 0.0 AS distance, e.label
    FROM {topk("L2", 10)} t JOIN e ON e.id = t.id""",
)
def project_output_fields(spark, sf):
    rows, queries = collection(spark, sf), label_queries(spark, sf)
    found = hits(knn(rows, queries, 10, "L2"))
    bound = search.most_hits(queries, 10)
    joined = search.attach_fields(found, rows, ["label"], bound, how="inner")
    return joined.select("query_id", "id", "distance", "label")


@query(
    "join_search_metadata",
    f"""WITH {LABEL_Q} SELECT t.query_id, CAST(t.rank AS INT) AS rank, t.id,
    round(t.distance, 6) + 0.0 AS distance, d.lang, d.source
    FROM {topk("COSINE", 10)} t LEFT JOIN documents d ON d.doc_id = t.id""",
)
def join_search_metadata(spark, sf):
    queries = label_queries(spark, sf)
    found = hits(knn(collection(spark, sf), queries, 10, "COSINE"))
    bound = search.most_hits(queries, 10)
    return search.attach_fields(
        found, table(spark, sf, "documents"), ["lang", "source"], bound, "doc_id", "left"
    )


# --- clustered search -----------------------------------------------------------

CELLS = f"""{E},{means("label", "e", "c")},
    cell AS (SELECT id, v, label, centroid_id FROM (SELECT e.id, e.v, e.label, c.query_id AS centroid_id,
      row_number() OVER (PARTITION BY e.id ORDER BY list_distance(e.v, c.v), c.query_id) AS r
      FROM e, c) WHERE r = 1)"""


def _indexed(spark, sf):
    centroids = label_queries(spark, sf)
    return ivf.assign_cells(collection(spark, sf), centroids), centroids


@query("ivf_build", f"WITH {CELLS} SELECT id, label, CAST(centroid_id AS INT) AS centroid_id FROM cell")
def ivf_build(spark, sf):
    return _indexed(spark, sf)[0].select("id", "label", "centroid_id")


@query(
    "ivf_search",
    f"""WITH {CELLS}, {DOCS}, {means(SOURCE_KEY, "ed")},
    probe AS (SELECT query_id, centroid_id FROM (SELECT q.query_id, c.query_id AS centroid_id,
      row_number() OVER (PARTITION BY q.query_id ORDER BY list_distance(q.v, c.v), c.query_id) AS r
      FROM q, c) WHERE r <= 4),
    found AS (SELECT q.query_id, e.id, list_distance(e.v, q.v) AS distance,
      row_number() OVER (PARTITION BY q.query_id ORDER BY list_distance(e.v, q.v), e.id) AS rank
      FROM q JOIN probe USING (query_id) JOIN cell e USING (centroid_id))
    SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) + 0.0 AS distance
    FROM found WHERE rank <= 5""",
)
def ivf_search(spark, sf):
    indexed, centroids = _indexed(spark, sf)
    return hits(ivf.ivf_search(indexed, centroids, source_queries(spark, sf), nprobe=4, k=5))


@query(
    "ivf_search_large_query_set",
    f"""WITH {CELLS}, probe AS (SELECT query_id, centroid_id FROM (SELECT e.id AS query_id, c.query_id AS centroid_id,
      row_number() OVER (PARTITION BY e.id ORDER BY list_distance(e.v, c.v), c.query_id) AS r
      FROM e, c) WHERE r <= 3),
    found AS (SELECT probe.query_id, cell.id, list_distance(cell.v, e.v) AS distance,
      row_number() OVER (PARTITION BY probe.query_id ORDER BY list_distance(cell.v, e.v), cell.id) AS rank
      FROM probe JOIN e ON e.id = probe.query_id JOIN cell USING (centroid_id))
    SELECT query_id, CAST(rank AS INT) AS rank, id, round(distance, 6) + 0.0 AS distance
    FROM found WHERE rank <= 3""",
)
def ivf_search_large_query_set(spark, sf):
    """Every vector asks: more queries than one block holds, met with the cells on keys."""
    indexed, centroids = _indexed(spark, sf)
    asking = QuerySet.of(collection(spark, sf), "id", max_queries=256)
    return hits(ivf.ivf_search(indexed, centroids, asking, nprobe=3, k=3))


@query("ivf_search_all_cells", hit_sql("L2", 5, SOURCE_Q))
def ivf_search_all_cells(spark, sf):
    indexed, centroids = _indexed(spark, sf)
    return hits(ivf.ivf_search(indexed, centroids, source_queries(spark, sf), nprobe=10, k=5))


@query(
    "ivf_describe",
    f"""WITH {CELLS} SELECT 'vector' AS field, 'IVF_FLAT' AS index_type, 'L2' AS metric,
    CAST(centroid_id AS INT) AS centroid_id, count(*) AS cell_rows FROM cell GROUP BY centroid_id""",
)
def ivf_describe(spark, sf):
    return ivf.describe_index(_indexed(spark, sf)[0])


@query(
    "vector_centroid",
    f"""WITH {CELLS}, x AS (SELECT centroid_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM cell)
    SELECT CAST(centroid_id AS INT) AS centroid_id, CAST(pos AS INT) AS pos, round(avg(x), 6) + 0.0 AS mean
    FROM x GROUP BY centroid_id, pos""",
)
def vector_centroid(spark, sf):
    parts = vector_mean_parts(_indexed(spark, sf)[0], ["centroid_id"])
    return parts.select("centroid_id", "pos", r6("mean").alias("mean"))


@query("ivf_train", "SELECT vec_id AS id, label, true AS in_nearest_cell, 16 AS cells FROM embeddings")
def ivf_train(spark, sf):
    """Each row lies in the cell of the nearest trained centroid, by distances taken one by one."""
    rows = collection(spark, sf)
    trained = ivf.centroid_set(ivf.train_centroids(rows, nlist=16, iterations=5))
    indexed = ivf.assign_cells(rows, trained)
    block = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in trained.block])
    vector = F.col("vector").cast("array<double>")

    def distance(c):
        return F.aggregate(F.zip_with(vector, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)

    place = {int(c): i for i, c in enumerate(trained.ids)}
    at = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])[F.col("centroid_id")]
    measured = indexed.select("id", "label", F.transform(block, distance).alias("far"), at.alias("at"))
    nearest = F.get("far", F.col("at")) <= F.array_min("far") + 1e-9
    return measured.select("id", "label", nearest.alias("in_nearest_cell"), F.size("far").alias("cells"))


@query("ivf_trained_all_cells", hit_sql("COSINE", 5, SOURCE_Q))
def ivf_trained_all_cells(spark, sf):
    """Wherever training puts the centroids, all cells together are the exact search."""
    rows = collection(spark, sf)
    centroids = ivf.centroid_set(ivf.train_centroids(rows, nlist=8, metric="COSINE", iterations=3))
    indexed = ivf.assign_cells(rows, centroids, "COSINE")
    queries = source_queries(spark, sf)
    return hits(ivf.ivf_search(indexed, centroids, queries, nprobe=8, k=5, metric="COSINE"))


# --- text and hybrid ------------------------------------------------------------

TERMS = TEXT_QUERY.split()


def text_sql(k: int, source: str = "documents", id_col: str = "doc_id") -> str:
    tf = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS tf{i}" for i, w in enumerate(TERMS))
    df = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(TERMS)))
    score = " + ".join(
        f"ln(1.0 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2"
        f" / (tf{i} + 1.2 * (0.25 + 0.75 * length / mean_length))"
        for i in range(len(TERMS))
    )
    return f"""tx_t AS (SELECT {id_col} AS id, list_filter(regexp_split_to_array(lower(text),
      '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM {source}),
    tx_f AS (SELECT id, len(t) AS length, {tf} FROM tx_t),
    tx_s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(length) AS mean_length, {df} FROM tx_f),
    tx_r AS (SELECT id, {score} AS raw FROM tx_f, tx_s),
    tx AS (SELECT id, raw / max(raw) OVER () AS score FROM
      (SELECT * FROM tx_r WHERE raw > 0 ORDER BY raw DESC, id LIMIT {k}))"""


@query("text_search", f"WITH {text_sql(50)} SELECT id, round(score, 6) + 0.0 AS score FROM tx")
def text_search(spark, sf):
    found = hybrid.text_search(table(spark, sf, "documents"), TEXT_QUERY, 50, "doc_id")
    return found.select("id", r6("score").alias("score"))


@query("text_search_stored", f"WITH {text_sql(50)} SELECT id, round(score, 6) + 0.0 AS score FROM tx")
def text_search_stored(spark, sf):
    """The same on stored term tables: written once, searched without the texts."""
    path = f"{shared_dir(spark)}/terms-{uuid.uuid4().hex}"
    text_index.build_index(table(spark, sf, "documents"), path, "doc_id")
    found = text_index.search_index(text_index.TermIndex.open(spark, path), TEXT_QUERY, 50)
    return found.select("id", r6("score").alias("score"))


FUSED = f"""{ONE_Q}, {text_sql(50)},
    vs AS (SELECT id, 1.0 / (1.0 + distance) AS score FROM {topk("L2", 50)}),
    fused AS (SELECT id, vector_score, text_score, vector_score * 0.5 + text_score * 0.5 AS combined_score
      FROM (SELECT coalesce(vs.id, tx.id) AS id, coalesce(vs.score, 0.0) AS vector_score,
        coalesce(tx.score, 0.0) AS text_score FROM vs FULL OUTER JOIN tx ON vs.id = tx.id))"""
FUSED_COLUMNS = """id, round(vector_score, 6) + 0.0 AS vector_score, round(text_score, 6) + 0.0 AS text_score,
    round(combined_score, 6) + 0.0 AS combined_score"""


def _fused(spark, sf, weight=0.5):
    near = knn(collection(spark, sf), one_query(spark, sf), 50, "L2")
    side = near.select("id", similarity("distance", "L2").alias("score"))
    found = hybrid.text_search(table(spark, sf, "documents"), TEXT_QUERY, 50, "doc_id")
    return hybrid.fuse_results(side, found, weight)


def _rounded(df, *more):
    return df.select(
        "id",
        r6("vector_score").alias("vector_score"),
        r6("text_score").alias("text_score"),
        r6("combined_score").alias("combined_score"),
        *more,
    )


@query("fuse_results", f"WITH {FUSED} SELECT {FUSED_COLUMNS} FROM fused")
def fuse_results(spark, sf):
    return _rounded(_fused(spark, sf))


@query(
    "sort_by_score",
    f"WITH {FUSED} SELECT {FUSED_COLUMNS} FROM fused ORDER BY combined_score DESC, id",
)
def sort_by_score(spark, sf):
    return _rounded(hybrid.sort_by_score(_fused(spark, sf)))


@query(
    "filter_score_window",
    f"WITH {FUSED} SELECT {FUSED_COLUMNS} FROM fused WHERE combined_score BETWEEN 0.3 AND 1.0",
)
def filter_score_window(spark, sf):
    return _rounded(_fused(spark, sf).where(filters.score_window("combined_score", 0.3, 1.0)))


RANKED = f"""{FUSED}, ranked AS (SELECT fused.*, l.quality,
    combined_score + 0.1 * coalesce(CAST(l.quality AS DOUBLE), 0.0) AS ranking_score
    FROM fused LEFT JOIN labels l ON l.doc_id = fused.id)"""
RANKINGS = [hybrid.Ranking("combined_score", 1.0, max_results=20), hybrid.Ranking("quality", 0.1)]


def _quality(spark, sf):
    return table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")


@query(
    "rank_weighted",
    f"""WITH {RANKED} SELECT {FUSED_COLUMNS}, quality, round(ranking_score, 6) + 0.0 AS ranking_score
    FROM ranked ORDER BY ranked.ranking_score DESC, id LIMIT 20""",
)
def rank_weighted(spark, sf):
    ranked = hybrid.rank_weighted(_fused(spark, sf).join(_quality(spark, sf), "id", "left"), RANKINGS)
    return _rounded(ranked, "quality", r6("ranking_score").alias("ranking_score"))


@query(
    "hybrid_search",
    f"""WITH {E}, {means("0", "e")}, ed AS (SELECT e.id, e.v, d.text, d.lang FROM e JOIN documents d
      ON e.id = d.doc_id WHERE d.lang = 'en' AND d.n_chars >= 300),
    {text_sql(50, "ed", "id")},
    vs AS (SELECT id, 1.0 / (1.0 + distance) AS score FROM {topk("L2", 50, "ed")}),
    fused AS (SELECT id, vector_score, text_score, vector_score * 0.6 + text_score * 0.4 AS combined_score
      FROM (SELECT coalesce(vs.id, tx.id) AS id, coalesce(vs.score, 0.0) AS vector_score,
        coalesce(tx.score, 0.0) AS text_score FROM vs FULL OUTER JOIN tx ON vs.id = tx.id)),
    ranked AS (SELECT fused.*, l.quality,
      combined_score + 0.1 * coalesce(CAST(l.quality AS DOUBLE), 0.0) AS ranking_score
      FROM fused LEFT JOIN labels l ON l.doc_id = fused.id)
    SELECT {FUSED_COLUMNS}, quality, round(ranking_score, 6) + 0.0 AS ranking_score FROM
    (SELECT * FROM ranked ORDER BY ranking_score DESC, id LIMIT 20)
    WHERE combined_score BETWEEN 0.2 AND 1.0""",
)
def hybrid_search(spark, sf):
    spec = hybrid.SearchSpec(top_k=50, min_score=0.2, use_hybrid=True, hybrid_weight=0.4)
    wanted = filters.FilterSpec(
        [filters.Condition("lang", "==", "en"), filters.Condition("n_chars", ">=", 300)]
    )
    found = hybrid.hybrid_search(
        with_documents(spark, sf),
        one_query(spark, sf),
        TEXT_QUERY,
        spec,
        [wanted],
        RANKINGS,
        ranking_fields=_quality(spark, sf),
    )
    return _rounded(found, "quality", r6("ranking_score").alias("ranking_score"))
