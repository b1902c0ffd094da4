"""The registered queries of the training-data operators, with SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanvec.llm import (
    byte_bpe,
    conversation_tools,
    decontaminate,
    jaccard_join,
    language_crf,
    license_scan,
    nn_descent,
    pairwise_quality,
    permutation_index,
    source_divergence,
    source_mix,
    tool_calls,
    vector_codes,
    warc,
)
from spanvec.plans.base import Plan, table

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(plan: Plan) -> Plan:
    QUERIES[plan.__name__] = plan
    return plan


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> dict[bytes, int]:
    with open(public_tokenizers.path(name), encoding="ascii") as lines:
        return byte_bpe.read_ranks(lines.read())


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=3, num=90, den=100)


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(), public_tokenizers.PATTERN)


@query
def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_crf.predict(docs, language_crf.learn(docs))


@query
def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Base32 of a SHA-1: eight characters for each ten hexadecimal digits.
ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
 array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(h, 1 + 10 * (j // 8), 10) AS BIGINT)
 >> (35 - 5 * (j % 8))) & 31) AS INTEGER), 1) FOR j IN range(32)], '') AS payload_digest,
 CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN page_id > first THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM p JOIN f USING (h)
"""


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@query
def op6_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pairwise_quality.score(docs, pairwise_quality.learn(docs, table(spark, sf_dir, "labels")))


@query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


@query
def op9_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


ORACLES["op10_tool_calls"] = conversation_tools.ORACLE


@query
def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = conversation_tools.calls_and_results(table(spark, sf_dir, "conversations"))
    return tool_calls.format_calls(calls, results, conversation_tools.SCHEMAS)


def _codebook_rounds(rounds: int) -> str:
    """Common tables ``book0`` to the last round's and ``near``, the final nearest entries."""
    near = """SELECT n, j, e, d FROM (SELECT n, j, e, d, row_number() OVER (PARTITION BY n, j ORDER BY d, e) AS place FROM
 (SELECT n, part.j, e, list_sum(list_transform(range(1, len(part.x) + 1), lambda k: (part.x[k] - {book}.x[k]) * (part.x[k] - {book}.x[k]))) AS d
 FROM part JOIN {book} ON part.j = {book}.j)) WHERE place = 1"""
    out = []
    for i in range(rounds):
        out.append(f"near{i} AS ({near.format(book=f'book{i}')})")
        out.append(
            f"mean{i} AS (SELECT j, e, list(m ORDER BY k) AS x FROM (SELECT j, e, k, CAST(floor(sum(part.x[k])::DOUBLE / count(*)) AS BIGINT) AS m"
            f" FROM part JOIN near{i} USING (n, j), (SELECT unnest(range(1, (SELECT max(len(x)) FROM part) + 1)) AS k) GROUP BY j, e, k) GROUP BY j, e)"
        )
        out.append(f"book{i + 1} AS (SELECT j, e, coalesce(mean{i}.x, book{i}.x) AS x FROM book{i} LEFT JOIN mean{i} USING (j, e))")
    out.append(f"near AS ({near.format(book=f'book{rounds}')})")
    return ", ".join(out)


#: Sums of a part stay far below 2**53, so the quotient in doubles has an exact floor.
ORACLES["op11_vector_codes"] = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT n, j, x[j * len(x) // 16 + 1 : (j + 1) * len(x) // 16] AS x FROM v, (SELECT unnest(range(16)) AS j)),
book0 AS (SELECT j, n - 1 AS e, x FROM part WHERE n <= 64),
{_codebook_rounds(2)},
sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM book2),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error FROM near JOIN v USING (n) GROUP BY n, vec_id, label)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, sha
"""


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


ORACLES["op12_source_divergence"] = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n FROM g JOIN k USING (lang)
 LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p FROM c WINDOW w AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS q FROM k WINDOW w AS (PARTITION BY lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


#: Windows of ten words as joined words; DuckDB counts list places from 1.
ORACLES["op13_decontaminate"] = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[s : s + m - 1], ' ') AS g
 FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
grams AS (SELECT r, m, s, array_to_string(w[s : s + m - 1], ' ') AS g
 FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d JOIN (SELECT DISTINCT m FROM win) ON len(w) >= m)),
hits AS (SELECT r, s, m, item_id FROM grams JOIN win USING (m, g)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT r, s, m FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""


@query
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
