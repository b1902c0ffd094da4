"""Scalar, array, map, JSON and text functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanvec.functions import text as tx
from spanvec.functions import vectors as vec
from spanvec.functions.compare import num_close, vec_close
from spanvec.operators import pairs, providers, search
from spanvec.plans.base import collection, query, r6, table
from spanvec.plans.search_plans import E, LABEL_Q, label_queries


def long_form(df, vector, *keys):
    return df.select(*keys, F.posexplode(vector).alias("pos", "x")).select(*keys, "pos", r6("x").alias("x"))


def long_sql(vector: str, source: str, keys: str = "id") -> str:
    return f"""SELECT {keys}, CAST(pos AS INT) AS pos, round(x, 6) + 0.0 AS x FROM
    (SELECT {keys}, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS pos FROM
    (SELECT {keys}, {vector} AS w FROM {source}))"""


NORM = "sqrt(list_inner_product(v, v))"


@query("vec_norm", f"WITH {E} SELECT id, round({NORM}, 6) + 0.0 AS norm FROM e")
def vec_norm(spark, sf):
    return collection(spark, sf).select("id", r6(vec.vec_norm("vector")).alias("norm"))


@query(
    "vec_normalize",
    f"""WITH {E}, s AS (SELECT id, list_transform(v, lambda x: x * (id + 2)) AS v FROM e)
    {long_sql(f"list_transform(v, lambda x: x / {NORM})", "s")}""",
)
def vec_normalize(spark, sf):
    scaled = collection(spark, sf).select(
        "id", F.transform("vector", lambda x: x.cast("double") * (F.col("id") + 2)).alias("v")
    )
    return long_form(scaled, vec.vec_normalize("v"), "id")


@query(
    "vec_dot",
    f"WITH {LABEL_Q} SELECT e.id AS i, q.query_id AS j, round(list_inner_product(e.v, q.v), 6) + 0.0 AS value FROM e, q",
)
def vec_dot(spark, sf):
    products = search.pair_matrix(collection(spark, sf), label_queries(spark, sf), "IP")
    return products.select("i", "j", r6("value").alias("value"))


@query(
    "pair_products",
    f"""WITH {E}, p AS (SELECT id AS i, unnest([id + 1, id + 17, id * 2]) AS j FROM e)
    SELECT p.i, p.j, round(list_distance(a.v, b.v), 6) + 0.0 AS l2,
      round(list_inner_product(a.v, b.v), 6) + 0.0 AS ip,
      round(list_cosine_similarity(a.v, b.v), 6) + 0.0 AS cosine
    FROM p LEFT JOIN e a ON a.id = p.i LEFT JOIN e b ON b.id = p.j""",
)
def pair_products(spark, sf):
    rows = collection(spark, sf)
    near = F.array(F.col("id") + 1, F.col("id") + 17, F.col("id") * 2)
    given = rows.select(F.col("id").alias("i"), F.explode(near).alias("j"))
    found = pairs.pair_products(given, rows, rows)
    return found.select("i", "j", *(r6(m).alias(m) for m in ("l2", "ip", "cosine")))


@query(
    "vec_cosine",
    f"WITH {LABEL_Q} SELECT e.id AS i, q.query_id AS j, round(list_cosine_similarity(e.v, q.v), 6) + 0.0 AS value FROM e, q",
)
def vec_cosine(spark, sf):
    products = search.pair_matrix(collection(spark, sf), label_queries(spark, sf), "COSINE")
    return products.select("i", "j", r6("value").alias("value"))


@query("vec_concat", f"WITH {E} {long_sql('list_concat(v, list_transform(v, lambda x: x * 2))', 'e')}")
def vec_concat(spark, sf):
    twice = F.transform(vec.as_double("vector"), lambda x: x * 2)
    return long_form(collection(spark, sf), vec.vec_concat("vector", twice), "id")


@query("vec_dim", "SELECT vec_id AS id, CAST(len(embedding) AS INT) AS dim FROM embeddings")
def vec_dim(spark, sf):
    return collection(spark, sf).select("id", vec.vec_dim("vector").alias("dim"))


@query("vec_finite", "SELECT vec_id AS id, label NOT IN (4, 6, 8) AS finite FROM embeddings")
def vec_finite(spark, sf):
    odd = (
        F.when(F.col("label") == 4, F.lit(float("nan")))
        .when(F.col("label") == 6, F.lit(float("inf")))
        .when(F.col("label") == 8, F.lit(float("-inf")))
        .otherwise(F.lit(1.0))
    )
    whole = vec.vec_concat("vector", F.array(odd))
    return collection(spark, sf).select("id", vec.vec_finite(whole).alias("finite"))


@query(
    "vec_close",
    """SELECT vec_id AS id, true AS same, label <> 2 AS near FROM embeddings""",
)
def vec_close_(spark, sf):
    scale = F.when(F.col("label") == 2, 1.001).otherwise(1.0 + 1e-8)
    scaled = F.transform(vec.as_double("vector"), lambda x: x * scale)
    return collection(spark, sf).select(
        "id",
        vec_close("vector", vec.as_double("vector")).alias("same"),
        vec_close("vector", scaled).alias("near"),
    )


@query(
    "num_close",
    """SELECT event_id, abs(value - value * 1.0005) <= 1e-8 + 0.001 * abs(value * 1.0005) AS near,
    abs(value - value * 1.01) <= 1e-8 + 0.001 * abs(value * 1.01) AS far FROM events""",
)
def num_close_(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        num_close(value, value * 1.0005, 0.001).alias("near"),
        num_close(value, value * 1.01, 0.001).alias("far"),
    )


@query(
    "vec_parse",
    f"WITH {E} {long_sql('v', 'e')}",
)
def vec_parse(spark, sf):
    literal = F.concat(
        F.lit("["), F.array_join(F.transform(vec.as_double("vector"), lambda x: x.cast("string")), ", "), F.lit("]")
    )
    return long_form(collection(spark, sf), vec.vec_parse(literal), "id")


@query(
    "vector_mean",
    f"""WITH {E}, x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e)
    SELECT label, CAST(pos AS INT) AS pos, round(avg(x), 6) + 0.0 AS mean FROM x GROUP BY label, pos""",
)
def vector_mean(spark, sf):
    from spanvec.operators.aggregates import vector_mean_parts

    parts = vector_mean_parts(collection(spark, sf), ["label"])
    return parts.select("label", "pos", r6("mean").alias("mean"))


# --- text, JSON, names ---------------------------------------------------------------

ANSWER = """'Lang: ' || lang || chr(10) || ' Source :  ' || source || ': x ' || chr(10)
    || 'no pair' || chr(10) || 'LANG : ' || n_chars"""


@query(
    "metadata_lines",
    f"""WITH a AS (SELECT doc_id, string_split({ANSWER}, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM a),
    p AS (SELECT doc_id, pos, lower(trim(split_part(line, ':', 1))) AS key,
      trim(substring(line, instr(line, ':') + 1)) AS value FROM l WHERE contains(line, ':'))
    SELECT doc_id, key, arg_max(value, pos) AS value FROM p GROUP BY doc_id, key""",
)
def metadata_lines(spark, sf):
    answer = F.concat(
        F.lit("Lang: "), "lang", F.lit("\n Source :  "), "source", F.lit(": x \nno pair\nLANG : "), "n_chars"
    )
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.explode(tx.metadata_lines(answer)).alias("key", "value"))


@query(
    "label_score",
    """SELECT doc_id, lang AS category, round(n_chars / 50000.0, 6) + 0.0 AS score FROM documents""",
)
def label_score(spark, sf):
    docs = table(spark, sf, "documents")
    share = F.col("n_chars") / F.lit(50000.0)
    one = F.to_json(F.struct(F.col("lang").alias("label"), share.alias("score")))
    other = F.to_json(F.struct(F.col("lang").alias("prediction"), share.alias("confidence")))
    payload = F.when(F.col("lang") == "en", one).otherwise(other)
    read = tx.label_score(payload)
    return docs.select("doc_id", read["category"].alias("category"), r6(read["score"]).alias("score"))


@query("json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_parse(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.json_parse("props", "k int")["k"].alias("k"))


@query("map_lookup", "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent FROM events")
def map_lookup(spark, sf):
    held = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select(
        "event_id", tx.map_lookup(held, "k").alias("k"), tx.map_lookup(held, "other").alias("absent")
    )


@query(
    "json_render",
    """SELECT doc_id, '{"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS body
    FROM documents""",
)
def json_render(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.json_render("lang", "source", "n_chars").alias("body"))


@query(
    "request_key",
    """SELECT doc_id, md5('query:{"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}')
    AS key FROM documents""",
)
def request_key(spark, sf):
    key = tx.request_key("query", source=F.col("source"), lang=F.col("lang"), n_chars=F.col("n_chars"))
    return table(spark, sf, "documents").select("doc_id", key.alias("key"))


@query("backup_name", "SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS name FROM events")
def backup_name(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.backup_name("event_type", "ts").alias("name"))


@query(
    "parse_backup_name",
    """SELECT event_id, event_type || '_v_2' AS collection, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""",
)
def parse_backup_name(spark, sf):
    name = tx.backup_name(F.concat("event_type", F.lit("_v_2")), "ts")
    events = table(spark, sf, "events").select("event_id", tx.parse_backup_name(name).alias("p"))
    return events.select("event_id", "p.collection", "p.stamp")


@query("iso_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events")
def iso_timestamp(spark, sf):
    return table(spark, sf, "events").select("event_id", tx.iso_timestamp("ts").alias("iso"))


@query(
    "string_trim_lower_prefix",
    """SELECT doc_id, lower(trim('  SRC ' || source || ' ')) AS name,
    starts_with(lower(trim('  SRC ' || source || ' ')), 'src src1') AS ones, split_part(source, 'c', 2) AS number
    FROM documents""",
)
def string_trim_lower_prefix(spark, sf):
    name = F.lower(F.trim(F.concat(F.lit("  SRC "), "source", F.lit(" "))))
    return table(spark, sf, "documents").select(
        "doc_id",
        name.alias("name"),
        name.startswith("src src1").alias("ones"),
        F.split("source", "c")[1].alias("number"),
    )


# A key for the round trip only; callers pass their own.
SAMPLE_KEY = "0123456789abcdef"


@query("column_encrypt", "SELECT doc_id, CAST(strlen(text) AS INT) AS size, true AS hidden FROM documents")
def column_encrypt(spark, sf):
    """The form is a nonce of 12 bytes, as many bytes as the text has, and a tag of 16."""
    docs = table(spark, sf, "documents").withColumn("secret", tx.column_encrypt("text", F.lit(SAMPLE_KEY)))
    held = F.unbase64("secret")
    hidden = ~F.substring(held, 13, 16).eqNullSafe(F.substring(F.col("text").cast("binary"), 1, 16)) | (F.octet_length("text") == 0)
    return docs.select("doc_id", (F.octet_length(held) - 28).alias("size"), hidden.alias("hidden"))


@query("column_decrypt", "SELECT doc_id, md5(text) AS plain, lang FROM documents")
def column_decrypt(spark, sf):
    docs = table(spark, sf, "documents").withColumn("secret", tx.column_encrypt("text", F.lit(SAMPLE_KEY)))
    return docs.select("doc_id", F.md5(tx.column_decrypt("secret", F.lit(SAMPLE_KEY))).alias("plain"), "lang")


# --- providers -----------------------------------------------------------------------


@query(
    "embed_text",
    r"""WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
      lambda x: x <> '')) AS tok FROM documents),
    b AS (SELECT doc_id, CAST(('0x' || substring(md5(tok), 1, 8))::BIGINT % 32 AS INT) AS pos, count(*) AS c
      FROM t GROUP BY ALL),
    n AS (SELECT doc_id, sqrt(sum(c * c)) AS norm FROM b GROUP BY doc_id)
    SELECT doc_id, pos, round(c / norm, 6) + 0.0 AS x FROM b JOIN n USING (doc_id)""",
)
def embed_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return long_form(providers.embed_text(docs, "text", 32), "vector", "doc_id").where("x <> 0")


def answer_provider():
    def answer(texts):
        return [f"Words: {len(t.split(' '))}\nFirst: {t[:1]}" for t in texts]

    return answer


@query("extract_metadata", "SELECT doc_id, CAST(len(string_split(text, ' ')) AS VARCHAR) AS words, trim(substring(text, 1, 1)) AS first FROM documents")
def extract_metadata(spark, sf):
    docs = providers.extract_metadata(
        table(spark, sf, "documents").select("doc_id", "text"), "text", answer_provider
    )
    return docs.select("doc_id", F.col("metadata")["words"].alias("words"), F.col("metadata")["first"].alias("first"))


@query("map_items", "SELECT doc_id, lang, length(text) AS chars FROM documents")
def map_items(spark, sf):
    def measure(batch):
        return batch.assign(chars=batch["text"].str.len()).drop(columns="text")

    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return providers.map_items(docs, measure, "doc_id long, lang string, chars long")


@query(
    "generate_collection",
    "SELECT vec_id AS id, 16 AS dim, true AS in_range, 'value_' || vec_id || '_1' AS tag FROM embeddings",
)
def generate_collection(spark, sf):
    from spanvec.sources.generate import generate_vectors

    ids = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    made = generate_vectors(ids, 16)
    return made.select(
        "id",
        F.size("vector").alias("dim"),
        F.forall("vector", lambda x: (x >= 0) & (x < 1)).alias("in_range"),
        F.col("metadata")["field_1"].alias("tag"),
    )
