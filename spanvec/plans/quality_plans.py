"""Validation, cleaning and transformation over the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from spanvec.functions.vectors import vec_concat
from spanvec.operators import cleaning, quality
from spanvec.operators.quality import Rules
from spanvec.plans.base import collection, query, r6, table
from spanvec.plans.function_plans import NORM, long_form, long_sql
from spanvec.plans.search_plans import E

# A document's fields with some left out, so that every rule has work.
RECORDS = """rec AS (SELECT doc_id AS id, CASE WHEN lang = 'es' THEN NULL ELSE lang END AS lang, source, n_chars,
    CASE WHEN lang = 'fr' THEN source ELSE substring(source, 4) END AS code FROM documents)"""


def records(spark, sf):
    lang = F.col("lang")
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(lang != "es", lang).alias("lang"),
        "source",
        "n_chars",
        F.when(lang == "fr", F.col("source")).otherwise(F.expr("substring(source, 4)")).alias("code"),
    )


ALL_RULES = Rules(
    required_fields=["lang"],
    field_types={"code": "int", "n_chars": "int"},
    value_ranges={"n_chars": (50, 5000)},
    patterns={"source": "src1"},
    custom_validators={"code": lambda c: F.length(c) > 1},
    text_values=True,
)
ERROR = """CASE WHEN lang IS NULL THEN 'Missing required field: lang'
    WHEN try_cast(code AS BIGINT) IS NULL THEN 'Invalid type for field code: expected int'
    WHEN n_chars < 50 THEN 'Value for field n_chars below minimum: 50'
    WHEN n_chars > 5000 THEN 'Value for field n_chars above maximum: 5000'
    WHEN NOT starts_with(source, 'src1') THEN 'Value for field source does not match pattern: src1'
    WHEN length(code) <= 1 THEN 'Custom validation failed for field code' END"""


@query(
    "validate_records",
    f"""WITH {RECORDS}, m AS (SELECT id, {ERROR} AS error FROM rec)
    SELECT id, 'Record ' || id || ': ' || error AS error FROM m WHERE error IS NOT NULL
    UNION ALL SELECT id, NULL FROM m WHERE error IS NULL""",
)
def validate_records(spark, sf):
    valid, errors = quality.validate_records(records(spark, sf), ALL_RULES)
    return errors.unionByName(valid.select("id", F.lit(None).cast("string").alias("error")))


@query("validation_summary", f"WITH {RECORDS} SELECT {ERROR} AS error, count(*) AS n FROM rec GROUP BY 1")
def validation_summary(spark, sf):
    return quality.validation_summary(records(spark, sf), ALL_RULES)


def _marked(spark, sf, rules):
    return quality.mark_errors(records(spark, sf), rules).select("id", "error")


@query(
    "check_required",
    f"WITH {RECORDS} SELECT id, CASE WHEN lang IS NULL THEN 'Missing required field: lang' END AS error FROM rec",
)
def check_required(spark, sf):
    return _marked(spark, sf, Rules(required_fields=["id", "lang"]))


@query(
    "check_type",
    f"""WITH {RECORDS} SELECT id, CASE WHEN try_cast(code AS BIGINT) IS NULL THEN 'Invalid type for field code: expected int'
    WHEN n_chars IS NOT NULL THEN 'Invalid type for field n_chars: expected float' END AS error FROM rec""",
)
def check_type(spark, sf):
    return _marked(spark, sf, Rules(field_types={"code": "int", "n_chars": "float"}, text_values=True))


@query(
    "check_type_variant",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 'Invalid type for field payload: expected int' END
    AS error FROM events""",
)
def check_type_variant(spark, sf):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.get_json_object("props", "$.k"))
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.parse_json(text).alias("payload"))
    return quality.mark_errors(rows, Rules(field_types={"payload": "int"})).select("id", "error")


@query(
    "check_range",
    """SELECT event_id AS id, CASE WHEN value < 1.5 THEN 'Value for field value below minimum: 1.5'
    WHEN value > 50.0 THEN 'Value for field value above maximum: 50.0' END AS error FROM events""",
)
def check_range(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), "value")
    return quality.mark_errors(rows, Rules(value_ranges={"value": (1.5, 50.0)})).select("id", "error")


@query(
    "check_pattern",
    f"""WITH {RECORDS} SELECT id, CASE WHEN NOT regexp_matches(source, '^(?:src1|src2$)')
    THEN 'Value for field source does not match pattern: src1|src2$' END AS error FROM rec""",
)
def check_pattern(spark, sf):
    return _marked(spark, sf, Rules(patterns={"source": "src1|src2$"}))


@query(
    "check_custom",
    f"""WITH {RECORDS} SELECT id, CASE WHEN n_chars % 2 = 1 THEN 'Custom validation failed for field n_chars' END
    AS error FROM rec""",
)
def check_custom(spark, sf):
    return _marked(spark, sf, Rules(custom_validators={"n_chars": lambda c: c % 2 == 0}))


@query("check_custom_udf", f"WITH {RECORDS} SELECT id, CASE WHEN length(source) <> 5 THEN 'Custom validation failed for field source' END AS error FROM rec")
def check_custom_udf(spark, sf):
    @F.pandas_udf("boolean")
    def five(values: pd.Series) -> pd.Series:
        return values.str.len() == 5

    return _marked(spark, sf, Rules(custom_validators={"source": five}))


# Vectors cut to a length that depends on the label, with one odd element.
CUT = """cut AS (SELECT vec_id AS id, label, list_append(CAST(embedding[1:55 + label] AS DOUBLE[]),
    CASE WHEN label = 4 THEN 'nan'::DOUBLE ELSE 0.5 END) AS v FROM embeddings)"""
CUT_ERROR = """CASE WHEN label <> 4 THEN 'Vector field vector has incorrect dimensions: expected 60, got ' || len(v)
    ELSE 'Vector field vector contains NaN or infinite values' END"""


def cut_vectors(spark, sf):
    odd = F.when(F.col("label") == 4, F.lit(float("nan"))).otherwise(F.lit(0.5))
    shortened = F.slice("vector", F.lit(1), F.lit(55) + F.col("label"))
    return collection(spark, sf).select("id", "label", vec_concat(shortened, F.array(odd)).alias("vector"))


@query("check_vectors", f"WITH {CUT} SELECT id, {CUT_ERROR} AS error FROM cut")
def check_vectors(spark, sf):
    return quality.mark_errors(cut_vectors(spark, sf), Rules(vector_dimensions=60)).select("id", "error")


@query(
    "check_metadata",
    """SELECT event_id AS id, CASE event_type WHEN 'error' THEN 'Metadata must be a dictionary'
    WHEN 'click' THEN 'Invalid type for metadata field k: expected int' END AS error FROM events""",
)
def check_metadata(spark, sf):
    text = (
        F.when(F.col("event_type") == "error", F.lit("[1]"))
        .when(F.col("event_type") == "click", F.lit('{"k": "x"}'))
        .otherwise(F.col("props"))
    )
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.parse_json(text).alias("metadata"))
    return quality.mark_errors(rows, Rules(metadata_schema={"k": "int"})).select("id", "error")


@query(
    "validate_queries",
    """SELECT vec_id AS id, CASE WHEN label = 0 THEN 'Query must contain ''vector'''
    WHEN label = 1 THEN 'Query vector must contain only numbers'
    WHEN label - 3 <= 0 THEN 'top_k must be a positive integer'
    WHEN label > 7 THEN 'Invalid metric_type: M' || label END AS error FROM embeddings""",
)
def validate_queries(spark, sf):
    label = F.col("label")
    broken = vec_concat("vector", F.array(F.lit(None).cast("double")))
    asked = collection(spark, sf).select(
        "id",
        F.when(label == 1, broken).when(label > 1, F.col("vector").cast("array<double>")).alias("vector"),
        (label - 3).alias("top_k"),
        F.when(label > 7, F.concat(F.lit("M"), label)).otherwise(F.lit("COSINE")).alias("metric_type"),
    )
    return asked.select("id", quality.query_error().alias("error"))


@query(
    "validate_vectors_normalize",
    f"""WITH {CUT}, good AS (SELECT id, v FROM cut WHERE label = 5)
    {long_sql(f"list_transform(v, lambda x: x / {NORM})", "good")}""",
)
def validate_vectors_normalize(spark, sf):
    good, _ = quality.validate_vectors(cut_vectors(spark, sf), 61, normalize=True)
    return long_form(good, "vector", "id")


@query(
    "validate_vectors_rejects",
    """SELECT vec_id AS id, 'Vector field vector has incorrect dimensions: expected 61, got ' || (56 + label) AS error
    FROM embeddings WHERE label <> 5""",
)
def validate_vectors_rejects(spark, sf):
    return quality.validate_vectors(cut_vectors(spark, sf), 61)[1].select("id", "error")


@query(
    "check_varchar_length",
    """SELECT doc_id AS id, CASE WHEN length(text) > 512 THEN 'Value for field text exceeds length 512' END AS error
    FROM documents""",
)
def check_varchar_length(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(F.col("doc_id").alias("id"), quality.check_varchar_length("text").alias("error"))


# --- cleaning -------------------------------------------------------------------------


@query(
    "clean_fill_missing",
    """WITH j AS (SELECT d.doc_id, CASE WHEN d.lang <> 'es' THEN d.lang END AS lang,
      CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, coalesce(lang, '') AS lang,
    round(coalesce(quality, (SELECT avg(quality) FROM j)), 6) + 0.0 AS quality,
    coalesce(toxic, -1.0) AS toxic FROM j""",
)
def clean_fill_missing(spark, sf):
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") != "es", F.col("lang")).alias("lang"))
    joined = docs.join(labels, "doc_id", "left").select(
        "doc_id", "lang", "quality", F.col("toxic").cast("double").alias("toxic")
    )
    return cleaning.fill_missing(joined, {"toxic": -1.0}).withColumn("quality", r6("quality"))


@query(
    "clean_normalize_numeric",
    """SELECT event_id, round((value - (SELECT min(value) FROM events)) /
    ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)), 6) + 0.0 AS value FROM events""",
)
def clean_normalize_numeric(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return cleaning.normalize_numeric(events, ["value"]).withColumn("value", r6("value"))


@query(
    "clean_remove_outliers",
    """SELECT event_id, value FROM events WHERE abs((value - (SELECT avg(value) FROM events)) /
    (SELECT stddev_samp(value) FROM events)) <= 3.0""",
)
def clean_remove_outliers(spark, sf):
    return cleaning.remove_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"])


@query(
    "clean_records",
    """WITH u AS (SELECT DISTINCT text, CASE WHEN lang <> 'es' THEN lang END AS lang, n_chars FROM documents),
    f AS (SELECT text, coalesce(lang, '') AS lang, n_chars FROM u),
    o AS (SELECT * FROM f WHERE abs((n_chars - (SELECT avg(n_chars) FROM f)) / (SELECT stddev_samp(n_chars) FROM f)) <= 3.0)
    SELECT md5(text) AS text_key, lang, round((n_chars - (SELECT min(n_chars) FROM o))::DOUBLE /
    ((SELECT max(n_chars) FROM o) - (SELECT min(n_chars) FROM o)), 6) + 0.0 AS n_chars FROM o""",
)
def clean_records(spark, sf):
    docs = table(spark, sf, "documents").select(
        "text", F.when(F.col("lang") != "es", F.col("lang")).alias("lang"), "n_chars"
    )
    cleaned = cleaning.clean_records(docs, outliers=["n_chars"], normalize=["n_chars"])
    return cleaned.select(F.md5("text").alias("text_key"), "lang", r6("n_chars").alias("n_chars"))


@query("rename_fields", "SELECT doc_id AS id, lang AS language, n_chars AS length FROM documents")
def rename_fields(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return cleaning.rename_fields(docs, {"doc_id": "id", "lang": "language", "n_chars": "length"})


TRANSFORMED = f"""WITH {E}, w AS (SELECT id, list_transform(v, lambda x: x * 3) AS v, label FROM e)"""


def _transformed(spark, sf):
    rows = collection(spark, sf).select(
        "id", F.transform("vector", lambda x: x.cast("double") * 3).alias("vector"), "label"
    )
    return cleaning.transform_records(rows, {"label": "category"})


@query("transform_records", f"{TRANSFORMED} {long_sql(f'list_transform(v, lambda x: x / {NORM})', 'w')}")
def transform_records(spark, sf):
    return long_form(_transformed(spark, sf), "normalized_vector", "id")


@query("transform_metadata", "SELECT vec_id AS id, 'category' AS key, CAST(label AS VARCHAR) AS value FROM embeddings")
def transform_metadata(spark, sf):
    return _transformed(spark, sf).select("id", F.explode("metadata").alias("key", "value"))
