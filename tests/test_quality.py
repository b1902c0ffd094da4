from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spanvec.functions import text as tx
from spanvec.functions import vectors as vec
from spanvec.functions.compare import num_close, vec_close
from spanvec.operators import cleaning, joins, quality
from spanvec.operators.collections import CollectionSpec, conform_collection
from spanvec.operators.quality import Rules

RECORDS = "id string, text string, category string, score string"


def errors(df, rules, key="id"):
    return {getattr(r, key): r.error for r in quality.mark_errors(df, rules).collect()}


def test_first_failing_rule_wins(spark):
    rows = [("1", "a", "X", "0.5"), ("2", None, "Y", "x"), ("3", "c", "Z", "invalid"), ("4", "d", "Z", "1.5"), ("5", "d", "z", "0.1")]
    df = spark.createDataFrame(rows, RECORDS)
    rules = Rules(
        required_fields=["id", "text"],
        field_types={"id": "int", "score": "float"},
        value_ranges={"n": (0, 1)},
        patterns={"category": "[A-Z]"},
        text_values=True,
    )
    assert errors(df, rules) == {
        "1": None,
        "2": "Missing required field: text",
        "3": "Invalid type for field score: expected float",
        "4": None,
        "5": "Value for field category does not match pattern: [A-Z]",
    }


def test_required_field_without_a_column(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    assert errors(df, Rules(required_fields=["gone"])) == {1: "Missing required field: gone"}


def test_valid_rows_and_messages(spark):
    df = spark.createDataFrame([(0, 0.5), (1, -1.0), (2, 2.0), (3, None)], "id bigint, score double")
    valid, bad = quality.validate_records(df, Rules(value_ranges={"score": (0.0, 1.0)}))
    assert sorted(r.id for r in valid.collect()) == [0, 3]
    assert {r.error for r in bad.collect()} == {
        "Record 1: Value for field score below minimum: 0.0",
        "Record 2: Value for field score above maximum: 1.0",
    }


@pytest.mark.parametrize(
    "value, kind, good",
    [("1", "int", True), ("true", "int", True), ("true", "bool", True), ("1", "bool", False),
     ("1", "float", False), ("1.5", "float", True), ("1.5", "int", False), ('"a"', "str", True),
     ("1", "str", False), ("[1]", "list", True), ('{"a": 1}', "dict", True), ('"1"', "int", False)],
)
def test_types_of_variant_values(spark, value, kind, good):
    df = spark.createDataFrame([(1, value)], "id bigint, t string").select("id", F.parse_json("t").alias("f"))
    message = None if good else f"Invalid type for field f: expected {kind}"
    assert errors(df, Rules(field_types={"f": kind})) == {1: message}


def test_pattern_is_anchored_at_the_start_only(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "xabc"), (3, "b")], "id bigint, f string")
    got = errors(df, Rules(patterns={"f": "a|b"}))
    assert got[1] is None and got[2] is not None and got[3] is None


def test_vector_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [-inf, 1.0]), (4, []), (5, [1.0]), (6, [0.0, 0.0]), (7, None)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    bad = "Vector field vector contains NaN or infinite values"
    dim = "Vector field vector has incorrect dimensions: expected 2, got "
    assert errors(df, Rules(vector_dimensions=2)) == {
        0: None, 1: bad, 2: bad, 3: bad, 4: dim + "0", 5: dim + "1", 6: None, 7: None,
    }
    good, rejected = quality.validate_vectors(df, 2, normalize=True)
    out = {r.id: r.vector for r in good.collect()}
    assert set(out) == {0, 6} and out[6] is None and abs(sum(x * x for x in out[0]) - 1) < 1e-12
    assert rejected.count() == 6


def test_metadata_rules(spark):
    df = spark.createDataFrame([(1, {"a": "1"}), (2, {"a": "x"}), (3, {"b": "x"})], "id bigint, metadata map<string,string>")
    got = errors(df, Rules(metadata_schema={"a": "int"}))
    assert got == {1: None, 2: "Invalid type for metadata field a: expected int", 3: None}
    text = spark.createDataFrame([(1, "x"), (2, None)], "id bigint, metadata string")
    assert errors(text, Rules()) == {1: "Metadata must be a dictionary", 2: None}


def test_query_requests(spark):
    rows = [(0, [1.0], 5, "L2"), (1, None, 5, "L2"), (2, [1.0, None], 5, "L2"), (3, [1.0], 0, "L2"), (4, [1.0], 5, "DOT"), (5, [1.0], None, None)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>, top_k int, metric_type string")
    got = {r.id: r.e for r in df.select("id", quality.query_error().alias("e")).collect()}
    assert got == {
        0: None, 1: "Query must contain 'vector'", 2: "Query vector must contain only numbers",
        3: "top_k must be a positive integer", 4: "Invalid metric_type: DOT", 5: None,
    }


def test_cleaning(spark):
    rows = [(1, "a", "X", 0.5), (1, "a", "X", 0.5), (2, "b", "Y", None)]
    df = spark.createDataFrame(rows, "id bigint, text string, category string, score double")
    out = cleaning.clean_records(df)
    assert out.count() == 2 and out.where("score is null").count() == 0
    assert out.where("id = 2").first().score == 0.5


def test_scaling_and_outliers(spark):
    df = spark.createDataFrame([(i, float(i % 10), 7.0) for i in range(100)] + [(100, 1e6, 7.0)], "id bigint, x double, c double")
    kept = cleaning.remove_outliers(df, ["x", "c"])
    assert kept.count() == 100
    scaled = cleaning.normalize_numeric(kept, ["x", "c"])
    low, high, same = scaled.agg(F.min("x"), F.max("x"), F.max("c")).first()
    assert (low, high, same) == (0.0, 1.0, 0.0)


def test_transform(spark):
    df = spark.createDataFrame([(1, "t", [3.0, 4.0])], "id bigint, text string, vector array<double>")
    row = cleaning.transform_records(df, {"text": "content"}).first()
    assert row.normalized_vector == [0.6, 0.8] and row.metadata == {"content": "t"}


def test_diff(spark):
    schema = "id bigint, score double, vector array<double>, metadata map<string,string>, name string"
    rows = [(i, 0.9, [1.0, 2.0], {"a": "1", "b": "2"}, "n") for i in range(5)]
    same = spark.createDataFrame(rows, schema)
    assert joins.diff_results(same, same.repartition(3)).count() == 0
    near = same.withColumn("score", F.lit(0.9001))
    assert joins.diff_results(same, near, 0.001).count() == 0
    far = same.withColumn("score", F.lit(0.8))
    assert {(r.field, r.message) for r in joins.diff_results(same, far, 0.001).collect()} == {("score", "mismatch")}
    other = spark.createDataFrame(
        [(1, 0.9, [1.0, 2.1], {"b": "2", "a": "1"}, "n"), (2, None, [1.0], None, "m"), (9, 0.9, [1.0, 2.0], {}, "n")], schema
    )
    got = {(r.id, r.field, r.message) for r in joins.diff_results(same, other).collect()}
    assert got == {
        (0, "id", "missing"), (3, "id", "missing"), (4, "id", "missing"), (9, "id", "unexpected"),
        (1, "vector", "mismatch"), (2, "score", "mismatch"), (2, "vector", "mismatch"),
        (2, "metadata", "mismatch"), (2, "name", "mismatch"),
    }


def test_vector_functions(spark):
    df = spark.createDataFrame(
        [(0, [3.0, 4.0], [4.0, 3.0]), (1, [0.0, 0.0], [1.0, 0.0]), (2, None, [1.0, 1.0])], "id bigint, a array<float>, b array<float>"
    )
    rows = df.orderBy("id").select(
        vec.vec_norm("a").alias("n"), vec.vec_normalize("a").alias("u"), vec.vec_dot("a", "b").alias("d"),
        vec.vec_cosine("a", "b").alias("c"), vec.vec_l2("a", "b").alias("l"), vec.vec_concat("a", "b").alias("j"),
        vec.vec_dim("a").alias("k"), vec.vec_finite("a").alias("f"), vec_close("a", "a").alias("s"),
    ).collect()
    assert rows[0].n == 5 and rows[0].u == [0.6, 0.8] and rows[0].d == 24 and abs(rows[0].c - 0.96) < 1e-12
    assert abs(rows[0].l - 2**0.5) < 1e-12 and rows[0].j == [3.0, 4.0, 4.0, 3.0] and rows[0].k == 2 and rows[0].s
    assert rows[1].u is None and rows[1].c is None and rows[1].d == 0
    assert rows[2].n is None and rows[2].k is None


def test_parse_and_tolerance(spark):
    df = spark.createDataFrame([("[0.1, 2]",), ("oops",), (None,)], "t string")
    assert [r.v for r in df.select(vec.vec_parse("t").alias("v")).collect()] == [[0.1, 2.0], None, None]
    r = spark.range(1).select(
        num_close(F.lit(0.9), F.lit(0.9001), 0.001).alias("a"), num_close(F.lit(0.9), F.lit(0.8), 0.001).alias("b")
    ).first()
    assert r.a and not r.b


def test_metadata_lines_and_labels(spark):
    text = " Title: A: b \nno colon\nTITLE :  last\n key:"
    out = spark.range(1).select(tx.metadata_lines(F.lit(text)).alias("m")).first().m
    assert out == {"title": "last", "key": ""}
    rows = spark.createDataFrame([('{"label": "x", "score": 0.5}',), ('{"prediction": "y", "confidence": 1}',), ("bad",)], "p string")
    got = [tuple(r.c) for r in rows.select(tx.label_score("p").alias("c")).collect()]
    assert got == [("x", 0.5), ("y", 1.0), (None, None)]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("a_b_20240102_030405",), ("plain",)], "n string")
    assert [tuple(r.p) for r in df.select(tx.parse_backup_name("n").alias("p")).collect()] == [("a_b", "20240102_030405"), (None, None)]
    key = lambda **p: spark.range(1).select(tx.request_key("search", **p).alias("k")).first().k
    assert key(a=F.lit(1), b=F.lit("x")) == key(b=F.lit("x"), a=F.lit(1)) != key(a=F.lit(2), b=F.lit("x"))


def test_encryption_round_trip(spark):
    key = F.lit("0123456789abcdef")
    df = spark.createDataFrame([("déjà vu",), ("",), (None,)], "t string")
    out = df.withColumn("s", tx.column_encrypt("t", key)).withColumn("b", tx.column_decrypt("s", key)).collect()
    assert [r.b for r in out] == ["déjà vu", "", None] and out[0].s != "déjà vu"


def test_conform(spark):
    spec = CollectionSpec("c", 2, [("n", "int"), ("t", "str"), ("j", "json"), ("u", "unknown")])
    rows = [(1, [1.0, 2.0], "5", "ok", '{"a": 1}', "x"), (2, [1.0], "5", "ok", "{}", "x"), (3, None, "5", "ok", "{}", "x"),
            (4, [1.0, 2.0], "five", "ok", "{}", "x"), (5, [1.0, 2.0], "5", "y" * 513, "{}", "x"), (6, [1.0, 2.0], None, None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>, n string, t string, j string, u string")
    fits, rejects = conform_collection(df, spec)
    assert dict(fits.dtypes) == {"id": "bigint", "vector": "array<float>", "n": "bigint", "t": "string", "j": "variant", "u": "string"}
    assert fits.schema["vector"].metadata == {"dim": 2}
    assert sorted(r.id for r in fits.select("id").collect()) == [1, 6]
    assert {r.id: r.error for r in rejects.select("id", "error").collect()} == {
        2: "Vector field vector has incorrect dimensions: expected 2, got 1",
        3: "Missing required field: vector",
        4: "Invalid type for field n: expected bigint",
        5: "Value for field t exceeds length 512",
    }
