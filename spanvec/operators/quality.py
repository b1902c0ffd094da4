"""Record validation: one error column, first failing rule wins, one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.functions.vectors import vec_finite, vec_normalize
from spanvec.operators.search import METRICS

# The messages.
MISSING = "Missing required field: {field}"
WRONG_TYPE = "Invalid type for field {field}: expected {type}"
BELOW = "Value for field {field} below minimum: {limit}"
ABOVE = "Value for field {field} above maximum: {limit}"
NO_MATCH = "Value for field {field} does not match pattern: {pattern}"
CUSTOM = "Custom validation failed for field {field}"
BAD_DIM = "Vector field {field} has incorrect dimensions: expected {dim}, got "
NOT_FINITE = "Vector field {field} contains NaN or infinite values"
NOT_DICT = "Metadata must be a dictionary"
META_TYPE = "Invalid type for metadata field {field}: expected {type}"
NO_QUERY_VECTOR = "Query must contain 'vector'"
NOT_NUMBERS = "Query vector must contain only numbers"
BAD_TOP_K = "top_k must be a positive integer"
BAD_METRIC = "Invalid metric_type: "
TOO_LONG = "Value for field {field} exceeds length {limit}"

# Fixed value: the longest VARCHAR metadata value.
VARCHAR_LIMIT = 512

# Type names of a rule, the Spark types they accept, and the
# pattern their value shows in the schema of a VARIANT. A boolean is an int.
ACCEPTED = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "str": (T.StringType,),
    "bool": (T.BooleanType,),
    "list": (T.ArrayType,),
    "dict": (T.MapType, T.StructType),
}
VARIANT_KIND = {
    "int": r"^(BIGINT|DECIMAL\(\d+,0\)|BOOLEAN)$",
    "float": r"^(DOUBLE|FLOAT|DECIMAL\(\d+,[1-9]\d*\))$",
    "str": r"^STRING$",
    "bool": r"^BOOLEAN$",
    "list": r"^ARRAY<",
    "dict": r"^OBJECT<",
}
TEXT_TYPE = {"int": "bigint", "float": "double", "bool": "boolean"}


@dataclass(frozen=True)
class Rules:
    required_fields: Sequence[str] = ()
    field_types: Mapping[str, str] = field(default_factory=dict)
    value_ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    patterns: Mapping[str, str] = field(default_factory=dict)
    custom_validators: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    validate_vectors: bool = True
    vector_dimensions: int | None = None
    validate_metadata: bool = True
    metadata_schema: Mapping[str, str] | None = None
    text_values: bool = False
    """String columns hold the text of values, as read from an untyped file."""


def check_required(name: str, df: DataFrame) -> Column:
    message = F.lit(MISSING.format(field=name))
    return F.when(F.col(name).isNull(), message) if name in df.columns else message


def _of_type(value: Column, kind: T.DataType, expected: str, text_values: bool) -> Column:
    """Whether a present value is of the expected type."""
    if isinstance(kind, T.VariantType):
        return F.schema_of_variant(value).rlike(VARIANT_KIND[expected])
    if text_values and isinstance(kind, T.StringType) and expected in TEXT_TYPE:
        return value.try_cast(TEXT_TYPE[expected]).isNotNull()
    return F.lit(isinstance(kind, ACCEPTED[expected]))


def check_type(name: str, expected: str, df: DataFrame, text_values: bool = False) -> Column:
    value = F.col(name)
    fits = _of_type(value, df.schema[name].dataType, expected, text_values)
    return F.when(value.isNotNull() & ~fits, WRONG_TYPE.format(field=name, type=expected))


def check_range(name: str, low: float, high: float) -> Column:
    value = F.col(name)
    return F.when(value < low, BELOW.format(field=name, limit=low)).when(
        value > high, ABOVE.format(field=name, limit=high)
    )


def check_pattern(name: str, pattern: str) -> Column:
    """The pattern is anchored at the start only."""
    value = F.col(name).cast("string")
    return F.when(
        value.isNotNull() & ~value.rlike(f"^(?:{pattern})"),
        NO_MATCH.format(field=name, pattern=pattern),
    )


def check_custom(name: str, test: Callable[[Column], Column]) -> Column:
    """``test`` maps the column to a boolean column: an expression or a pandas UDF."""
    value = F.col(name)
    return F.when(value.isNotNull() & ~F.coalesce(test(value), F.lit(False)), CUSTOM.format(field=name))


def vector_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.NumericType)
    ]


def check_vector(name: str, dim: int | None) -> Column:
    value = F.col(name)
    bad = F.when(value.isNotNull() & ~vec_finite(value), NOT_FINITE.format(field=name))
    if dim is None:
        return bad
    wrong = F.concat(F.lit(BAD_DIM.format(field=name, dim=dim)), F.size(value).cast("string"))
    return F.coalesce(F.when(F.size(value) != dim, wrong), bad)


def check_metadata(name: str, schema: Mapping[str, str] | None, df: DataFrame) -> list[Column]:
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.VariantType):
        described = F.schema_of_variant(value)
        rules = [F.when(value.isNotNull() & ~described.rlike(VARIANT_KIND["dict"]), NOT_DICT)]
    elif isinstance(kind, ACCEPTED["dict"]):
        rules = []
    else:
        return [F.when(value.isNotNull(), NOT_DICT)]
    for key, expected in (schema or {}).items():
        if isinstance(kind, T.VariantType):
            entry, entry_kind = F.try_variant_get(value, f"$.{key}", "variant"), T.VariantType()
        elif isinstance(kind, T.MapType):
            entry, entry_kind = F.try_element_at(value, F.lit(key)), kind.valueType
        elif key in kind.names:
            entry, entry_kind = value[key], kind[key].dataType
        else:
            continue
        fits = _of_type(entry, entry_kind, expected, text_values=True)
        rules.append(F.when(entry.isNotNull() & ~fits, META_TYPE.format(field=key, type=expected)))
    return rules


def error_column(df: DataFrame, rules: Rules) -> Column:
    """Message of the first failing rule of a row, or NULL.

    Order: required, type, range, pattern, custom, vectors, metadata. Fields a
    frame does not have are skipped by every rule but the first.
    """
    have = set(df.columns)
    checks: list[Column] = [check_required(f, df) for f in rules.required_fields]
    checks += [
        check_type(f, t, df, rules.text_values) for f, t in rules.field_types.items() if f in have
    ]
    checks += [check_range(f, lo, hi) for f, (lo, hi) in rules.value_ranges.items() if f in have]
    checks += [check_pattern(f, p) for f, p in rules.patterns.items() if f in have]
    checks += [check_custom(f, t) for f, t in rules.custom_validators.items() if f in have]
    if rules.validate_vectors:
        checks += [check_vector(f, rules.vector_dimensions) for f in vector_columns(df)]
    if rules.validate_metadata and "metadata" in have:
        checks += check_metadata("metadata", rules.metadata_schema, df)
    return F.coalesce(*checks, F.lit(None).cast("string"))


def mark_errors(df: DataFrame, rules: Rules, out: str = "error") -> DataFrame:
    return df.withColumn(out, error_column(df, rules))


def validate_records(df: DataFrame, rules: Rules, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and one ``id, error`` row with ``Record i: message`` per bad one."""
    marked = mark_errors(df, rules, "_error")
    valid = marked.where(F.col("_error").isNull()).drop("_error")
    text = F.concat(F.lit("Record "), F.col(id_col).cast("string"), F.lit(": "), F.col("_error"))
    errors = marked.where(F.col("_error").isNotNull()).select(id_col, text.alias("error"))
    return valid, errors


def validation_summary(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows per message; valid rows are counted under NULL."""
    return mark_errors(df, rules).groupBy("error").agg(F.count("*").alias("n"))


def query_error(
    vector: str = "vector", top_k: str = "top_k", metric: str = "metric_type"
) -> Column:
    """First failing rule of a search request given as a row."""
    numbers = F.forall(F.col(vector), lambda x: x.isNotNull())
    return (
        F.when(F.col(vector).isNull(), NO_QUERY_VECTOR)
        .when(~numbers, NOT_NUMBERS)
        .when(F.col(top_k) <= 0, BAD_TOP_K)
        .when(~F.col(metric).isin(*METRICS), F.concat(F.lit(BAD_METRIC), F.col(metric)))
    )


def validate_vectors(
    df: DataFrame, dim: int, normalize: bool = False, vector_col: str = "vector"
) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector is usable, normalised on request, and the rejected ones."""
    error = F.coalesce(
        F.when(F.col(vector_col).isNull(), MISSING.format(field=vector_col)), check_vector(vector_col, dim)
    )
    marked = df.withColumn("error", error)
    good = marked.where(F.col("error").isNull()).drop("error")
    if normalize:
        good = good.withColumn(vector_col, vec_normalize(vector_col))
    return good, marked.where(F.col("error").isNotNull())


def check_varchar_length(name: str, limit: int = VARCHAR_LIMIT) -> Column:
    return F.when(F.length(name) > limit, TOO_LONG.format(field=name, limit=limit))
