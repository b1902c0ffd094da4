"""Tool-call linking and canonical JSON, by DataFrame functions only.

Calls and results of a conversation are joined on their identifier. Arguments are
parsed as JSON and checked against the schema of the tool. A call whose arguments
name ``$result:<identifier>`` needs that call's result; levels order the calls so
that each comes after all it needs. Calls and results are written as canonical
JSON: sorted keys, no white space.

An identifier is one row of the result, however often it occurs: repeated calls and
results are counted and the first by turn, then by content, stands for them. So a
repeated identifier never multiplies rows, and no conversation is gathered.

Defined results for odd input: a row without conversation or identifier links with
nothing, and all such rows of a conversation count as one; a result without a call
and a call without a result are reported; arguments that are NULL, empty or no
JSON object are an error and are not written; a need that names no call of its
conversation is counted and not waited for; calls on or behind a circle have no
level; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.session import materialize

KEY = ["conv_id", "call_id"]
NEED = r'"\$result:([^"\\]+)"'
#: JSON type names and the types that parsed values have.
TYPES = {"string": "STRING", "integer": "BIGINT|DECIMAL\\(\\d+,0\\)", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}


@dataclass(frozen=True)
class Param:
    """A parameter of a tool; bounds hold for numbers, for strings they bound the length."""

    type: str
    required: bool = True
    least: int | None = None
    most: int | None = None


Schemas = dict[str, dict[str, Param]]


def _first_error(name: Column, parsed: Column, arguments: Column, schemas: Schemas) -> Column:
    """The first fault of a call's arguments, parameters in order of their names; NULL if there is none."""
    keys = F.json_object_keys(arguments)
    checks = [F.when(parsed.isNull() | keys.isNull(), F.lit("arguments: not a JSON object")), F.when(~F.coalesce(name.isin(*schemas), F.lit(False)), F.lit("name: no such tool"))]
    for tool, params in sorted(schemas.items()):
        of_tool = name == tool
        known = F.array(*[F.lit(p) for p in params]).cast("array<string>")
        strange = F.array_min(F.array_except(keys, known))
        for key, param in sorted(params.items()):
            value = F.variant_get(parsed, f"$['{key}']", "variant")
            kind = F.schema_of_variant(value)
            absent = value.isNull() | (kind == "VOID")
            if param.required:
                checks.append(F.when(of_tool & absent, F.lit(f"{key}: missing")))
            checks.append(F.when(of_tool & ~absent & ~kind.rlike(f"^({TYPES[param.type]})$"), F.lit(f"{key}: not of type {param.type}")))
            as_text = F.try_variant_get(parsed, f"$['{key}']", "string")
            size = F.length(as_text) if param.type == "string" else as_text.cast("double")
            if param.least is not None:
                checks.append(F.when(of_tool & (size < param.least), F.lit(f"{key}: below {param.least}")))
            if param.most is not None:
                checks.append(F.when(of_tool & (size > param.most), F.lit(f"{key}: above {param.most}")))
        checks.append(F.when(of_tool & strange.isNotNull(), F.concat(strange, F.lit(": no such parameter"))))
    return F.coalesce(*checks)


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """``conv_id, call_id``, the first call and result, how many there are, and ``status``.

    ``calls`` has ``conv_id, call_id, turn, name, arguments``, ``results`` ``conv_id, call_id, turn, content``.
    """
    asked = calls.groupBy(*KEY).agg(F.count("*").alias("n_calls"), F.min(F.struct("turn", "name", "arguments")).alias("call"))
    answered = results.groupBy(*KEY).agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("result"))
    both = asked.join(answered, KEY, "full")
    status = (
        F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), F.lit("no identifier"))
        .when(F.col("n_calls").isNull(), F.lit("result without call"))
        .when(F.col("n_results").isNull(), F.lit("call without result"))
        .when((F.col("n_calls") > 1) | (F.col("n_results") > 1), F.lit("repeated identifier"))
        .otherwise(F.lit("linked"))
    )
    return both.select(*KEY, F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"), status.alias("status"), "call", "result")


def levels(needs: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, call_id, level``: 0 for calls that need none, else one more than the highest they need.

    ``needs`` has ``conv_id, call_id, need``. A round for each level; calls of a circle are left out.
    """
    todo = materialize(needs)
    free = ids.join(todo.select(*KEY).distinct(), KEY, "left_anti").select(*KEY, F.lit(0).alias("level"))
    done = materialize(free)
    while not todo.isEmpty():
        have = done.select("conv_id", F.col("call_id").alias("need"), "level")
        met = todo.join(have, ["conv_id", "need"], "left").groupBy(*KEY).agg(F.count("level").alias("met"), F.count("*").alias("all"), (F.max("level") + 1).alias("level"))
        new = materialize(met.where(F.col("met") == F.col("all")).select(*KEY, "level"))
        if new.isEmpty():
            break
        done = done.unionByName(new)
        todo = materialize(todo.join(new, KEY, "left_anti"))
    return done


def format_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """A row for each identifier: link, order, first fault, and canonical JSON of call and result."""
    linked = materialize(link(calls, results))
    named = linked.where("n_calls > 0 and conv_id is not null and call_id is not null")
    wants = named.select(*KEY, F.explode(F.array_distinct(F.regexp_extract_all("call.arguments", F.lit(NEED), F.lit(1)))).alias("need"))
    ids = named.select(*KEY)
    known = wants.join(ids.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi").select(*KEY, "need")
    unknown = wants.join(ids.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_anti").groupBy(*KEY).agg(F.count("*").alias("unknown"))
    ordered = levels(known, ids)
    out = linked.join(ordered, KEY, "left").join(unknown, KEY, "left")
    parsed = F.try_parse_json("call.arguments")
    # A JSON text is parsed and written once; only objects are arguments.
    error = F.when(F.col("n_calls") > 0, _first_error(F.col("call.name"), parsed, F.col("call.arguments"), schemas))
    is_object = F.json_object_keys("call.arguments").isNotNull()
    call = F.to_json(F.struct(F.when(is_object, parsed).alias("arguments"), F.col("call_id").alias("id"), F.col("call.name").alias("name")))
    result = F.to_json(F.struct(F.col("result.content").alias("content"), F.col("call_id").alias("tool_call_id")))
    return out.select(
        *KEY, "status", "n_calls", "n_results", "level", F.coalesce("unknown", F.lit(0)).alias("n_unknown_needs"), error.alias("error"),
        F.when(F.col("n_calls") > 0, call).alias("call_json"), F.when(F.col("n_results") > 0, result).alias("result_json"),
    )


def in_order(formatted: DataFrame) -> DataFrame:
    """Conversations with their calls in an order that their needs allow, those without a level last."""
    return formatted.orderBy("conv_id", F.asc_nulls_last("level"), "call_id")
