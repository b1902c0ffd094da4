"""Stream messages: ``{vectors, metadata, operation, collection}``.

The same functions serve a stream and a static frame of message texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.operators.mutations import absent_rows

# The message schema, its defaults and the known operations.
MESSAGE = (
    "vectors array<array<double>>, metadata array<map<string,string>>, "
    "operation string, collection string"
)
DEFAULT_OPERATION = "insert"
DEFAULT_COLLECTION = "default"
OPERATIONS = ("insert", "update", "delete")


def _parsed(raw: DataFrame, value: str) -> DataFrame:
    m = F.from_json(F.col(value).cast("string"), MESSAGE)
    return raw.withColumn("m", m)


def _usable() -> Column:
    operation = F.coalesce(F.col("m.operation"), F.lit(DEFAULT_OPERATION))
    return F.coalesce(F.col("m.vectors").isNotNull() & operation.isin(*OPERATIONS), F.lit(False))


def stream_parse(raw: DataFrame, value: str = "value") -> DataFrame:
    """Messages with defaults filled in; the other columns of the frame stay."""
    others = [c for c in raw.columns if c != value]
    return _parsed(raw, value).where(_usable()).select(
        *others,
        F.col("m.vectors").alias("vectors"),
        F.col("m.metadata").alias("metadata"),
        F.coalesce("m.operation", F.lit(DEFAULT_OPERATION)).alias("operation"),
        F.coalesce("m.collection", F.lit(DEFAULT_COLLECTION)).alias("collection"),
    )


def stream_rejects(raw: DataFrame, value: str = "value") -> DataFrame:
    """Texts that are no message, or ask for an unknown operation."""
    unknown = F.col("m.vectors").isNotNull()
    reason = F.when(unknown, F.lit("unknown operation")).otherwise(F.lit("malformed message"))
    return _parsed(raw, value).where(~_usable()).select(*raw.columns, reason.alias("reason"))


def stream_explode(messages: DataFrame) -> DataFrame:
    """One row per vector with the metadata of its own position, else NULL."""
    others = [c for c in messages.columns if c not in ("vectors", "metadata")]
    placed = messages.select(*others, "metadata", F.posexplode("vectors").alias("pos", "vector"))
    own = F.try_element_at("metadata", F.col("pos") + 1)
    return placed.select(*others, "pos", "vector", own.alias("metadata"))


def render_messages(batches: DataFrame, operation: str, collection: str) -> DataFrame:
    """``vectors`` and ``metadata`` arrays to message texts for a topic."""
    body = F.struct(
        "vectors",
        "metadata",
        F.lit(operation).alias("operation"),
        F.lit(collection).alias("collection"),
    )
    return batches.select(F.to_json(body).alias("value"))


def latest_operations(rows: DataFrame, keys: str | list[str], *order: str) -> DataFrame:
    """The last operation of each key by ``order``.

    An aggregate rather than a window: copies of one id are combined before
    they move.
    """
    keys = [keys] if isinstance(keys, str) else keys
    others = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("l")).select(*keys, "l.*")


def fold_batches(rows: DataFrame, id_col: str, batch_col: str, fields: list[str]) -> DataFrame:
    """One operation per id that does what its operations of all batches do.

    ``rows`` holds an id once per batch. The last insert or delete of an id
    makes what came before it void; of the updates after it each field keeps
    its newest value.
    """
    op, at = F.col("operation"), F.col(batch_col)
    resets = rows.where(op.isin("insert", "delete")).groupBy(id_col).agg(F.max(at).alias("_reset"))
    valid = rows.join(resets, id_col, "left").where(F.col("_reset").isNull() | (at >= F.col("_reset")))
    # Where the order is NULL a row does not count.
    newest = [
        F.max_by(c, F.when(F.col(c).isNotNull() & (op != "delete"), at)).alias(c) for c in fields
    ]
    ends = [F.min_by(op, at).alias("_first"), F.max_by(op, at).alias("_last")]
    folded = valid.groupBy(id_col).agg(*newest, *ends)
    whole = (
        F.when(F.col("_last") == "delete", "delete")
        .when(F.col("_first") == "update", "update")
        .otherwise("insert")
    )
    return folded.withColumn("operation", whole).drop("_first", "_last")


def apply_operations(
    state: DataFrame, operations: DataFrame, id_col: str, fields: list[str]
) -> DataFrame:
    """The collection after the last operation of each id.

    Insert puts the given fields, update changes those of a row that is there,
    delete removes the row. Doing it twice gives the same state, so a replayed
    batch does no harm.
    """
    touched = [c for c in state.columns if c in fields]
    s, p = state.alias("s"), operations.alias("p")
    joined = s.join(p, F.col(f"s.{id_col}") == F.col(f"p.{id_col}"), "left")
    kept = joined.where(~F.coalesce(F.col("p.operation") == "delete", F.lit(False)))
    given = F.col(f"p.{id_col}").isNotNull()

    def value(c: str) -> Column:
        if c not in touched:
            return F.col(f"s.{c}").alias(c)
        # An update that does not name a field leaves it alone.
        partial = F.coalesce(f"p.{c}", f"s.{c}")
        new = F.when(F.col("p.operation") == "update", partial).otherwise(F.col(f"p.{c}"))
        return F.when(given, new).otherwise(F.col(f"s.{c}")).alias(c)

    puts = operations.where(F.col("operation") == "insert").select(id_col, *touched)
    added = absent_rows(puts, state, id_col)
    return kept.select([value(c) for c in state.columns]).unionByName(added, allowMissingColumns=True)
