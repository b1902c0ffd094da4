"""Mutations as the new state of a collection; ``sources.tables`` publishes it."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.errors import SchemaError
from spanvec.functions.vectors import as_column
from spanvec.session import materialize


def _predicate(condition: Column | str) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def matches(condition: Column | str) -> Column:
    """The condition as a flag: NULL does not match."""
    return F.coalesce(_predicate(condition), F.lit(False))


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.where(~matches(condition))


def batch_delete(df: DataFrame, condition: Column | str) -> DataFrame:
    """Delete the ids a condition resolves to.

    The id is the primary key, so those are the matching rows themselves and
    no join is needed. ``anti_delete`` takes a list of ids from elsewhere.
    """
    return delete_where(df, condition)


def batch_update(df: DataFrame, condition: Column | str, changes: Mapping[str, Any]) -> DataFrame:
    """Set the named columns of matching rows; an unknown column is an error."""
    unknown = [c for c in changes if c not in df.columns]
    if unknown:
        raise SchemaError(f"unknown field: {', '.join(unknown)}")
    hit = matches(condition)
    value = {c: v if isinstance(v, Column) else F.lit(v) for c, v in changes.items()}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.when(hit, v.cast(kinds[c])).otherwise(as_column(c)) for c, v in value.items()}
    )


def absent_rows(changes: DataFrame, df: DataFrame, id_col: str = "id") -> DataFrame:
    """The changes whose id the collection does not hold.

    Only ids of the collection are read, and few changes are sent to it
    rather than shuffling it.
    """
    known = df.select(id_col).join(changes.select(id_col), id_col, "left_semi")
    return changes.join(known, id_col, "left_anti")


def like(rows: DataFrame, df: DataFrame) -> DataFrame:
    """Rows in the columns and types of a collection; absent columns are NULL."""
    extra = [c for c in rows.columns if c not in df.columns]
    if extra:
        raise SchemaError(f"unknown field: {', '.join(extra)}")
    return rows.select(
        [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def last_changes(changes: DataFrame, id_col: str = "id", order_by: str | None = None) -> DataFrame:
    """One change of each id: the last by ``order_by``, which is then dropped.

    Without an order an id that occurs twice with different fields fails the query;
    equal copies are one change. A change without an id adds a row of its own.
    """
    others = [c for c in changes.columns if c not in (id_col, order_by)]
    keyed, free = changes.where(F.col(id_col).isNotNull()), changes.where(F.col(id_col).isNull())
    fields = F.struct(*others) if others else F.struct(F.lit(1).alias("_one"))
    if order_by is not None:
        one = keyed.groupBy(id_col).agg(F.max_by(fields, F.col(order_by)).alias("c"))
    else:
        # Hashed, as some types cannot be compared.
        kind = F.xxhash64(F.to_json(fields, {"ignoreNullFields": "false"}))
        one = keyed.groupBy(id_col).agg(F.first(fields).alias("c"), F.min(kind).alias("a"), F.max(kind).alias("b"))
        twice = F.raise_error(F.concat(F.lit("two changes of id "), F.col(id_col).cast("string"))).cast("boolean")
        one = one.where(F.when(F.col("a") == F.col("b"), F.lit(True)).otherwise(twice))
    return one.select(id_col, *[F.col("c")[c].alias(c) for c in others]).unionByName(free.select(id_col, *others))


def replace_rows(df: DataFrame, changes: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of a collection with the fields of a change of equal id put in.

    ``changes`` holds an id once; columns it lacks keep their value.
    """
    old = df.alias("o")
    new = like(changes, df).withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(new, F.col(f"o.{id_col}") == F.col(f"n.{id_col}"), "left")

    def pick(f: str) -> Column:
        if f == id_col or f not in changes.columns:
            return F.col(f"o.{f}").alias(f)
        return F.when(F.col("n._new"), F.col(f"n.{f}")).otherwise(F.col(f"o.{f}")).alias(f)

    return joined.select([pick(f) for f in df.columns])


def upsert(df: DataFrame, changes: DataFrame, id_col: str = "id", order_by: str | None = None) -> DataFrame:
    """Replace rows of equal id by ``changes`` and add the new ones; the last change of an id counts.

    A full outer join would always shuffle the collection; a left join with
    the additions appended does not when the changes are few.
    """
    # Used twice; from files Spark also knows how few they are.
    changes = materialize(last_changes(changes, id_col, order_by))
    added = like(absent_rows(changes, df, id_col), df)
    return replace_rows(df, changes, id_col).unionByName(added)
