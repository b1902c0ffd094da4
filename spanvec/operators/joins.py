"""Joins between collections and with outside records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.functions.compare import num_close, vec_close


def semi_select_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is listed. Spark broadcasts the list when it is small."""
    return df.join(ids.select(id_col), id_col, "left_semi")


def anti_delete(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is not listed."""
    return df.join(ids.select(id_col), id_col, "left_anti")


def enrich(df: DataFrame, records: DataFrame, on: str, marker: str = "enriched") -> DataFrame:
    """Left join of outside records; ``marker`` tells whether one was found."""
    marked = records.withColumn(marker, F.lit(True))
    return df.join(marked, on, "left").withColumn(marker, F.coalesce(marker, F.lit(False)))


def enrich_counts(enriched: DataFrame, keys: Sequence[str] = (), marker: str = "enriched") -> DataFrame:
    return enriched.groupBy(*keys).agg(
        F.count_if(F.col(marker)).alias("enriched_count"),
        F.count_if(~F.col(marker)).alias("failed_count"),
    )


def dedup_records(df: DataFrame, fields: Sequence[str], id_col: str | None = None) -> DataFrame:
    """One record of each set that agrees on ``fields``: the lowest id.

    Without ``id_col`` the records are equal in every field. Copies are
    combined before the shuffle, so many copies of one record move once per
    task.
    """
    if id_col is None:
        return df.dropDuplicates(list(fields))
    return df.groupBy(*fields).agg(F.min(id_col).alias(id_col))


def _is_vector(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType)


def _differs(name: str, kind: T.DataType, tolerance: float) -> Column:
    a, b = F.col(f"e.{name}"), F.col(f"a.{name}")
    if _is_vector(kind):
        same = vec_close(a, b, tolerance)
    elif isinstance(kind, T.NumericType):
        same = num_close(a, b, tolerance)
    elif isinstance(kind, T.MapType):
        # Maps have no equality; their sorted entries do.
        same = F.sort_array(F.map_entries(a)).eqNullSafe(F.sort_array(F.map_entries(b)))
    else:
        same = a.eqNullSafe(b)
    both_null = a.isNull() & b.isNull()
    return ~F.coalesce(same | both_null, both_null)


def diff_results(
    expected: DataFrame, actual: DataFrame, tolerance: float = 1e-6, id_col: str = "id"
) -> DataFrame:
    """One row per difference: ``id, field, message``, paired by id.

    A row on one side only is reported under the id field, and every other
    shared field is compared with the tolerance its type calls for. A field that
    the actual side lacks is reported for each row of both sides.
    """
    absent = [f.name for f in expected.schema.fields if f.name not in actual.columns]
    fields = [f for f in expected.schema.fields if f.name != id_col and f.name in actual.columns]
    e = expected.select(id_col, *[f.name for f in fields]).alias("e")
    a = actual.select(id_col, *[f.name for f in fields]).alias("a")
    key = F.coalesce(F.col(f"e.{id_col}"), F.col(f"a.{id_col}"))
    missing, extra = F.col(f"a.{id_col}").isNull(), F.col(f"e.{id_col}").isNull()

    def report(field: str, message: str) -> Column:
        return F.struct(F.lit(field).alias("field"), F.lit(message).alias("message"))

    reports = [F.when(missing, report(id_col, "missing")).when(extra, report(id_col, "unexpected"))]
    for f in fields:
        wrong = ~missing & ~extra & _differs(f.name, f.dataType, tolerance)
        reports.append(F.when(wrong, report(f.name, "mismatch")))
    reports += [F.when(~missing & ~extra, report(name, "absent")) for name in absent]
    joined = e.join(a, F.col(f"e.{id_col}") == F.col(f"a.{id_col}"), "full_outer")
    listed = joined.select(key.alias(id_col), F.array_compact(F.array(*reports)).alias("r"))
    return listed.select(id_col, F.inline("r"))


def same_results(differences: DataFrame) -> bool:
    """The verdict: whether no difference was found."""
    return differences.isEmpty()


def diff_summary(expected: DataFrame, actual: DataFrame, differences: DataFrame) -> DataFrame:
    """Row counts of both sides, differences per field, and the verdict, ``n`` = 1 if all is the same."""
    counts = differences.groupBy("field", "message").agg(F.count("*").alias("n"))
    sizes = [
        side.agg(F.count("*").alias("n")).select(
            F.lit("length").alias("field"), F.lit(name).alias("message"), "n"
        )
        for name, side in (("expected", expected), ("actual", actual))
    ]
    verdict = differences.agg((F.count("*") == 0).cast("bigint").alias("n")).select(
        F.lit("verdict").alias("field"), F.lit("same").alias("message"), "n"
    )
    return reduce(DataFrame.unionByName, [counts, *sizes, verdict])
