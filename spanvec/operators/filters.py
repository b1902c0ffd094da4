"""Filters as Column predicates; Spark pushes them into the scan."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.errors import SearchError
from spanvec.functions.vectors import as_column

# Comparison operators of a condition.
COMPARISONS = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


@dataclass(frozen=True)
class Condition:
    field_name: str
    operator: str
    value: Any


@dataclass(frozen=True)
class FilterSpec:
    conditions: Sequence[Condition] = field(default_factory=list)
    logical_operator: str = "and"


def compare(field_name: str, op: str, value: Any) -> Column:
    """One condition with a typed literal; ``in`` takes a list."""
    name = op.lower()
    if name == "in":
        return F.col(field_name).isin(list(value))
    if name not in COMPARISONS:
        raise SearchError(f"unknown filter operator: {op}")
    return COMPARISONS[name](F.col(field_name), F.lit(value))


def combine(predicates: Sequence[Column], logical_operator: str = "and") -> Column | None:
    """Predicates joined with ``and`` or ``or``; none given means no filter."""
    joined = {"and": operator.and_, "or": operator.or_}
    if logical_operator.lower() not in joined:
        raise SearchError(f"unknown logical operator: {logical_operator}")
    if not predicates:
        return None
    return reduce(joined[logical_operator.lower()], predicates)


def predicate(spec: FilterSpec) -> Column | None:
    return combine(
        [compare(c.field_name, c.operator, c.value) for c in spec.conditions], spec.logical_operator
    )


def apply_filter(df: DataFrame, condition: Column | str | None) -> DataFrame:
    """``where`` that takes a Column, a Spark SQL boolean text, or nothing."""
    return df if condition is None else df.where(condition)


def equals_fields(scalar_fields: Sequence[str], **given: Any) -> Column | None:
    """Equality on those scalar fields that were given a value."""
    return combine([F.col(f) == F.lit(given[f]) for f in scalar_fields if f in given])


def in_partitions(partition_col: str, names: Sequence[Any]) -> Column:
    return F.col(partition_col).isin(list(names))


def instant(value: datetime | Column) -> Column:
    """A literal that leaves the compared column as it is, so it can be pushed down.

    A time without zone is a wall-clock time, one with a zone is an instant.
    """
    if isinstance(value, Column):
        return value
    if value.tzinfo is not None:
        return F.lit(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def between_dates(date_field: str, start: datetime, end: datetime) -> Column:
    return F.col(date_field).between(instant(start), instant(end))


def in_time(
    date_field: str, start: datetime | None = None, end: datetime | None = None
) -> Column | None:
    """Optional bounds, inclusive at both ends."""
    at = F.col(date_field)
    bounds = [at >= instant(start)] if start is not None else []
    bounds += [at <= instant(end)] if end is not None else []
    return combine(bounds)


def metadata_matches(metadata: Column | str, wanted: Mapping[str, Any]) -> Column | None:
    """Map entries equal to a value, or to one of a list; all keys must match."""
    held = as_column(metadata)
    tests = []
    for key, value in wanted.items():
        entry = held[key]
        many = isinstance(value, (list, tuple))
        tests.append(entry.isin([str(v) for v in value]) if many else entry == F.lit(str(value)))
    return combine(tests)


def json_matches(text: Column | str, wanted: Mapping[str, Any]) -> Column | None:
    """``metadata_matches`` on a JSON text column."""
    tests = []
    for key, value in wanted.items():
        entry = F.get_json_object(as_column(text), f"$.{key}")
        many = isinstance(value, (list, tuple))
        tests.append(entry.isin([str(v) for v in value]) if many else entry == F.lit(str(value)))
    return combine(tests)


def score_window(score: str, low: float = 0.0, high: float = 1.0) -> Column:
    return F.col(score).between(low, high)


def has_prefix(name: str, collection: str) -> Column:
    return F.col(name).startswith(collection + "_")
