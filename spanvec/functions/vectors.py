"""Vector algebra as Column expressions.

A vector is ``ARRAY<FLOAT>`` or ``ARRAY<DOUBLE>``; all arithmetic is DOUBLE.
A NULL vector gives NULL, and so does every quotient by a zero norm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v: Column | str) -> Column:
    return as_column(v).cast("array<double>")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside a lambda.

    A column named inside ``transform`` is evaluated again for each element;
    passing it as the single element of an array avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_once(udf):
    """A Python function Spark may not repeat in a filter derived from its result.

    A deterministic one is copied into every predicate on its column, which
    runs it again for each row.
    """
    return udf.asNondeterministic()


def vec_dim(v: Column | str) -> Column:
    c = as_column(v)
    return F.when(c.isNotNull(), F.size(c))


def vec_dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def vec_norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda s, x: s + x * x))


def vec_normalize(v: Column | str) -> Column:
    scaled = _bind(
        vec_norm(v),
        lambda n: F.when(n > 0, F.transform(as_double(v), lambda x: x / n)),
    )
    return scaled


def vec_cosine(a: Column | str, b: Column | str) -> Column:
    norms = vec_norm(a) * vec_norm(b)
    return F.when(norms > 0, vec_dot(a, b) / norms)


def vec_l2(a: Column | str, b: Column | str) -> Column:
    squares = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def vec_concat(*vectors: Column | str) -> Column:
    return F.concat(*[as_double(v) for v in vectors])


def vec_one_hot(position: Column | str, dim: int) -> Column:
    """A vector of length ``dim`` holding 1.0 at a 0-based position."""
    p = as_column(position)
    hot = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: (i == p).cast("double"))
    return F.when(p.isNotNull(), hot)


def vec_finite(v: Column | str) -> Column:
    """No NaN, no infinity and no NULL element."""
    good = F.forall(
        as_double(v),
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)),
    )
    return good


def vec_parse(text: Column | str) -> Column:
    """``"[0.1, 0.2]"`` to a vector; an unreadable literal gives NULL."""
    return F.from_json(as_column(text), "array<double>")


def similarity(distance: Column | str, metric: str) -> Column:
    """Bigger-is-better score of a distance column."""
    d = as_column(distance)
    return 1.0 / (1.0 + d) if metric == "L2" else d
