"""Tolerance comparison: ``abs(a - b) <= ATOL + tolerance * abs(b)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanvec.functions.vectors import as_column, as_double

# Fixed value: the absolute part of the tolerance.
ATOL = 1e-8


def num_close(a: Column | str, b: Column | str, tolerance: float = 1e-6) -> Column:
    x, y = as_column(a).cast("double"), as_column(b).cast("double")
    return F.abs(x - y) <= F.lit(ATOL) + F.lit(tolerance) * F.abs(y)


def vec_close(a: Column | str, b: Column | str, tolerance: float = 1e-6) -> Column:
    """Same length and every element close; NULL when either side is NULL."""
    near = F.zip_with(
        as_double(a), as_double(b), lambda x, y: F.coalesce(num_close(x, y, tolerance), F.lit(False))
    )
    return (F.size(as_column(a)) == F.size(as_column(b))) & F.forall(near, lambda ok: ok)
