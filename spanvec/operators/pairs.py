"""Products of given pairs of vectors: a table of pairs decides what is compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanvec.functions.vectors import as_double, vec_cosine, vec_dot, vec_l2
from spanvec.operators.search import METRICS, check_metric

_PRODUCT = {"L2": vec_l2, "IP": vec_dot, "COSINE": vec_cosine}


def _free(name: str, taken: Sequence[str]) -> str:
    low = {t.lower() for t in taken}
    while name in low:
        name += "_"
    return name


def pair_products(
    pairs: DataFrame,
    first: DataFrame,
    second: DataFrame,
    metrics: Sequence[str] = METRICS,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """The pairs ``i, j``, with their other columns, and one column per metric in lower case.

    Both sides meet the pairs on their ids, so neither has to fit one task and no other
    pairs are made; an id that many pairs name is a skewed join key, which Spark splits
    on the side of the pairs. Repeated pairs stay. A pair with a NULL or unknown id, a NULL vector or
    vectors of two lengths gives NULL, as does a zero norm under COSINE. An id with several
    vectors gives a row for each.
    """
    wanted = [check_metric(m) for m in metrics]
    x = _free("x", pairs.columns)
    y = _free("y", [*pairs.columns, x])
    own = first.select(F.col(id_col).alias("i"), as_double(vector_col).alias(x))
    other = second.select(F.col(id_col).alias("j"), as_double(vector_col).alias(y))
    met = pairs.join(own, "i", "left").join(other, "j", "left")
    alike = F.size(x) == F.size(y)
    values = [F.when(alike, _PRODUCT[m](x, y)).alias(m.lower()) for m in wanted]
    return met.select(*pairs.columns, *values)
