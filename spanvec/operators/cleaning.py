"""Cleaning and transformation of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.functions.vectors import vec_normalize
from spanvec.operators.joins import dedup_records
from spanvec.session import materialize

# Fixed value: rows further from the mean than this many deviations are outliers.
OUTLIER_CUT = 3.0


def _statistics(df: DataFrame, fields: Sequence[str]) -> dict[str, Any]:
    """Minimum, maximum, mean and deviation of each field: one row, one scan."""
    if not fields:
        return {}
    wanted = []
    for f in fields:
        value = F.col(f).cast("double")
        wanted += [
            F.min(value).alias(f"min_{f}"),
            F.max(value).alias(f"max_{f}"),
            F.avg(value).alias(f"avg_{f}"),
            F.stddev_samp(value).alias(f"dev_{f}"),
            F.count_if(value.isNull()).alias(f"nulls_{f}"),
        ]
    return df.agg(*wanted).first().asDict()


def fill_missing(df: DataFrame, values: Mapping[str, Any] | None = None) -> DataFrame:
    """NULLs to a given value, else the mean of a numeric field or an empty text.

    A field with NULLs that is filled with its mean becomes DOUBLE.
    """
    given = dict(values or {})
    open_fields = [f for f in df.schema.fields if f.name not in given]
    numeric = [f.name for f in open_fields if isinstance(f.dataType, T.NumericType)]
    means = _statistics(df, numeric)
    numeric = [f for f in numeric if means[f"nulls_{f}"]]
    for f in open_fields:
        if f.name in numeric and means[f"avg_{f.name}"] is not None:
            given[f.name] = means[f"avg_{f.name}"]
            df = df.withColumn(f.name, F.col(f.name).cast("double"))
        elif isinstance(f.dataType, T.StringType):
            given[f.name] = ""
        elif isinstance(f.dataType, T.BooleanType):
            given[f.name] = False
    return df.fillna(given) if given else df


def normalize_numeric(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Min-max scaling to [0, 1]; a constant field becomes 0."""
    s = _statistics(df, fields)

    def scaled(f: str) -> Column:
        low, high = s[f"min_{f}"], s[f"max_{f}"]
        value = F.col(f).cast("double")
        if low is None or high == low:
            return F.when(value.isNotNull(), F.lit(0.0))
        return (value - F.lit(low)) / F.lit(high - low)

    return df.withColumns({f: scaled(f) for f in fields})


def z_score(field: str, mean: float | None, deviation: float | None) -> Column:
    value = F.col(field).cast("double")
    if mean is None or not deviation:
        return F.when(value.isNotNull(), F.lit(0.0))
    return (value - F.lit(mean)) / F.lit(deviation)


def remove_outliers(df: DataFrame, fields: Sequence[str], cut: float = OUTLIER_CUT) -> DataFrame:
    """Rows within ``cut`` deviations of the mean in every field; NULL stays."""
    s = _statistics(df, fields)
    for f in fields:
        far = F.abs(z_score(f, s[f"avg_{f}"], s[f"dev_{f}"])) > cut
        df = df.where(~F.coalesce(far, F.lit(False)))
    return df


def clean_records(
    df: DataFrame,
    duplicates_on: Sequence[str] | None = None,
    fill: Mapping[str, Any] | None = None,
    normalize: Sequence[str] = (),
    outliers: Sequence[str] = (),
) -> DataFrame:
    """Deduplicate, fill, drop outliers, scale, in this order."""
    # Every step below reads statistics first, so the shuffle is done once.
    out = materialize(dedup_records(df, duplicates_on or df.columns))
    out = fill_missing(out, fill)
    out = remove_outliers(out, outliers) if outliers else out
    return normalize_numeric(out, normalize) if normalize else out


def rename_fields(df: DataFrame, mappings: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mappings))


def transform_records(
    df: DataFrame,
    mappings: Mapping[str, str] | None = None,
    vector_col: str = "vector",
    id_col: str = "id",
) -> DataFrame:
    """Renamed fields, ``normalized_vector``, the other fields as ``metadata``."""
    out = rename_fields(df, mappings or {})
    others = [c for c in out.columns if c not in (vector_col, id_col)]
    entries = [x for c in others for x in (F.lit(c), F.col(c).cast("string"))]
    return out.select(
        id_col,
        vector_col,
        vec_normalize(vector_col).alias("normalized_vector"),
        F.create_map(*entries).alias("metadata"),
    )
