"""Metadata fields derived from content."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanvec.functions.vectors import as_column


def category_by_substring(
    text: Column | str, categories: Mapping[str, str], default: str = "other"
) -> Column:
    """The category of the first listed substring found in the lower-cased text."""
    lowered = F.lower(as_column(text))
    out = None
    for part, category in categories.items():
        found = lowered.contains(part)
        out = F.when(found, category) if out is None else out.when(found, category)
    return F.lit(default) if out is None else out.otherwise(default)


def text_length(text: Column | str) -> Column:
    return F.length(as_column(text)).cast("bigint")
