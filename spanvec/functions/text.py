"""Text, JSON, name and key helpers as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanvec.functions.vectors import as_column

# Separator pattern of tokens, and the snapshot name stamp.
TOKEN_GAP = r"[^\p{L}\p{N}]+"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
STAMP_PATTERN = r"^(.*)_(\d{8}_\d{6})$"


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits, over the whole text."""
    return F.array_remove(F.split(F.lower(as_column(text)), TOKEN_GAP), "")


def split_terms(query: str) -> list[str]:
    """The distinct terms of a query, cut as ``tokens`` cuts a text."""
    return list(dict.fromkeys(re.findall(r"[^\W_]+", query.lower())))


def metadata_lines(text: Column | str) -> Column:
    """``key: value`` lines to a map.

    Lines without a colon are skipped, the split is at the first colon, keys
    are trimmed and lower-cased, and the last of several equal keys wins.
    """
    lines = F.filter(F.split(F.trim(as_column(text)), "\n"), lambda s: s.contains(":"))
    keys = F.transform(lines, lambda s: F.lower(F.trim(F.substring_index(s, ":", 1))))
    pairs = F.transform(
        lines,
        lambda s: F.struct(
            F.lower(F.trim(F.substring_index(s, ":", 1))).alias("key"),
            F.trim(F.substr(s, F.locate(":", s) + 1)).alias("value"),
        ),
    )
    backwards = F.reverse(pairs)
    last = F.transform(
        F.array_distinct(keys),
        lambda k: F.get(F.filter(backwards, lambda p: p["key"] == k), F.lit(0)),
    )
    return F.map_from_entries(last)


def label_score(payload: Column | str) -> Column:
    """Classifier output JSON to ``struct(category, score)``.

    Both field spellings, ``label``/``score`` and ``prediction``/``confidence``,
    are accepted.
    """
    parsed = F.from_json(
        as_column(payload), "label string, score double, prediction string, confidence double"
    )
    return F.struct(
        F.coalesce(parsed["label"], parsed["prediction"]).alias("category"),
        F.coalesce(parsed["score"], parsed["confidence"]).alias("score"),
    )


def json_parse(text: Column | str, schema: str) -> Column:
    return F.from_json(as_column(text), schema)


def json_render(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*[as_column(c) for c in columns]))


def map_lookup(metadata: Column | str, key: str) -> Column:
    return F.try_element_at(as_column(metadata), F.lit(key))


def request_key(operation: str, **parameters: Column) -> Column:
    """Stable hash of an operation and its parameters, sorted by name."""
    body = F.to_json(F.struct(*[parameters[n].alias(n) for n in sorted(parameters)]))
    return F.md5(F.concat(F.lit(operation + ":"), body))


def backup_name(collection: Column | str, at: Column | str) -> Column:
    return F.concat_ws("_", as_column(collection), F.date_format(as_column(at), STAMP_FORMAT))


def parse_backup_name(name: Column | str) -> Column:
    """``struct(collection, stamp)``; the collection may itself hold ``_``."""
    n = as_column(name)
    fits = n.rlike(STAMP_PATTERN)
    return F.struct(
        F.when(fits, F.regexp_extract(n, STAMP_PATTERN, 1)).alias("collection"),
        F.when(fits, F.regexp_extract(n, STAMP_PATTERN, 2)).alias("stamp"),
    )


def iso_timestamp(at: Column | str) -> Column:
    return F.date_format(as_column(at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def column_encrypt(value: Column | str, key: Column) -> Column:
    """Base64 text of the AES-GCM form; the key has 16, 24 or 32 bytes."""
    return F.base64(F.aes_encrypt(as_column(value).cast("binary"), key, F.lit("GCM")))


def column_decrypt(value: Column | str, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(as_column(value)), key, F.lit("GCM")).cast("string")
