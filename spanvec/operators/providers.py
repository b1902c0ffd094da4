"""Plug point for batch functions: embeddings, extracted metadata, user maps.

A provider is built once per task from a factory and is then called with one
Arrow batch of items at a time. Items never leave their task, so the order
and the pairing of rows stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.functions.text import label_score, metadata_lines, tokens
from spanvec.functions.vectors import run_once

TextEmbedder = Callable[[Sequence[str]], np.ndarray]
TextProvider = Callable[[Sequence[str]], Sequence[str]]
ItemFunction = Callable[[pd.DataFrame], pd.DataFrame]


def hashed_tokens(lists: pa.Array, dim: int) -> np.ndarray:
    """Counts of hashed tokens per row, scaled to norm 1; no tokens gives NaN.

    The position of a token is the first eight hex digits of its MD5 modulo
    ``dim``, so every engine gives the same vector. Each distinct token of a
    batch is hashed once.
    """
    words = lists.flatten().dictionary_encode()
    place = np.array(
        [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim for w in words.dictionary.to_pylist()],
        dtype=np.int64,
    )
    lengths = lists.value_lengths().fill_null(0).to_numpy()
    row = np.repeat(np.arange(len(lists)), lengths)
    cells = row * dim + place[words.indices.to_numpy()]
    counts = np.bincount(cells, minlength=len(lists) * dim).reshape(len(lists), dim)
    norms = np.sqrt((counts * counts).sum(1, keepdims=True))
    return np.divide(counts, norms, out=np.full(counts.shape, np.nan), where=norms > 0)


def vectors_to_arrow(block: np.ndarray) -> pa.Array:
    """A matrix as a list column; a row with a NaN is NULL."""
    rows, dim = block.shape
    offsets = np.arange(0, (rows + 1) * dim, dim, dtype=np.int32)
    missing = pa.array(np.isnan(block).any(axis=1))
    return pa.ListArray.from_arrays(offsets, pa.array(block.ravel()), mask=missing)


def embed_text(
    df: DataFrame,
    text_col: str,
    dim: int,
    provider: Callable[[], TextEmbedder] | None = None,
    out: str = "vector",
    where: Column | str | None = None,
) -> DataFrame:
    """The frame with a vector per text, of the rows that ``where`` selects.

    A later filter does not reach the scan: name the rows here, or store the result first.

    A provider gets the texts of a batch and returns a (texts, dim) matrix.
    Without one the vector counts the hashed tokens of the whole text.
    """

    df = df if where is None else df.where(where)

    def hashed(lists: pa.Array) -> pa.Array:
        return vectors_to_arrow(hashed_tokens(lists, dim))

    def asked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        call = provider()
        for batch in batches:
            block = np.asarray(call(batch.to_pylist()), dtype=np.float64)
            if block.shape != (len(batch), dim):
                raise ValueError(f"the provider gave {block.shape}, not {(len(batch), dim)}")
            yield vectors_to_arrow(block)

    if provider is None:
        return df.withColumn(out, run_once(F.arrow_udf(hashed, "array<double>"))(tokens(text_col)))
    return df.withColumn(out, run_once(F.arrow_udf(asked, "array<double>"))(F.col(text_col)))


def call_provider(
    df: DataFrame, text_col: str, provider: Callable[[], TextProvider], out: str = "answer"
) -> DataFrame:
    """The frame with the provider's text answer to each text."""

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = provider()
        for batch in batches:
            yield pd.Series(list(call(batch.tolist())), dtype="object")

    return df.withColumn(out, run_once(F.pandas_udf(ask, "string"))(F.col(text_col)))


def extract_metadata(
    df: DataFrame, text_col: str, provider: Callable[[], TextProvider], out: str = "metadata"
) -> DataFrame:
    """``key: value`` answers of a provider as a map per row."""
    asked = call_provider(df, text_col, provider, "_answer")
    return asked.withColumn(out, metadata_lines("_answer")).drop("_answer")


def classify_text(
    df: DataFrame, text_col: str, provider: Callable[[], TextProvider], out: str = "category"
) -> DataFrame:
    """Classifier answers (JSON) of a provider as category and score."""
    asked = call_provider(df, text_col, provider, "_answer")
    return asked.withColumn(out, label_score("_answer")).drop("_answer")


def map_items(df: DataFrame, function: ItemFunction, schema: T.StructType | str) -> DataFrame:
    """A user function over batches of rows; an exception fails the query."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
