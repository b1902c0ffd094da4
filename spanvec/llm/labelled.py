"""Shared by the classifiers: the held-out fold, bounded samples, batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0; a row without an id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def texts_of(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Rows in runs of bounded text, one row at least, with their texts."""
    for batch in batches:
        begin, size = 0, 0
        sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(column)]
        for i, n in enumerate(sizes):
            if i > begin and size + n > most_bytes:
                part = batch.slice(begin, i - begin)
                yield part, part.column(column).to_pylist()
                begin, size = i, 0
            size += n
        if batch.num_rows > begin:
            part = batch.slice(begin)
            yield part, part.column(column).to_pylist()


def sample_ids(ids: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` of the rows of ``doc_id, ...``, the same ones in each run."""
    return ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)
