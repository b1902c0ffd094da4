"""File sources: every format gives one frame with a vector and metadata columns."""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.errors import SourceError
from spanvec.functions.vectors import vec_parse

VECTOR_TYPE = T.ArrayType(T.DoubleType())


@dataclass(frozen=True)
class SourceConfig:
    type: str
    path: str
    vector_field: str = "vector"
    metadata_fields: Sequence[str] | None = None
    schema: str | None = None
    """Types of the fields as Spark DDL; needed where a format holds none."""
    options: Mapping[str, str] = field(default_factory=dict)


def scan_project_fields(
    df: DataFrame,
    vector_field: str,
    metadata_fields: Sequence[str] | None = None,
    missing: str = "error",
) -> DataFrame:
    """The vector field and chosen metadata fields.

    A missing vector field is always an error. A missing metadata field is one
    too unless ``missing`` is ``"null"``, which gives a NULL column.
    """
    if vector_field not in df.columns:
        raise SourceError(f"vector field not found: {vector_field}")
    columns = [F.col(vector_field)]
    for name in metadata_fields or []:
        if name in df.columns:
            columns.append(F.col(name))
        elif missing == "null":
            columns.append(F.lit(None).cast("string").alias(name))
        else:
            raise SourceError(f"metadata field not found: {name}")
    return df.select(*columns)


def scan_parquet(spark: SparkSession, config: SourceConfig, missing: str = "error") -> DataFrame:
    df = spark.read.options(**config.options).parquet(config.path)
    return scan_project_fields(df, config.vector_field, config.metadata_fields, missing)


def scan_csv(spark: SparkSession, config: SourceConfig, missing: str = "error") -> DataFrame:
    """A vector column of literals ``"[0.1, 0.2]"``; an unreadable one is NULL."""
    reader = spark.read.option("header", True).option("escape", '"').options(**config.options)
    reader = reader.schema(config.schema) if config.schema else reader.option("inferSchema", True)
    df = scan_project_fields(
        reader.csv(config.path), config.vector_field, config.metadata_fields, missing
    )
    if isinstance(df.schema[config.vector_field].dataType, T.StringType):
        return df.withColumn(config.vector_field, vec_parse(config.vector_field))
    return df


def split_rejects(df: DataFrame, vector_field: str = "vector") -> tuple[DataFrame, DataFrame]:
    """Rows with a readable vector, and those without."""
    return df.where(F.col(vector_field).isNotNull()), df.where(F.col(vector_field).isNull())


def scan_json_records(spark: SparkSession, config: SourceConfig, missing: str = "error") -> DataFrame:
    """JSON arrays of objects, many files in parallel; JSON lines need no option."""
    reader = spark.read.option("multiLine", True).options(**config.options)
    reader = reader.schema(config.schema) if config.schema else reader
    return scan_project_fields(
        reader.json(config.path), config.vector_field, config.metadata_fields, missing
    )


def scan_json_columnar(spark: SparkSession, config: SourceConfig, missing: str = "error") -> DataFrame:
    """One JSON object per file holding whole columns, zipped to rows."""
    reader = spark.read.option("multiLine", True).options(**config.options)
    if config.schema:
        declared = T.StructType.fromDDL(config.schema)
        whole = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in declared.fields]
        reader = reader.schema(T.StructType(whole))
    wide = reader.json(config.path)
    wide = scan_project_fields(wide, config.vector_field, config.metadata_fields, missing)
    return wide.select(F.inline(F.arrays_zip(*wide.columns)))


def _columns_to_rows(columns: Mapping[str, Any], wanted: Sequence[str]) -> pd.DataFrame:
    out = {}
    for name in wanted:
        if name not in columns:
            raise SourceError(f"field not found: {name}")
        values = columns[name]
        out[name] = values.tolist() if isinstance(values, np.ndarray) else list(values)
    return pd.DataFrame(out)


def read_npz(content: bytes, wanted: Sequence[str]) -> pd.DataFrame:
    with np.load(io.BytesIO(content), allow_pickle=False) as archive:
        return _columns_to_rows({k: archive[k] for k in archive.files}, wanted)


def read_yaml(content: bytes, wanted: Sequence[str]) -> pd.DataFrame:
    data = yaml.safe_load(content)
    if isinstance(data, list):
        # As with JSON records, a record may lack a field.
        return pd.DataFrame([{name: row.get(name) for name in wanted} for row in data], columns=list(wanted))
    return _columns_to_rows(data, wanted)


def read_contents(
    files: DataFrame,
    config: SourceConfig,
    read: Callable[[bytes, Sequence[str]], pd.DataFrame],
) -> DataFrame:
    """Rows of whole files given as a ``content`` column.

    A file is read by one task; many files spread over many tasks.
    """
    declared = T.StructType.fromDDL(config.schema) if config.schema else T.StructType()
    kinds = {f.name: f.dataType for f in declared.fields}
    wanted = [config.vector_field, *(config.metadata_fields or [])]
    untyped = [n for n in wanted[1:] if n not in kinds]
    if untyped:
        raise SourceError(f"declare the type of: {', '.join(untyped)}")
    schema = T.StructType([T.StructField(n, kinds.get(n, VECTOR_TYPE)) for n in wanted])

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield read(content, wanted)

    return files.select("content").mapInPandas(run, schema)


def _whole_files(spark: SparkSession, config: SourceConfig) -> DataFrame:
    return spark.read.format("binaryFile").options(**config.options).load(config.path)


def scan_npz(spark: SparkSession, config: SourceConfig, missing: str = "error") -> DataFrame:
    return read_contents(_whole_files(spark, config), config, read_npz)


def scan_yaml(spark: SparkSession, config: SourceConfig, missing: str = "error") -> DataFrame:
    return read_contents(_whole_files(spark, config), config, read_yaml)


READERS = {
    "parquet": scan_parquet,
    "csv": scan_csv,
    "json": scan_json_records,
    "json_columnar": scan_json_columnar,
    "numpy": scan_npz,
    "npz": scan_npz,
    "yaml": scan_yaml,
}


def scan_by_config(
    spark: SparkSession, config: SourceConfig, missing: str = "error"
) -> DataFrame:
    """The scan named by the configuration's type, in any case."""
    reader = READERS.get(config.type.lower())
    if reader is None:
        raise ValueError(f"unsupported data source type: {config.type}")
    return reader(spark, config, missing)


def load_config(path: str) -> SourceConfig:
    """A source configuration from a small YAML or JSON file beside the job."""
    with open(path, encoding="utf-8") as handle:
        raw = json.load(handle) if path.endswith(".json") else yaml.safe_load(handle)
    known = {f for f in SourceConfig.__dataclass_fields__}
    return SourceConfig(**{k: v for k, v in raw.items() if k in known})
