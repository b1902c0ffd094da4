"""Collections: declared schema, conforming rows, partitions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.functions.vectors import as_double
from spanvec.operators.quality import VARCHAR_LIMIT, check_varchar_length, check_vector

# Type names of metadata fields; any other name is VARCHAR.
FIELD_TYPES = {
    "int": T.LongType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int16": T.ShortType(),
    "int8": T.ByteType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "str": T.StringType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "json": T.VariantType(),
}


@dataclass(frozen=True)
class CollectionSpec:
    name: str
    dim: int
    metadata_fields: Sequence[tuple[str, str]] = field(default_factory=list)
    metric_type: str = "L2"
    index_type: str = "IVF_FLAT"
    nlist: int = 1024

    def schema(self) -> T.StructType:
        """``id, vector`` and the metadata columns in declared order."""
        fields = [
            T.StructField("id", T.LongType()),
            T.StructField("vector", T.ArrayType(T.FloatType()), True, {"dim": self.dim}),
        ]
        for name, kind in self.metadata_fields:
            fields.append(T.StructField(name, FIELD_TYPES.get(kind.lower(), T.StringType())))
        return T.StructType(fields)


def _converted(name: str, kind: T.DataType, have: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        if isinstance(have, T.StringType):
            return F.try_parse_json(name)
        return F.to_variant_object(name) if not isinstance(have, T.VariantType) else F.col(name)
    if name == "vector":
        return F.col(name).cast("array<float>")
    return F.col(name).try_cast(kind)


def conform_collection(df: DataFrame, spec: CollectionSpec) -> tuple[DataFrame, DataFrame]:
    """Rows brought to the declared schema, and the rows that do not fit it.

    A row is rejected with its first reason: a vector that is missing, of the
    wrong dimension or not finite, a value that is not of the declared type, a
    text over the VARCHAR limit.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    absent = F.lit("Missing required field: vector")
    reasons = [F.when(F.col("vector").isNull(), absent), check_vector("vector", spec.dim)]
    columns = []
    for f in spec.schema().fields:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata or {}))
            continue
        value = _converted(f.name, f.dataType, have[f.name])
        columns.append(value.alias(f.name, metadata=f.metadata or {}))
        if f.name != "vector":
            misfit = F.col(f.name).isNotNull() & value.isNull()
            kind = f.dataType.simpleString()
            reasons.append(F.when(misfit, f"Invalid type for field {f.name}: expected {kind}"))
        if isinstance(f.dataType, T.StringType) and isinstance(have[f.name], T.StringType):
            reasons.append(check_varchar_length(f.name, VARCHAR_LIMIT))
    marked = df.withColumn("error", F.coalesce(*reasons))
    fits = marked.where(F.col("error").isNull()).select(*columns)
    return fits, marked.where(F.col("error").isNotNull())


def partition_name(prefix: str, value: Column | str) -> Column:
    """``category_A`` from the value ``A``."""
    return F.concat(F.lit(prefix + "_"), F.col(value) if isinstance(value, str) else value)


def assign_partition(
    df: DataFrame, name: Column, catalog: DataFrame, out: str = "partition_name"
) -> tuple[DataFrame, DataFrame]:
    """Rows routed to declared partitions, and those that name none.

    ``catalog`` is the partition table: ``name, description, tags``. Spark
    broadcasts it when it is small.
    """
    routed = df.withColumn(out, name)
    names = catalog.select(F.col("name").alias(out))
    return routed.join(names, out, "left_semi"), routed.join(names, out, "left_anti")


def drop_partition(df: DataFrame, partition_col: str, names: Sequence[object]) -> DataFrame:
    return df.where(~F.coalesce(F.col(partition_col).isin(list(names)), F.lit(False)))


def compact_report(before: DataFrame, after: DataFrame, folder: str | None = None) -> DataFrame:
    """Rows and files of a table before and after it was rewritten.

    All parts of a folder that is named as ``folder`` are one file.
    """
    file = F.input_file_name()
    if folder is not None:
        part_of = f"/{folder}/"
        file = F.when(F.locate(part_of, file) > 0, F.substring_index(file, part_of, 1)).otherwise(file)

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select(file.alias("file")).groupBy("file").agg(
            F.count("*").alias("n")
        ).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("file_count")
        ).select(F.lit(name).alias("state"), "row_count", "file_count")

    return reduce(DataFrame.unionByName, [counted(before, "before"), counted(after, "after")])


def concat_modalities(left: Column | str, right: Column | str) -> Column:
    """The vector of an item from its vectors per modality."""
    return F.concat(as_double(left), as_double(right))
