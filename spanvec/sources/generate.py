"""Generated collections for trying things out at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def generate_vectors(seed_ids: DataFrame, dim: int, seed: int = 42, fields: int = 2) -> DataFrame:
    """Rows with a uniform [0, 1) vector and ``value_{i}_{j}`` metadata.

    Every number is a hash of (id, position, seed), so a row is the same under
    any partitioning and when a task is run again.
    """
    scale = float(1 << 53)

    def unit(position):
        bits = F.shiftrightunsigned(F.xxhash64(F.col("id"), position, F.lit(seed)), 11)
        return bits.cast("double") / F.lit(scale)

    positions = F.sequence(F.lit(0), F.lit(dim - 1))
    metadata = F.create_map(
        *[
            x
            for j in range(fields)
            for x in (
                F.lit(f"field_{j}"),
                F.concat(F.lit("value_"), F.col("id").cast("string"), F.lit(f"_{j}")),
            )
        ]
    )
    return seed_ids.select(
        "id", F.transform(positions, unit).alias("vector"), metadata.alias("metadata")
    )


def generate_collection(
    spark: SparkSession, rows: int, dim: int, seed: int = 42, fields: int = 2
) -> DataFrame:
    return generate_vectors(spark.range(rows), dim, seed, fields)
