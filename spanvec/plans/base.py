"""Registry of the queries over the given tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = " ".join(sql.split("\n")).strip()
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, vector, label`` from the embeddings table."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def r6(c: Column | str) -> Column:
    """Rounded so that both engines print the same number; never -0."""
    value = F.col(c) if isinstance(c, str) else c
    return F.round(value, 6) + F.lit(0.0)


def hits(df: DataFrame, *more: str) -> DataFrame:
    return df.select("query_id", "rank", "id", r6("distance").alias("distance"), *more)
