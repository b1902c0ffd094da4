"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanvec.session import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every end of ``x, y`` (BIGINT): the smallest id that links reach.

    Large-star and small-star in turn: each id hands its larger, then its smaller
    neighbours to its smallest one, until nothing moves. Neighbours are never
    gathered: the smallest is an aggregate that is joined back, so an id with most
    links is split like any skewed join key. Every round is a written table.
    """
    edges = materialize(links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    before = None
    while True:
        print_ = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("x", "y"), F.lit(1 << 40)))).first()
        if print_ == before or not print_[0]:
            break
        before = print_
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.unionByName(least.where("m < x").select("x", F.col("m").alias("y"))).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        had, edges = edges, materialize(small.unionByName(least.select("x", F.col("m").alias("y"))).distinct())
        discard(had)
    leaves = edges.groupBy("x").agg(F.min("y").alias("component"))
    roots = edges.select(F.col("y").alias("x")).distinct().join(leaves, "x", "left_anti")
    return leaves.select(F.col("x").alias("id"), "component").unionByName(
        roots.select(F.col("x").alias("id"), F.col("x").alias("component"))
    )
