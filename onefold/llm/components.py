"""Connected components of an edge table of long node ids, by alternating star contraction.

A large-star step ties every neighbour above a node to the least node around it, a small-star step does
the same for the neighbours below. Both only need minima, which combine before they are shuffled.
Every round is written to the shared folder once; its row count and checksum are observed by that
write, and the rounds end when neither changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from onefold.session import scratch_path


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    spark, seen = edges.sparkSession, Observation()
    path = scratch_path(spark, "stars")
    edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).write.parquet(path)
    found = seen.get
    return spark.read.schema("u bigint, v bigint").parquet(path), (found["n"], found["x"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` point down: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    tied = edges.join(least, "u").filter(F.col("v") > F.col("least"))
    return least.select("u", F.col("least").alias("v")).union(tied.select(F.col("v").alias("u"), "least")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node that has an edge; root is the least node that it can reach.

    `edges` has long columns `u, v` in any order and direction; loops count for nothing.
    """
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    stars, before = _written(down)
    while before[0]:
        stars, after = _written(_small_star(_large_star(stars)))
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
