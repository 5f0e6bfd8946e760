"""Exact links: records that share an identifier, and the components those links form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from onefold.session import cut_lineage
from onefold.skew import lookup_join


def with_link_keys(partials: DataFrame) -> DataFrame:
    """Adds `shared_key` (0 is an id), `own_key` (an empty id is none) and `row_key`.

    A key value is the centre of a star around its records, so no pairs are ever formed.
    """
    return partials.withColumns(
        {
            "shared_key": F.concat(F.lit("t:"), F.col("tmdb_id").cast("string")),
            "own_key": F.when(F.col("imdb_id") != "", F.concat(F.lit("i:"), F.col("imdb_id"))),
            "row_key": F.concat_ws(":", F.lit("r"), F.col("seq.source_pos").cast("string"), F.col("seq.key")),
        }
    )


def link_groups(partials: DataFrame, key: str) -> DataFrame:
    """Groups that share one id column: its value, the first record in input order, the group size."""
    present = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    return partials.filter(present).groupBy(key).agg(
        F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("members")
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, component)` for every node of `edges(a, b)`; a component is named by its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al. 2014). Every round takes minima with
    map-side partial aggregation, and its edges are written to the checkpoint folder, so the plan stays
    short. The driver only sees a count and a checksum per round, taken while the edges are written; while they are
    too few for any node to be hot, a round is that one job.
    """
    first = (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    edges, before = _written(first)
    while True:
        edges, after = _written(_small_star(_large_star(edges, 2 * before[0]), 2 * before[0]))
        if after == before:
            break
        before = after
    return (
        edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
        .union(edges.select("a", "a"))
        .distinct()
    )


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, and their number and checksum as the write itself saw them."""
    seen = Observation()
    watched = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    )
    return cut_lineage(watched), (seen.get["n"], seen.get["h"])


def _large_star(edges: DataFrame, ends: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it. No node has more than `ends` edges."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    nearest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter(F.col("v") > F.col("u"))
    return lookup_join(larger, nearest, ["u"], rows_per_key=ends).select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame, ends: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. No node has more than `ends` edges."""
    nearest = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = lookup_join(edges, nearest, ["b"], rows_per_key=ends).filter(F.col("a") != F.col("m")).select("m", "a")
    return moved.union(nearest.select("m", "b")).toDF("a", "b").distinct()


def with_cluster_key(partials: DataFrame) -> DataFrame:
    """Adds `cluster_key`: records linked by either id, also transitively, get the same one.

    Only key values that meet in one record need the component rounds; a record with a single id
    already carries the name of its cluster.
    """
    keyed = with_link_keys(partials)
    bridges = (
        keyed.filter(F.col("shared_key").isNotNull() & F.col("own_key").isNotNull())
        .select(F.col("shared_key").alias("a"), F.col("own_key").alias("b"))
        .distinct()
    )
    own = F.coalesce("shared_key", "own_key", "row_key")
    columns = [*partials.columns, "cluster_key"]
    keyed = keyed.withColumn("cluster_key", own)
    if bridges.isEmpty():
        return keyed.select(*columns)
    components = connected_components(bridges).select(F.col("node").alias("cluster_key"), "component")
    return (
        lookup_join(keyed.select(*columns), components, ["cluster_key"])
        .withColumn("cluster_key", F.coalesce("component", "cluster_key"))
        .select(*columns)
    )
