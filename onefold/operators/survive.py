"""Survivorship: one record per cluster from the best non-empty values of its members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.operators.fuzzy import THRESHOLD, YEAR_TOLERANCE, best_matches
from onefold.operators.links import with_cluster_key
from onefold.schema import GOLD_SCHEMA, LIST_FIELDS, SCALAR_FIELDS
from onefold.session import cut_lineage
from onefold.skew import lookup_join

_TEXT_FIELDS = {f.name for f in GOLD_SCHEMA if f.dataType.typeName() == "string"}


def _first_present(name: str) -> Column:
    """Smallest (rank, input position, value) among non-empty values; 0 is a value, '' is not."""
    present = f"{name} <> ''" if name in _TEXT_FIELDS else f"{name} IS NOT NULL"
    return F.expr(f"min(struct(source_rank, seq, {name} AS value)) FILTER (WHERE {present}) AS {name}")


def survivors(keyed: DataFrame) -> DataFrame:
    """One row per `cluster_key` with, for every scalar field, the surviving value and where it came from.

    Plain minima, so members are combined before the shuffle however large a cluster is, and rows of
    clusters that turn out to be the same thing can be combined again by the same minima.
    """
    return keyed.groupBy("cluster_key").agg(
        F.min("seq").alias("first_seq"),
        F.bool_or(F.col("tmdb_id").isNotNull()).alias("has_tmdb"),
        *[_first_present(name) for name in SCALAR_FIELDS],
    )


def representatives(keyed: DataFrame) -> DataFrame:
    """Title, year and whether a shared id is present, for each cluster; input to the fuzzy match."""
    return survivors(keyed).select(
        "cluster_key", "first_seq", "has_tmdb", F.col("title.value").alias("title"), F.col("year.value").alias("year")
    )


def _with_final_key(df: DataFrame, matches: DataFrame | None) -> DataFrame:
    """A matched floating cluster takes the key of its anchor; all others keep their own."""
    if matches is None:
        return df
    return (
        df.join(matches.select("cluster_key", "anchor_key"), "cluster_key", "left")
        .withColumn("cluster_key", F.coalesce("anchor_key", "cluster_key"))
        .drop("anchor_key")
    )


def merge_scalars(keyed: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """Surviving scalar values per final cluster."""
    state = survivors(keyed)
    if matches is not None:
        state = _with_final_key(state, matches)
        state = state.groupBy("cluster_key").agg(
            F.min("first_seq").alias("first_seq"), *[F.expr(f"min({name}) AS {name}") for name in SCALAR_FIELDS]
        )
    return state.selectExpr("cluster_key", "first_seq", *[f"{name}.value AS {name}" for name in SCALAR_FIELDS])


def merge_lists(keyed: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """Ordered unions of the list fields per final cluster.

    Items are reduced to their first appearance (rank, input position, place in the list) before
    anything is collected, so a task only ever holds the distinct items of a result row.
    """

    def tagged(name: str) -> Column:
        return F.transform(
            F.coalesce(F.col(name), F.array().cast("array<string>")),
            lambda x, i: F.struct(F.lit(name).alias("field"), i.alias("place"), x.alias("item")),
        )

    entries = keyed.select(
        "cluster_key", "source_rank", "seq", F.explode(F.concat(*[tagged(n) for n in LIST_FIELDS])).alias("e")
    )
    first = F.min(F.struct("source_rank", "seq", "e.place"))
    items = entries.groupBy("cluster_key", F.col("e.field").alias("field"), F.col("e.item").alias("item")).agg(
        first.alias("first_seen")
    )
    if matches is not None:
        items = (
            _with_final_key(items, matches)
            .groupBy("cluster_key", "field", "item")
            .agg(F.min("first_seen").alias("first_seen"))
        )
    return items.groupBy("cluster_key").agg(
        *[
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("field") == n, F.struct("first_seen", "item")))),
                lambda x: x["item"],
            ).alias(n)
            for n in LIST_FIELDS
        ]
    )


def merge_clusters(keyed: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """One full record per final cluster: `cluster_key`, `first_seq` and all unified fields."""
    scalars, lists = merge_scalars(keyed, matches), merge_lists(keyed, matches)
    empty = F.array().cast("array<string>")
    merged = scalars.join(lists, "cluster_key", "left").withColumns(
        {n: F.coalesce(F.col(n), empty) for n in LIST_FIELDS}
    )
    return merged.select("cluster_key", "first_seq", *GOLD_SCHEMA.fieldNames())


def match_clusters(
    keyed: DataFrame,
    threshold: int = THRESHOLD,
    tolerance: int = YEAR_TOLERANCE,
    nearest_year: bool = False,
) -> DataFrame:
    """Best anchor per floating cluster. The narrow table of representatives is read by several joins,
    so it is written once."""
    reps = cut_lineage(representatives(keyed))
    return best_matches(reps, threshold, tolerance, nearest_year)


def cluster_records(
    partials: DataFrame,
    threshold: int = THRESHOLD,
    tolerance: int = YEAR_TOLERANCE,
    nearest_year: bool = False,
) -> DataFrame:
    """Every partial with the `cluster_key` of the thing it describes.

    Matched clusters take the key of their anchor, floating clusters never link to each other.
    """
    keyed = with_cluster_key(partials)
    matches = match_clusters(keyed, threshold, tolerance, nearest_year).select("cluster_key", "anchor_key")
    return (
        lookup_join(keyed, matches, ["cluster_key"])
        .withColumn("cluster_key", F.coalesce("anchor_key", "cluster_key"))
        .drop("anchor_key")
    )


def reconcile(
    partials: DataFrame,
    threshold: int = THRESHOLD,
    tolerance: int = YEAR_TOLERANCE,
    nearest_year: bool = False,
) -> DataFrame:
    """Cluster and merge: one unified record per thing, with `cluster_key` and `first_seq`."""
    keyed = with_cluster_key(partials)
    matches = cut_lineage(match_clusters(keyed, threshold, tolerance, nearest_year))
    return merge_clusters(keyed, matches)
