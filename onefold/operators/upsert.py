"""Keyed writes as DataFrame queries: each returns the new content of the target table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onefold.operators.clean import keep_last


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """`target` plus the rows whose key it does not have; of rows with equal keys the least is inserted."""
    others = [c for c in rows.columns if c not in keys]
    if others:
        least = rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
        rows = least.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])
    else:
        rows = rows.distinct()
    return target.unionByName(rows.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert(
    target: DataFrame,
    rows: DataFrame,
    keys: list[str],
    fields: list[str],
    order: list[str],
    touched: str | None = None,
    created: str | None = None,
) -> DataFrame:
    """Update `fields` where the key exists, insert where it does not; the last row per key wins.

    `touched` names a timestamp column set to the current time on rows that were written, `created` one
    that is set only on inserted rows. Other columns of the target keep their value. Rows with a null key
    are not written; `load_counts` counts them as errors.
    """
    rows, _ = split_valid(rows, keys)
    news = keep_last(rows.select(*dict.fromkeys([*keys, *fields, *order])), keys, order)
    packed = news.select(*keys, F.struct(*fields).alias("_new"))
    both = target.withColumn("_old", F.lit(True)).join(packed, keys, "full")
    found = F.col("_new").isNotNull()

    def value(c: str):
        if c in keys:
            return F.col(c)
        if c in fields:
            return F.when(found, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c == touched:
            return F.when(found, F.current_timestamp()).otherwise(F.col(c)).alias(c)
        if c == created:
            return F.when(F.col("_old").isNull(), F.current_timestamp()).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return both.select(*[value(c) for c in target.columns])


def split_valid(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the others."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return rows.filter(ok), rows.filter(~ok)


def load_counts(rows: DataFrame, required: list[str]) -> DataFrame:
    """One row: how many records can be loaded and how many are errors."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return rows.agg(F.count_if(ok).alias("inserted_or_updated"), F.count_if(~ok).alias("errors"))


def upsert_ratings(ratings: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """Upsert on (movie, source); a row without a score changes nothing."""
    return upsert(
        ratings, rows.filter(F.col("score").isNotNull()), ["movie_id", "source"], ["score", "vote_count"], order
    )


def link_known(items: DataFrame, dimension: DataFrame, key: str, existing: DataFrame, link: list[str]) -> DataFrame:
    """Links to entries the dimension has, without those that exist already; unknown entries are skipped."""
    return items.join(dimension, key).select(*link).distinct().join(existing, link, "left_anti")


def delete_cascade(parents: DataFrame, children: dict[str, tuple[DataFrame, str]], gone: DataFrame, key: str = "id"):
    """Parents without the rows in `gone`, and every child table without rows of a deleted parent."""
    left = parents.join(gone.select(key), key, "left_anti")
    kept = {
        name: child.join(left.select(F.col(key).alias(ref)), ref, "left_semi")
        for name, (child, ref) in children.items()
    }
    return left, kept
