"""Quality report on the unified table, in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.schema import CRITICAL_FIELDS


def duplicates(column: str) -> Column:
    """Rows with a value minus distinct values."""
    return F.count(column) - F.count_distinct(F.col(column))


def completeness(column: str) -> Column:
    """Share of rows with a value in percent, one decimal; null for an empty table."""
    return F.round(F.avg(F.col(column).isNotNull().cast("double")) * 100, 1)


def quality_report(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count(F.lit(1)).alias("total"),
        duplicates("tmdb_id").alias("duplicate_tmdb_id"),
        duplicates("imdb_id").alias("duplicate_imdb_id"),
        *[completeness(c).alias(f"completeness_{c}") for c in CRITICAL_FIELDS],
        F.count_if(F.size("sources") >= 2).alias("multi_source"),
    )


def link_loss(gold: DataFrame, keyed: DataFrame) -> DataFrame:
    """Own ids that no unified record shows: lost when several floating clusters share one anchor."""
    shown = gold.filter(F.col("imdb_id").isNotNull()).select("imdb_id").distinct()
    seen = keyed.filter(F.col("imdb_id") != "").select("imdb_id").distinct()
    return seen.join(shown, "imdb_id", "left_anti").agg(F.count(F.lit(1)).alias("hidden_imdb_ids"))
