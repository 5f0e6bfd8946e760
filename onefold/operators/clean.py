"""Cleaning of the landed sources: one DataFrame query per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onefold.functions import scalars as S
from onefold.functions import text as X
from onefold.schema import API_SCHEMA, BULK_COLUMNS, RATINGS_EXTRACT_SCHEMA

THEME = "Horror"
MIN_VOTES = 1000
MIN_YEAR = 1970


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in `order`; null keys are equal to each other."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min_by(row, F.struct(*order)).alias("row")
    ).select("row.*")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key in `order`: the state after replacing on every repeat of a key."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max_by(row, F.struct(*order)).alias("row")
    ).select("row.*")


def map_api_fields(raw: DataFrame) -> DataFrame:
    """Whitelist and rename the API fields; a missing field is null, missing genre ids are an empty list."""
    have = set(raw.columns)
    if "id" not in have:
        raise ValueError("API records need a column id")
    picked = [F.col("id").cast("bigint").alias("tmdb_id")]
    for field in API_SCHEMA.fields[1:-1]:
        value = F.col(field.name) if field.name in have else F.lit(None)
        picked.append(value.cast(field.dataType).alias(field.name))
    ids = F.col("genre_ids") if "genre_ids" in have else F.lit(None)
    picked.append(F.coalesce(ids.cast("array<int>"), F.array().cast("array<int>")).alias("genre_ids"))
    return raw.select(*picked)


def normalize_records(records: DataFrame) -> DataFrame:
    """Overwrite the four fields that need it; every other field passes through."""
    return records.withColumns(
        {
            "title": X.normalize_text(F.col("title")),
            "overview": X.normalize_text(F.col("overview")),
            "original_title": X.normalize_text(F.col("original_title")),
            "release_date": S.normalize_date(F.col("release_date")),
        }
    )


def clean_api(raw: DataFrame) -> DataFrame:
    return normalize_records(map_api_fields(raw))


def ratings_extract(
    basics: DataFrame,
    ratings: DataFrame,
    theme: str = THEME,
    min_votes: int = MIN_VOTES,
    min_year: int = MIN_YEAR,
    kind: str = "movie",
    ordered: bool = True,
) -> DataFrame:
    """Films of the theme with enough votes, most votes first. The theme is matched without regard to case.

    A table that only feeds a merge does not need the global sort: `ordered=False`.
    """
    films = basics.filter(
        (F.col("titleType") == kind) & F.col("genres").ilike(f"%{theme}%") & (F.col("startYear") >= min_year)
    )
    rated = ratings.filter(F.col("numVotes") >= min_votes)
    found = films.join(rated, "tconst").select(*RATINGS_EXTRACT_SCHEMA.fieldNames())
    return found.orderBy(F.desc("numVotes"), "tconst") if ordered else found


def enrich_ratings(extract: DataFrame, theme: str = THEME, ordered: bool = True) -> DataFrame:
    """Typed years, rows without year or rating dropped, decade, genre and score columns; most votes first."""
    others = X.other_items(F.col("genres"), theme)
    enriched = (
        extract.withColumns(
            {
                "startYear": S.to_int(F.col("startYear")).cast("int"),
                "runtimeMinutes": S.to_int(F.col("runtimeMinutes")).cast("int"),
            }
        )
        .dropna(subset=["startYear", "averageRating", "numVotes"])
        .withColumns(
            {
                "decade": S.decade(F.col("startYear")),
                "is_pure_horror": X.is_only(F.col("genres"), theme),
                "sub_genres": others,
                "num_genres": F.size(others) + 1,
                "score": S.composite_score(F.col("averageRating"), F.col("numVotes")),
            }
        )
    )
    return enriched.orderBy(F.desc("numVotes"), "tconst") if ordered else enriched


def ratings_summary(enriched: DataFrame) -> DataFrame:
    """One row: films, first and last year, mean rating, films of the theme alone."""
    return enriched.agg(
        F.count(F.lit(1)).alias("films"),
        F.min("startYear").cast("bigint").alias("first_year"),
        F.max("startYear").cast("bigint").alias("last_year"),
        F.round(F.avg("averageRating"), 2).alias("mean_rating"),
        F.count_if("is_pure_horror").alias("pure_horror"),
    )


def clean_bulk(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Keep the 16 columns, the first row per title and raw release date, repair dates and sentinels.

    `order` names the columns that give the order of the input; by default the id.
    """
    order = order or ["id"]
    extra = [c for c in order if c not in BULK_COLUMNS]
    first = keep_first(raw.select(*BULK_COLUMNS, *extra), ["title", "release_date"], order)
    return first.select(*BULK_COLUMNS).withColumns(
        {
            "release_date": F.date_format(S.iso_date(F.col("release_date")), "yyyy-MM-dd"),
            **{c: S.na_to_null(F.col(c)) for c in ("collection_name", "tagline", "overview")},
            **{c: S.zero_to_null(F.col(c)) for c in ("budget", "revenue")},
        }
    )
