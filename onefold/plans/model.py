"""The unified table as a normalised model of six tables, and the rules that model must keep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.functions.scalars import iso_date
from onefold.operators import checks
from onefold.operators.ids import dense_ids, first_appearance_ids
from onefold.schema import RATING_SOURCES
from onefold.session import cut_lineage

# Columns a movie takes over from the unified table, and their type in the model.
MOVIE_COLUMNS = {
    "tmdb_id": "bigint",
    "imdb_id": "string",
    "title": "string",
    "original_title": "string",
    "original_language": "string",
    "overview": "string",
    "tagline": "string",
    "runtime_minutes": "int",
    "budget": "bigint",
    "revenue": "bigint",
    "status": "string",
    "collection_name": "string",
    "popularity": "double",
    "poster_path": "string",
    "overview_word_count": "int",
}

# Longest text each column may hold.
MAX_LENGTHS = {
    "movies": {
        "imdb_id": 20,
        "title": 500,
        "original_title": 500,
        "original_language": 10,
        "status": 50,
        "collection_name": 300,
        "poster_path": 300,
    },
    "genres": {"name": 100},
    "movie_keywords": {"keyword": 100},
    "ratings": {"source": 50},
    "sources_metadata": {"source_name": 100},
}

TABLES = ("genres", "movies", "movie_genres", "movie_keywords", "ratings", "sources_metadata")


def movies(numbered: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return numbered.select(
        "id",
        *[F.col(c).cast(t).alias(c) for c, t in MOVIE_COLUMNS.items()],
        iso_date(F.col("release_date")).alias("release_date"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def genre_entries(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col("id").alias("movie_id"), F.posexplode("genres").alias("place", "name"))


def genres(numbered: DataFrame) -> DataFrame:
    """The dimension, numbered by first appearance; the public dictionary id is not known here."""
    ids = first_appearance_ids(genre_entries(numbered), "name", ["movie_id", "place"])
    return ids.select("id", F.lit(None).cast("int").alias("tmdb_genre_id"), "name")


def movie_genres(numbered: DataFrame, dimension: DataFrame) -> DataFrame:
    """The bridge. A genre may be on every film: AQE splits such a partition, and a dimension that turns
    out small at run time is broadcast by AQE."""
    return genre_entries(numbered).join(dimension.select(F.col("id").alias("genre_id"), "name"), "name").select(
        "movie_id", "genre_id"
    )


def movie_keywords(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col("id").alias("movie_id"), F.explode(F.array_distinct("keywords")).alias("keyword"))


def ratings(numbered: DataFrame) -> DataFrame:
    """Unpivot the score columns: one row per movie and source that has a score."""

    def entry(source: str, score: str, audience: str | None, votes: str | None, text: str | None) -> Column:
        def take(name, kind):
            return (F.col(name) if name else F.lit(None)).cast(kind)

        return F.struct(
            F.lit(source).alias("source"),
            take(score, "double").alias("score"),
            take(audience, "double").alias("audience_score"),
            take(votes, "bigint").alias("vote_count"),
            take(text, "string").alias("critics_consensus"),
        )

    any_rt = F.coalesce(F.col("rt_tomatometer"), F.col("rt_audience")).isNotNull() | F.col(
        "rt_critics_consensus"
    ).isNotNull()
    rows = F.array(
        F.when(F.col("tmdb_vote_average").isNotNull(), entry("tmdb", "tmdb_vote_average", None, "tmdb_vote_count", None)),
        F.when(F.col("imdb_average_rating").isNotNull(), entry("imdb", "imdb_average_rating", None, "imdb_num_votes", None)),
        F.when(any_rt, entry("rotten_tomatoes", "rt_tomatometer", "rt_audience", None, "rt_critics_consensus")),
    )
    return numbered.select(
        F.col("id").alias("movie_id"), F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")
    ).select("movie_id", "r.*")


def sources_metadata(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        F.col("id").alias("movie_id"),
        F.explode("sources").alias("source_name"),
        F.current_timestamp().alias("ingested_at"),
    )


def normalise(gold: DataFrame, order: list[str], surrogate_ids: bool = True) -> dict[str, DataFrame]:
    """Six tables, parents first. `order` is the unique key that numbers the movies.

    `surrogate_ids` also numbers ratings and provenance rows, as a database would.
    """
    numbered = cut_lineage(dense_ids(gold, order, "id"))
    dimension = cut_lineage(genres(numbered))
    facts = {"ratings": (ratings(numbered), ["movie_id", "source"]),
             "sources_metadata": (sources_metadata(numbered), ["movie_id", "source_name"])}
    if surrogate_ids:
        facts = {
            n: (dense_ids(df, key, "id").select("id", *df.columns), key) for n, (df, key) in facts.items()
        }
    return {
        "genres": dimension,
        "movies": movies(numbered),
        "movie_genres": movie_genres(numbered, dimension),
        "movie_keywords": movie_keywords(numbered),
        **{n: df for n, (df, _) in facts.items()},
    }


def load_statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.union(b), counts)


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All broken rules of the model; empty when it is sound."""
    t = tables
    found = [
        checks.unique(t["movies"], ["id"], "movies.id primary", primary=True),
        checks.unique(t["movies"], ["tmdb_id"], "movies.tmdb_id unique"),
        checks.unique(t["movies"], ["imdb_id"], "movies.imdb_id unique"),
        checks.not_null(t["movies"], "title", "movies.title not null"),
        checks.unique(t["genres"], ["id"], "genres.id primary", primary=True),
        checks.unique(t["genres"], ["name"], "genres.name unique"),
        checks.unique(t["genres"], ["tmdb_genre_id"], "genres.tmdb_genre_id unique"),
        checks.not_null(t["genres"], "name", "genres.name not null"),
        checks.unique(t["movie_genres"], ["movie_id", "genre_id"], "movie_genres primary", primary=True),
        checks.unique(t["movie_keywords"], ["movie_id", "keyword"], "movie_keywords primary", primary=True),
        checks.unique(t["ratings"], ["movie_id", "source"], "ratings unique"),
        checks.allowed(t["ratings"], "source", RATING_SOURCES, "ratings.source allowed"),
        checks.foreign_key(t["movie_genres"], "genre_id", t["genres"], "id", "movie_genres.genre_id refers"),
        *[
            checks.foreign_key(t[n], "movie_id", t["movies"], "id", f"{n}.movie_id refers")
            for n in ("movie_genres", "movie_keywords", "ratings", "sources_metadata")
        ],
        *[
            checks.max_length(t[n], c, size, f"{n}.{c} length")
            for n, limits in MAX_LENGTHS.items()
            for c, size in limits.items()
        ],
    ]
    return reduce(lambda a, b: a.unionByName(b), found)
