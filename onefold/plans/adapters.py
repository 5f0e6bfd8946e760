"""From each clean source to partial records of the one canonical schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onefold.functions import scalars as S
from onefold.functions import text as X
from onefold.schema import GENRE_NAMES, PARTIAL_SCHEMA, SOURCE_PRIORITY


def source_rank(source: Column) -> Column:
    """Place in the priority list; an unknown source comes last."""
    at = F.array_position(F.lit(list(SOURCE_PRIORITY)), source)
    return F.when(at > 0, at - 1).otherwise(len(SOURCE_PRIORITY)).cast("int")


def sort_key(value: Column) -> Column:
    """Text that sorts like the number it was made from; other text stays."""
    text = value.cast("string")
    return F.when(text.rlike(r"^\d{1,20}$"), F.lpad(text, 20, "0")).otherwise(text)


def key_parts(columns: list[str], natural: Column) -> tuple[Column, Column]:
    """The key a record has before equal ones are numbered, and the hash of the whole record that orders those.

    Records without a natural key, or with a blank one, are known by the hash and come last. Both parts are taken
    before any shuffle, so that columns which only they need, whole texts among them, stay behind.
    """
    record = F.xxhash64(*columns)
    text = sort_key(natural)
    base = F.when(F.trim(text) != "", text).otherwise(F.concat(F.lit("~"), F.hex(record), F.hex(F.hash(*columns))))
    return base, record


def row_key(base: Column, record: Column) -> Column:
    """A key that is never null and unique within a source, as text that sorts like the natural key.

    Equal keys are numbered from the second on. So no two records ever fall together by their key.
    """
    nth = F.row_number().over(Window.partitionBy(base).orderBy(record))
    return F.when(nth == 1, base).otherwise(F.concat(base, F.lit("~"), nth.cast("string")))


def to_partials(clean: DataFrame, source: str, key: Column, fields: dict[str, Column]) -> DataFrame:
    """Project to the partial schema; fields the source does not have are null, lists are empty.

    `key` orders the source's records; it may be null, blank or repeated.
    """
    known = source in SOURCE_PRIORITY
    rank = F.lit(SOURCE_PRIORITY.index(source) if known else len(SOURCE_PRIORITY))
    empty = F.expr("CAST(array() AS ARRAY<STRING>)")
    lists = {n: F.coalesce(fields[n], empty) if n in fields else empty for n in ("genres", "keywords")}
    values = {**fields, **lists, "sources": F.array(F.lit(source)), "source": F.lit(source), "source_rank": rank}
    base, record = key_parts(clean.columns, key)
    rows = clean.select(*[v.alias(n) for n, v in values.items()], base.alias("_base"), record.alias("_record"))
    seq = F.struct(rank.alias("source_pos"), row_key(F.col("_base"), F.col("_record")).alias("key")).alias("seq")
    return rows.select(*values, seq).to(PARTIAL_SCHEMA)


def tmdb_partials(clean: DataFrame, key: str = "tmdb_id") -> DataFrame:
    c = F.col
    return to_partials(
        clean,
        "tmdb",
        c(key),
        {
            **{n: c(n) for n in ("tmdb_id", "title", "original_title", "original_language", "overview", "release_date")},
            "year": S.year_of_iso(c("release_date")),
            "poster_path": c("poster_path"),
            "popularity": S.to_float(c("popularity")),
            "tmdb_vote_average": S.to_float(c("vote_average")),
            "tmdb_vote_count": S.to_int(c("vote_count")),
            "genres": X.names_of(c("genre_ids"), GENRE_NAMES),
        },
    )


def imdb_partials(clean: DataFrame, key: str = "tconst") -> DataFrame:
    c = F.col
    year = S.to_int(c("startYear"))
    return to_partials(
        clean,
        "imdb",
        c(key),
        {
            "imdb_id": F.nullif(c("tconst"), F.lit("")),
            "title": F.nullif(c("primaryTitle"), F.lit("")),
            "year": year,
            "release_date": S.year_start(year),
            "runtime_minutes": S.to_int(c("runtimeMinutes")),
            "imdb_average_rating": S.to_float(c("averageRating")),
            "imdb_num_votes": S.to_int(c("numVotes")),
            "genres": X.split_list(c("genres")),
        },
    )


def kaggle_partials(clean: DataFrame, key: str = "id") -> DataFrame:
    c = F.col
    text = ("title", "original_title", "original_language", "overview", "release_date")
    return to_partials(
        clean,
        "kaggle",
        c(key),
        {
            "tmdb_id": S.to_int(c("id")),
            **{n: c(n) for n in (*text, "tagline", "collection_name", "status")},
            "year": S.year_of_iso(c("release_date")),
            "runtime_minutes": S.to_int(c("runtime")),
            "budget": S.to_int(c("budget")),
            "revenue": S.to_int(c("revenue")),
            "genres": X.split_list(c("genre_names")),
        },
    )


def rotten_partials(clean: DataFrame, key: str = "page_id") -> DataFrame:
    """Scraped records carry no key of their own; `key` is used where the table has it."""
    c = F.col
    return to_partials(
        clean,
        "rotten_tomatoes",
        c(key) if key in clean.columns else F.lit(None).cast("string"),
        {
            "title": c("title"),
            "year": S.to_int(c("year")),
            "rt_tomatometer": S.to_int(c("tomatometer")),
            "rt_audience": S.to_int(c("audience")),
            "rt_critics_consensus": c("critics_consensus"),
            "genres": c("genres"),
        },
    )


def text_partials(clean: DataFrame, key: str = "tmdb_id") -> DataFrame:
    c = F.col
    return to_partials(
        clean,
        "spark",
        c(key),
        {
            "tmdb_id": S.to_int(c("tmdb_id")),
            "overview_word_count": S.to_int(c("overview_word_count")),
            "keywords": c("keywords"),
        },
    )


ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "tmdb": tmdb_partials,
    "rotten_tomatoes": rotten_partials,
    "kaggle": kaggle_partials,
    "imdb": imdb_partials,
    "spark": text_partials,
}


def collect_partials(clean: dict[str, DataFrame], sources: list[str] | None = None) -> DataFrame:
    """Union of the partials of the wanted sources, in priority order; all that are there by default.

    An unknown name is an error; a known source that was not ingested contributes nothing.
    """
    unknown = [s for s in sources or () if s not in ADAPTERS]
    if unknown:
        raise ValueError(f"unknown source: {', '.join(unknown)}")
    wanted = [s for s in ADAPTERS if s in clean and (sources is None or s in sources)]
    if not wanted:
        raise ValueError("no source to collect from")
    return reduce(lambda a, b: a.unionByName(b), [ADAPTERS[s](clean[s]) for s in wanted])


def empty_partials(spark) -> DataFrame:
    return spark.createDataFrame([], PARTIAL_SCHEMA)
