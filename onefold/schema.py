"""Fixed schemas and the source priority shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Merge priority, best first. It is also the order in which sources are unioned.
SOURCE_PRIORITY = ("tmdb", "rotten_tomatoes", "kaggle", "imdb", "spark")

# Fields whose completeness the quality report watches.
CRITICAL_FIELDS = ("title", "year", "release_date")

# Public film genre dictionary (id -> name).
GENRE_NAMES = {
    28: "Action",
    12: "Adventure",
    16: "Animation",
    35: "Comedy",
    80: "Crime",
    99: "Documentary",
    18: "Drama",
    10751: "Family",
    14: "Fantasy",
    36: "History",
    27: "Horror",
    10402: "Music",
    9648: "Mystery",
    10749: "Romance",
    878: "Science Fiction",
    10770: "TV Movie",
    53: "Thriller",
    10752: "War",
    37: "Western",
}

# Genre rows every model starts with.
GENRE_SEED = [
    (27, "Horror"),
    (53, "Thriller"),
    (9648, "Mystery"),
    (878, "Science Fiction"),
    (28, "Action"),
    (18, "Drama"),
]

# Sources a rating may come from.
RATING_SOURCES = ("tmdb", "imdb", "rotten_tomatoes")

_L, _S, _D, _I = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType()
_LIST = T.ArrayType(T.StringType())


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


GOLD_SCHEMA = _struct(
    tmdb_id=_L,
    imdb_id=_S,
    title=_S,
    original_title=_S,
    original_language=_S,
    overview=_S,
    release_date=_S,
    year=_L,
    runtime_minutes=_L,
    poster_path=_S,
    popularity=_D,
    budget=_L,
    revenue=_L,
    tagline=_S,
    collection_name=_S,
    status=_S,
    tmdb_vote_average=_D,
    tmdb_vote_count=_L,
    imdb_average_rating=_D,
    imdb_num_votes=_L,
    overview_word_count=_L,
    rt_tomatometer=_L,
    rt_audience=_L,
    rt_critics_consensus=_S,
    genres=_LIST,
    keywords=_LIST,
    sources=_LIST,
)

LIST_FIELDS = ("genres", "keywords", "sources")
SCALAR_FIELDS = tuple(f.name for f in GOLD_SCHEMA if f.name not in LIST_FIELDS)

# Position of a record in the input: which source, then its natural key inside that source.
SEQ_TYPE = _struct(source_pos=_I, key=_S)

PARTIAL_SCHEMA = T.StructType(
    list(GOLD_SCHEMA.fields)
    + [
        T.StructField("source", _S, True),
        T.StructField("source_rank", _I, True),
        T.StructField("seq", SEQ_TYPE, True),
    ]
)

API_SCHEMA = _struct(
    tmdb_id=_L,
    title=_S,
    original_title=_S,
    original_language=_S,
    overview=_S,
    release_date=_S,
    vote_average=_D,
    vote_count=_L,
    popularity=_D,
    poster_path=_S,
    genre_ids=T.ArrayType(_I),
)

API_PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page", _I, True),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [T.StructField("id", _L, True)]
                    + [f for f in API_SCHEMA.fields if f.name != "tmdb_id"]
                )
            ),
            True,
        ),
    ]
)

TITLE_BASICS_SCHEMA = _struct(
    tconst=_S,
    titleType=_S,
    primaryTitle=_S,
    originalTitle=_S,
    startYear=_I,
    runtimeMinutes=_I,
    genres=_S,
)
TITLE_RATINGS_SCHEMA = _struct(tconst=_S, averageRating=_D, numVotes=_I)
RATINGS_EXTRACT_SCHEMA = _struct(
    tconst=_S,
    primaryTitle=_S,
    startYear=_I,
    runtimeMinutes=_I,
    genres=_S,
    averageRating=_D,
    numVotes=_I,
)

BULK_SCHEMA = _struct(
    id=_L,
    title=_S,
    original_title=_S,
    original_language=_S,
    overview=_S,
    tagline=_S,
    release_date=_S,
    popularity=_D,
    vote_count=_L,
    vote_average=_D,
    budget=_L,
    revenue=_L,
    runtime=_L,
    status=_S,
    genre_names=_S,
    collection_name=_S,
)
BULK_COLUMNS = tuple(BULK_SCHEMA.fieldNames())

TEXT_INPUT_SCHEMA = _struct(id=_S, title=_S, overview=_S)
TEXT_ENRICHMENT_SCHEMA = _struct(tmdb_id=_L, overview_word_count=_L, keywords=_LIST)

SCRAPED_SCHEMA = _struct(
    page_id=_L,
    title=_S,
    year=_L,
    genres=_LIST,
    tomatometer=_L,
    audience=_L,
    critics_consensus=_S,
)
