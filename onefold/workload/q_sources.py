"""Scans, sources and sinks: tables are written in each format and read back whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from onefold.plans.adapters import collect_partials, empty_partials
from onefold.plans.model import load_statistics, normalise
from onefold.schema import API_PAGE_SCHEMA, BULK_SCHEMA, TEXT_INPUT_SCHEMA, TITLE_BASICS_SCHEMA, TITLE_RATINGS_SCHEMA
from onefold.session import scratch_path
from onefold.sources import readers, writers
from onefold.workload import roles
from onefold.workload.registry import big, listed, query
from onefold.workload.sqlkit import with_named

PAGE_SIZE = 20


@query("a1_json_scan", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def a1(t):
    path = scratch_path(t.spark, "json")
    writers.write_json(t.documents, path)
    df = readers.read_json(t.spark, path, t.documents.schema)
    return df.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query("a1_json_lists", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def a1_lists(t):
    """Files that each hold one list; a file that holds no list is refused."""
    path, other = scratch_path(t.spark, "json-lists"), scratch_path(t.spark, "json-object")
    writers.write_json_lists(t.documents, path, "doc_id")
    writers.write_json(t.documents.limit(1), other)
    try:
        readers.read_json(t.spark, other, t.documents.schema, one_array=True)
    except ValueError:
        df = readers.read_json(t.spark, path, t.documents.schema, one_array=True)
        return df.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")
    raise AssertionError("a file without a list was read")


@query("a2_json_sink", "SELECT count(*) AS lines, count(*) FILTER (WHERE text LIKE '%é%') AS with_accent FROM documents")
def a2(t):
    path = scratch_path(t.spark, "json")
    writers.write_json(t.documents, path)
    return t.spark.read.text(path).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("value").contains("é")).alias("with_accent")
    )


@query(
    "a3_dump_scan",
    with_named(
        "SELECT tconst, titleType, primaryTitle, startYear, runtimeMinutes, genres, averageRating, numVotes "
        "FROM basics JOIN rates USING (tconst)"
    ),
)
def a3(t):
    basics, ratings = scratch_path(t.spark, "basics"), scratch_path(t.spark, "ratings")
    writers.write_dump(roles.title_basics(t), basics)
    writers.write_dump(roles.title_ratings(t), ratings)
    b = readers.read_dump(t.spark, basics, TITLE_BASICS_SCHEMA)
    r = readers.read_dump(t.spark, ratings, TITLE_RATINGS_SCHEMA)
    return b.join(r, "tconst").drop("originalTitle")


_BULK = (
    "SELECT id, title, original_language, md5(overview) AS overview_md5, tagline, release_date, popularity, "
    "vote_average, budget, revenue, runtime, genre_names, collection_name FROM bulk_raw"
)


def _bulk_view(df):
    return df.select(
        "id",
        "title",
        "original_language",
        F.md5("overview").alias("overview_md5"),
        *["tagline", "release_date", "popularity", "vote_average", "budget", "revenue", "runtime"],
        "genre_names",
        "collection_name",
    )


@query("a4_csv_scan", with_named(_BULK))
def a4(t):
    path = scratch_path(t.spark, "csv")
    writers.write_csv(roles.bulk_raw(t), path)
    return _bulk_view(readers.read_csv(t.spark, path, BULK_SCHEMA))


@query("a5_csv_glob", "SELECT doc_id::VARCHAR AS id, md5(text) AS overview_md5 FROM documents")
def a5(t):
    path = scratch_path(t.spark, "parts")
    writers.write_parts(roles.text_input(t), path, 8, "id", ["id", "title", "overview"])
    df = readers.read_csv(t.spark, f"{path}/part=*/part-*.csv", TEXT_INPUT_SCHEMA)
    return df.select("id", F.md5("overview").alias("overview_md5"))


@query(
    "a6_parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R'",
)
def a6(t):
    df = readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet")
    return df.filter((F.col("l_quantity") >= 45) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(
    "a7_parquet_sink",
    with_named("SELECT tmdb_id, overview_word_count, array_to_string(keywords, '|') AS keywords FROM enrichment"),
)
def a7(t):
    from onefold.operators.keywords import text_enrichment

    path = scratch_path(t.spark, "parquet")
    writers.write_parquet(text_enrichment(roles.text_input(t)), path)
    return readers.read_parquet(t.spark, path).withColumns(listed("keywords"))


@query(
    "a8_csv_sink",
    with_named("SELECT tmdb_id, to_json(genre_ids)::VARCHAR AS genre_ids FROM api_clean"),
)
def a8(t):
    from onefold.operators.clean import clean_api

    path = scratch_path(t.spark, "lists")
    writers.write_csv(clean_api(roles.api_raw(t)).select("tmdb_id", "genre_ids"), path)
    return t.spark.read.schema("tmdb_id BIGINT, genre_ids STRING").csv(path, header=True, escape='"')


@query(
    "a9_split_parts",
    """SELECT (rn - 1) // ceil(total / 8.0)::BIGINT AS part, count(*) AS rows, min(id) AS first_id, max(id) AS last_id FROM
    (SELECT doc_id::VARCHAR AS id, row_number() OVER (ORDER BY doc_id::VARCHAR) AS rn, count(*) OVER () AS total
    FROM documents) GROUP BY 1""",
)
def a9(t):
    path = scratch_path(t.spark, "parts")
    for _ in range(2):  # the second write replaces the first
        writers.write_parts(roles.text_input(t), path, 8, "id", ["id", "title", "overview"])
    df = t.spark.read.schema("id STRING, title STRING, overview STRING, part BIGINT").csv(
        path, header=True, multiLine=True, escape='"'
    )
    return df.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    "a10_api_pages",
    with_named(f"SELECT id // {PAGE_SIZE} + 1 AS page, id, title, array_to_string(genre_ids, '|') AS genre_ids FROM api_raw"),
)
def a10(t):
    raw = roles.api_raw(t)
    schema = API_PAGE_SCHEMA["results"].dataType.elementType
    record = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    pages = raw.groupBy((F.floor(F.col("id") / PAGE_SIZE) + 1).alias("page")).agg(
        F.array_sort(F.collect_list(record)).alias("results")
    )
    path = scratch_path(t.spark, "pages")
    writers.write_json(pages, path)
    df = readers.flatten_pages(readers.read_json(t.spark, path, API_PAGE_SCHEMA))
    return df.select(big("page").alias("page"), "id", "title", F.array_join("genre_ids", "|").alias("genre_ids"))


_COUNTS = """SELECT 'movies' AS table_name, count(*) AS rows FROM numbered
    UNION ALL SELECT 'genres', count(*) FROM genre_dim
    UNION ALL SELECT 'movie_genres', count(*) FROM genre_rows
    UNION ALL SELECT 'movie_keywords', count(*) FROM keyword_rows
    UNION ALL SELECT 'ratings', count(*) FROM rating_rows
    UNION ALL SELECT 'sources_metadata', count(*) FROM source_rows"""


@query("a11_bulk_write", with_named(_COUNTS))
def a11(t):
    root = scratch_path(t.spark, "model")
    writers.publish(t.spark, normalise(roles.gold(t), ["first_seq"]), root)
    where = writers.current_snapshot(t.spark, root)
    names = ("movies", "genres", "movie_genres", "movie_keywords", "ratings", "sources_metadata")
    return load_statistics({n: t.spark.read.parquet(f"{where}/{n}") for n in names})


@query(
    "a12_write_once",
    "SELECT 'documents' AS kept, count(*) AS rows FROM documents UNION ALL SELECT 'forced', count(*) FROM pages",
)
def a12(t):
    path, forced = scratch_path(t.spark, "once"), scratch_path(t.spark, "forced")
    for target, force in ((path, False), (forced, True)):
        writers.write_once(t.documents.select(F.col("doc_id").alias("id")), target)
        writers.write_once(t.pages.select(F.col("page_id").alias("id")), target, force)
    counts = [
        t.spark.read.parquet(p).agg(F.lit(n).alias("kept"), F.count(F.lit(1)).alias("rows"))
        for n, p in (("documents", path), ("forced", forced))
    ]
    return reduce(lambda a, b: a.union(b), counts)


@query("a13_fresh_files", "SELECT count(*) AS fresh, 0::BIGINT AS stale FROM orders")
def a13(t):
    path = scratch_path(t.spark, "fresh")
    writers.write_parquet(t.orders, path)
    fresh = readers.read_fresh(t.spark, path, "parquet", t.orders.schema, days=7)
    stale = readers.read_fresh(t.spark, path, "parquet", t.orders.schema, days=-1)
    both = fresh.select(F.lit(1).alias("f")).union(stale.select(F.lit(0)))
    return both.agg(F.count_if(F.col("f") == 1).alias("fresh"), F.count_if(F.col("f") == 0).alias("stale"))


@query("a14_missing_source", with_named("SELECT source, count(*) AS rows FROM p_kaggle GROUP BY source"))
def a14(t):
    from onefold.operators.clean import clean_bulk

    there = collect_partials({"kaggle": clean_bulk(roles.bulk_raw(t))})
    absent = readers.missing_as_empty(
        t.spark, lambda: t.spark.read.parquet(f"{t.folder}/no_such_source.parquet"), empty_partials(t.spark).schema
    )
    return there.unionByName(absent).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
