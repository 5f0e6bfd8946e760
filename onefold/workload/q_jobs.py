"""The composite jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onefold.operators import checks
from onefold.operators import clean as C
from onefold.operators.keywords import text_enrichment
from onefold.operators.pages import clean_scraped, page_records, tag_text
from onefold.operators.survive import cluster_records, reconcile
from onefold.operators.upsert import delete_cascade, load_counts, upsert, upsert_ratings
from onefold.plans import model
from onefold.plans.run import run
from onefold.schema import GOLD_SCHEMA, LIST_FIELDS
from onefold.session import scratch_path
from onefold.sources import readers, writers
from onefold.workload import roles
from onefold.workload.q_aggregates import REPORT
from onefold.workload.q_sources import _COUNTS
from onefold.workload.registry import big, listed, query
from onefold.workload.sqlkit import gold_columns, with_named

c = F.col


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*GOLD_SCHEMA.fieldNames()).withColumns(listed(*LIST_FIELDS))


@query(
    "j1_text_enrichment",
    with_named("SELECT tmdb_id, overview_word_count, array_to_string(keywords, '|') AS keywords FROM enrichment"),
)
def j1(t):
    return text_enrichment(roles.text_input(t)).withColumns(listed("keywords"))


@query(
    "j2_page_records",
    with_named(
        """SELECT page_id, title, year, array_to_string(genres, '|') AS genres, tomatometer, audience, critics_consensus
        FROM scraped"""
    ),
)
def j2(t):
    return page_records(roles.scraped_pages(t)).withColumns(listed("genres"))


def _field(name: str, sql: str):
    return with_named(f"SELECT page_id, {sql} AS {name} FROM scraped")


@query("j2a_page_title", _field("title", "title"))
def j2a(t):
    return page_records(roles.scraped_pages(t)).select("page_id", "title")


@query("j2b_page_year", _field("year", "year"))
def j2b(t):
    return page_records(roles.scraped_pages(t)).select("page_id", "year")


@query("j2c_critic_score", _field("tomatometer", "tomatometer"))
def j2c(t):
    return page_records(roles.scraped_pages(t)).select("page_id", "tomatometer")


@query("j2d_audience_score", _field("audience", "audience"))
def j2d(t):
    return page_records(roles.scraped_pages(t)).select("page_id", "audience")


@query("j2e_consensus", _field("critics_consensus", "critics_consensus"))
def j2e(t):
    return page_records(roles.scraped_pages(t)).select("page_id", "critics_consensus")


@query(
    "j2_plain_pages",
    with_named("SELECT page_id, lang, title, title AS heading FROM page_base"),
)
def j2_plain(t):
    """The same extraction on the pages as they are, without the review site's markup."""
    return roles.page_base(t).select("page_id", "lang", "title", tag_text(c("html"), "h1").alias("heading"))


@query(
    "j2_page_references",
    with_named(
        """SELECT page_id, chr((65 + page_id % 26)::INT) || chr((960 + page_id % 9)::INT) || ' é & &lt; €∉ ¬it; &nosuch; '
            || lang || ' © <b> "' || chr((128512 + page_id % 40)::INT) || '"' AS title FROM page_base"""
    ),
)
def j2_references(t):
    """Numeric, hexadecimal, named, short, unknown and doubled references, each resolved once."""
    number = lambda base, size: c("page_id") % size + base
    parts = [
        F.lit("<title>&#"), number(65, 26).cast("string"), F.lit(";&#x"), F.hex(number(960, 9)),
        F.lit("; &eacute; &amp; &amp;lt; &#128;&notin; &notit; &nosuch; "), c("lang"),
        F.lit(" &copy &lt;b&gt; &quot;&#X"), F.lower(F.hex(number(128512, 40))), F.lit(";&#34;</title>"),
    ]
    marked = roles.page_base(t).select("page_id", F.concat(*parts).alias("html"))
    return marked.select("page_id", tag_text(c("html"), "title").alias("title"))


@query(
    "j3_clean_scraped",
    with_named(
        """SELECT page_id, title, year, array_to_string(genres, '|') AS genres, tomatometer, audience, critics_consensus
        FROM scraped_clean"""
    ),
)
def j3(t):
    return clean_scraped(page_records(roles.scraped_pages(t))).withColumns(listed("genres"))


@query("j4_ratings_extract", with_named("SELECT * FROM extract"))
def j4(t):
    return C.ratings_extract(roles.title_basics(t), roles.title_ratings(t))


@query(
    "j5_ratings_enrich",
    with_named(
        """SELECT tconst, startYear, averageRating, numVotes, decade, is_pure_horror, array_to_string(sub_genres, '|') AS sub_genres,
        num_genres::INT AS num_genres, score FROM enriched"""
    ),
)
def j5(t):
    df = C.enrich_ratings(C.ratings_extract(roles.title_basics(t), roles.title_ratings(t), ordered=False))
    columns = ["tconst", "startYear", "averageRating", "numVotes", "decade", "is_pure_horror", "sub_genres", "num_genres", "score"]
    return df.select(*columns).withColumns(listed("sub_genres"))


_BULK = [f for f in C.BULK_COLUMNS if f != "overview"]


@query("j6_bulk_clean", with_named(f"SELECT {', '.join(_BULK)}, md5(overview) AS overview FROM bulk_clean"))
def j6(t):
    return C.clean_bulk(roles.bulk_raw(t)).select(*_BULK, F.md5("overview").alias("overview"))


@query(
    "j7_api_clean",
    with_named(
        """SELECT tmdb_id, title, original_title, md5(overview) AS overview, release_date, vote_average, vote_count, popularity,
        poster_path, array_to_string(genre_ids, '|') AS genre_ids FROM api_clean"""
    ),
)
def j7(t):
    df = C.clean_api(roles.api_raw(t)).drop("original_language")
    return df.withColumns({"overview": F.md5("overview"), "genre_ids": F.array_join("genre_ids", "|")})


@query("j8_cluster", with_named("SELECT cluster_key, min(seq) AS first_seq, count(*) AS members FROM final GROUP BY 1"))
def j8(t):
    seq = F.min("seq")
    return cluster_records(roles.partials(t)).groupBy("cluster_key").agg(
        F.concat_ws(":", seq["source_pos"], seq["key"]).alias("first_seq"), F.count(F.lit(1)).alias("members")
    )


@query("j9_reconcile", with_named(f"SELECT cluster_key, {gold_columns()} FROM unified"))
def j9(t):
    return reconcile(roles.partials(t)).drop("first_seq").withColumns(listed(*LIST_FIELDS))


@query("j10_build_gold", with_named(f"SELECT {gold_columns()} FROM gold"))
def j10(t):
    return _flat(roles.gold(t))


def _model(t, **options):
    return model.normalise(roles.gold(t), ["first_seq"], **options)


_KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}
_MOVIES = ", ".join(f"{n}::{_KINDS[k]} AS {n}" for n, k in model.MOVIE_COLUMNS.items())


@query("j11_movies", with_named(f"SELECT id, {_MOVIES}, try_strptime(release_date, '%Y-%m-%d')::DATE AS release_date FROM numbered"))
def j11(t):
    return _model(t, surrogate_ids=False)["movies"].drop("created_at", "updated_at")


@query("j11a_genres", with_named("SELECT id, name FROM genre_dim"))
def j11a(t):
    return _model(t, surrogate_ids=False)["genres"].select("id", "name")


@query(
    "j11a_movie_genres",
    with_named("SELECT movie_id, d.id AS genre_id FROM genre_rows JOIN genre_dim d USING (name)"),
)
def j11a_bridge(t):
    return _model(t, surrogate_ids=False)["movie_genres"]


@query("j11b_movie_keywords", with_named("SELECT movie_id, keyword FROM keyword_rows"))
def j11b(t):
    return _model(t, surrogate_ids=False)["movie_keywords"]


@query(
    "j11c_ratings",
    with_named("SELECT row_number() OVER (ORDER BY movie_id, source) AS id, * FROM rating_rows"),
)
def j11c(t):
    return _model(t)["ratings"]


@query(
    "j11d_sources_metadata",
    with_named("SELECT row_number() OVER (ORDER BY movie_id, source_name) AS id, * FROM source_rows"),
)
def j11d(t):
    return _model(t)["sources_metadata"].drop("ingested_at")


@query("j12_idempotent_rebuild", with_named(_COUNTS))
def j12(t):
    """Published twice: readers find the second snapshot, with the counts of one load."""
    root = scratch_path(t.spark, "rebuild")
    tables = _model(t, surrogate_ids=False)
    for _ in range(2):
        writers.publish(t.spark, tables, root)
    where = writers.current_snapshot(t.spark, root)
    return model.load_statistics({n: t.spark.read.parquet(f"{where}/{n}") for n in model.TABLES})


_SEVEN = ["title", "original_title", "overview", "release_date", "popularity", "poster_path"]


@query(
    "j13_upsert_movies",
    with_named(
        """SELECT coalesce(m.doc_id, a.tmdb_id) AS tmdb_id, CASE WHEN a.tmdb_id IS NULL THEN m.title ELSE a.title END AS title,
        a.original_title, md5(CASE WHEN a.tmdb_id IS NULL THEN m.text ELSE a.overview END) AS overview,
        CASE WHEN regexp_full_match(a.release_date, '\\d{4}-\\d{2}-\\d{2}') THEN a.release_date::DATE END AS release_date,
        a.popularity, a.poster_path, m.source AS status, a.tmdb_id IS NOT NULL AS written
        FROM (SELECT * FROM docs WHERE lang IN ('en', 'fr')) m FULL JOIN (SELECT * FROM api_clean) a ON a.tmdb_id = m.doc_id"""
    ),
)
def j13(t):
    from onefold.functions.scalars import iso_date

    empty = F.lit(None)
    target = (
        roles.titled_documents(t)
        .filter(c("lang").isin("en", "fr"))
        .select(
            c("doc_id").alias("tmdb_id"),
            "title",
            empty.cast("string").alias("original_title"),
            c("text").alias("overview"),
            empty.cast("date").alias("release_date"),
            empty.cast("double").alias("popularity"),
            empty.cast("string").alias("poster_path"),
            c("source").alias("status"),
            empty.cast("timestamp").alias("updated_at"),
        )
    )
    rows = C.clean_api(roles.api_raw(t)).withColumn("release_date", iso_date(c("release_date")))
    merged = upsert(target, rows, ["tmdb_id"], _SEVEN, ["vote_count"], touched="updated_at")
    return merged.select(
        "tmdb_id", *_SEVEN[:2], F.md5("overview").alias("overview"), *_SEVEN[3:], "status",
        c("updated_at").isNotNull().alias("written"),
    )


@query(
    "j14_upsert_ratings",
    with_named(
        """SELECT coalesce(r.movie_id, l.doc_id) AS movie_id, 'tmdb' AS source, coalesce(l.score, r.score) AS score,
        CASE WHEN l.doc_id IS NULL THEN r.vote_count ELSE l.vote_count END AS vote_count
        FROM (SELECT doc_id AS movie_id, n::DOUBLE AS score, n_chars AS vote_count FROM docs WHERE lang = 'en') r
        FULL JOIN (SELECT doc_id, quality + 0.5::DOUBLE AS score, quality * 10::BIGINT AS vote_count FROM labels WHERE toxic = 0) l
        ON l.doc_id = r.movie_id"""
    ),
)
def j14(t):
    target = roles.titled_documents(t).filter("lang = 'en'").select(
        c("doc_id").alias("movie_id"), F.lit("tmdb").alias("source"), c("n").cast("double").alias("score"),
        c("n_chars").alias("vote_count"),
    )
    rows = t.labels.select(
        c("doc_id").alias("movie_id"), F.lit("tmdb").alias("source"),
        F.when(c("toxic") == 0, c("quality") + F.lit(0.5)).alias("score"), (big("quality") * 10).alias("vote_count"),
    )
    return upsert_ratings(target, rows, ["vote_count"])


@query("j15_ingest_log", "SELECT source AS source_name, 2 * count(*) AS entries FROM documents GROUP BY 1")
def j15(t):
    path = scratch_path(t.spark, "log")
    for _ in range(2):
        writers.append_log(t.documents.select(c("doc_id").alias("movie_id"), c("source").alias("source_name")), path)
    return t.spark.read.parquet(path).groupBy("source_name").agg(F.count("ingested_at").alias("entries"))


@query(
    "j16_error_isolation",
    """SELECT count(quality) AS inserted_or_updated, count(*) - count(quality) AS errors
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def j16(t):
    return load_counts(t.documents.join(t.labels, "doc_id", "left"), ["doc_id", "quality"])


@query(
    "j16_scan_rejects",
    """SELECT unnest(['csv', 'json']) AS format, count(*) FILTER (doc_id % 7 <> 3) AS loaded,
        sum(doc_id) FILTER (doc_id % 7 <> 3)::BIGINT AS ids, count(*) FILTER (doc_id % 7 = 3) AS rejected,
        sum(length(source)) FILTER (doc_id % 7 = 3)::BIGINT AS raw_sources FROM documents""",
)
def j16_scan(t):
    """Every seventh line is broken: JSON that breaks off, a number that is none. Good rows load, the rest is told."""
    rows = t.documents.select("doc_id", "source", "n_chars", (c("doc_id") % 7 == 3).alias("broken"))
    whole = F.to_json(F.struct("doc_id", "source", "n_chars"))
    line = F.concat_ws(",", F.when(c("broken"), F.lit("x")).otherwise(c("doc_id").cast("string")), "source", "n_chars")
    files = {
        "json": F.when(c("broken"), F.concat(F.lit('{"source": "'), "source", F.lit('", "doc_id":'))).otherwise(whole),
        "csv": line,
    }
    schema = rows.drop("broken").schema
    counts = []
    for fmt, text in files.items():
        path = scratch_path(t.spark, f"broken-{fmt}")
        rows.select(text.alias("value")).write.text(path)
        good, rejects = readers.read_isolated(t.spark, path, schema, fmt)
        loaded = good.agg(F.count(F.lit(1)).alias("loaded"), big(F.sum("doc_id")).alias("ids"))
        source = F.regexp_extract("raw", r"src\d+", 0)
        told = rejects.agg(F.count(F.lit(1)).alias("rejected"), big(F.sum(F.length(source))).alias("raw_sources"))
        counts.append(loaded.crossJoin(told).select(F.lit(fmt).alias("format"), "*"))  # one row and one row
    return counts[0].unionByName(counts[1])


@query(
    "j17_constraint_checks",
    """SELECT 'lineitem key unique' AS rule, l_orderkey || '|' || l_linenumber AS value, count(*) AS rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'labels.doc_id unique', doc_id::VARCHAR, count(*) FROM labels GROUP BY doc_id HAVING count(*) > 1
    UNION ALL SELECT 'customer.c_name not null', 'null', count(*) FROM customer WHERE c_name IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'lineitem.l_returnflag allowed', l_returnflag, count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 2
    UNION ALL SELECT 'orders.o_custkey refers', o_custkey::VARCHAR, count(*) FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 2
    UNION ALL SELECT 'lineitem.l_suppkey refers', l_suppkey::VARCHAR, count(*) FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2
    UNION ALL SELECT 'part.p_name length', 'longer than 9', count(*) FROM part WHERE length(p_name) > 9 HAVING count(*) > 0""",
)
def j17(t):
    found = [
        checks.unique(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem key unique", primary=True),
        checks.unique(t.labels, ["doc_id"], "labels.doc_id unique"),
        checks.not_null(t.customer, "c_name", "customer.c_name not null"),
        checks.allowed(t.lineitem, "l_returnflag", ["A", "N"], "lineitem.l_returnflag allowed"),
        checks.foreign_key(t.orders, "o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey", "orders.o_custkey refers"),
        checks.foreign_key(t.lineitem, "l_suppkey", t.supplier, "s_suppkey", "lineitem.l_suppkey refers"),
        checks.max_length(t.part, "p_name", 9, "part.p_name length"),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


@query(
    "j17_model_violations",
    with_named(
        """SELECT 'movies.title not null' AS rule, 'null' AS value, count(*) AS rows FROM numbered WHERE title IS NULL
        HAVING count(*) > 0
        UNION ALL SELECT 'movies.tmdb_id unique', tmdb_id::VARCHAR, count(*) FROM numbered WHERE tmdb_id IS NOT NULL
        GROUP BY tmdb_id HAVING count(*) > 1
        UNION ALL SELECT 'movies.imdb_id unique', imdb_id, count(*) FROM numbered WHERE imdb_id IS NOT NULL
        GROUP BY imdb_id HAVING count(*) > 1
        UNION ALL SELECT 'movie_keywords primary', movie_id || '|' || keyword, count(*) FROM keyword_rows
        GROUP BY movie_id, keyword HAVING count(*) > 1"""
        + "".join(
            f""" UNION ALL SELECT 'movies.{name} length', 'longer than {size}', count(*) FROM numbered
            WHERE length({name}) > {size} HAVING count(*) > 0"""
            for name, size in model.MAX_LENGTHS["movies"].items()
        )
    ),
)
def j17_model(t):
    """Every rule that the model built from the unified table breaks: whole first lines can be too long for a title."""
    return model.violations(_model(t))


@query(
    "j18_cascade_delete",
    """SELECT 'customer' AS table_name, count(*) AS rows FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'orders', count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0""",
)
def j18(t):
    gone = t.customer.filter("c_acctbal < 0")
    left, kept = delete_cascade(t.customer, {"orders": (t.orders, "o_custkey")}, gone, "c_custkey")
    lost = t.orders.join(kept["orders"], "o_orderkey", "left_anti")
    _, lines = delete_cascade(t.orders, {"lineitem": (t.lineitem, "l_orderkey")}, lost, "o_orderkey")
    return model.load_statistics({"customer": left, **kept, **lines})


def _jobs(t):
    return {name: (lambda job=job: job(t)) for name, job in roles.CLEANING.items()}


@query(
    "j19_run_with_failure",
    with_named(
        """SELECT 'movies' AS item, count(*) AS rows FROM gold UNION ALL SELECT 'movie_keywords', 0
        UNION ALL SELECT 'sources_metadata', count(*) FROM source_rows WHERE source_name <> 'spark'
        UNION ALL SELECT 'ratings', count(*) FROM rating_rows UNION ALL SELECT 'genres', count(*) FROM genre_dim
        UNION ALL SELECT 'movie_genres', count(*) FROM genre_rows UNION ALL SELECT 'failed sources', 1"""
    ),
)
def j19(t):
    """A whole run in which the text job fails: the others go on, the merge uses what is there."""
    jobs = _jobs(t)

    def broken():
        raise RuntimeError("source is down")

    jobs["spark"] = broken
    summary = run(t.spark, jobs, scratch_path(t.spark, "run"))
    rows = list(summary["load"].items()) + [("failed sources", sum(not ok for ok in summary["ingest"].values()))]
    return t.spark.createDataFrame(rows, "item string, rows bigint")


@query("j20_merge_uses_all_clean", with_named(REPORT))
def j20(t):
    """First everything is ingested, then one source again: the report is that of all sources."""
    root = scratch_path(t.spark, "rerun")
    jobs = _jobs(t)
    run(t.spark, jobs, root, load=False)
    summary = run(t.spark, jobs, root, sources=["imdb"], load=False)
    kinds = {int: "bigint", float: "double"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in summary["gold"].items())
    return t.spark.createDataFrame([tuple(summary["gold"].values())], schema)
