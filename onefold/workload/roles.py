"""The given tables in the roles of the five sources.

documents  the bulk file; joined to labels, the master source with ratings; and the text corpus
pages      the ratings dump, and, wrapped in the markup of a review site, the scraped source

A record's title is the whole first line of a document, and what pages carry in their title element. The last
number in a page address is the document it was made from; only the year is taken from it, moved by up to one, so
that pages must be linked by title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onefold.operators.clean import clean_api, clean_bulk, enrich_ratings, ratings_extract
from onefold.operators.keywords import text_enrichment
from onefold.operators.pages import clean_scraped, page_records, tag_text
from onefold.plans.adapters import collect_partials
from onefold.plans.gold import build_gold
from onefold.session import cut_lineage
from onefold.sources.readers import read_parquet, read_spread

# Tables with long texts, and the key that spreads their rows.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}
MIN_YEAR = 1970


class Tables:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = TEXT_TABLES.get(name)
        table = read_spread(self.spark, path, key) if key else read_parquet(self.spark, path)
        setattr(self, name, table)
        return table


def titled_documents(t: Tables) -> DataFrame:
    """documents with title, derived year, month and day, and the number in the source name."""
    return t.documents.selectExpr(
        "doc_id",
        "text",
        "lang",
        "source",
        "n_chars",
        "split(text, '\\n', 2)[0] AS title",
        f"CAST({MIN_YEAR} + doc_id % 50 AS INT) AS y",
        "CAST(1 + doc_id % 12 AS INT) AS m",
        "CAST(1 + doc_id % 28 AS INT) AS d",
        "CAST(substring(source, 4) AS INT) AS n",
    )


def _by_lang(en: str, fr: str, de: str, es: str) -> str:
    return f"CASE lang WHEN 'en' THEN {en} WHEN 'fr' THEN {fr} WHEN 'de' THEN {de} ELSE {es} END"


def api_raw(t: Tables) -> DataFrame:
    """Master source as its API gives it: markup in titles, dates in several forms."""
    loose = "concat_ws('-', y, m, d)"
    return (
        titled_documents(t)
        .join(t.labels, "doc_id")
        .selectExpr(
            "doc_id AS id",
            "concat('<i>', title, '</i> ') AS title",
            "concat('original: ', title) AS original_title",
            "lang AS original_language",
            "text AS overview",
            f"{_by_lang(loose, loose, 'CAST(y AS STRING)', repr('unknown'))} AS release_date",
            "(quality * 75 + n) / 10D AS vote_average",
            "n_chars AS vote_count",
            "n_chars / 100D AS popularity",
            "concat('/p/', doc_id, '.jpg') AS poster_path",
            f"array({_by_lang('27', '18', '53', '9648')}, n + 10400) AS genre_ids",
        )
    )


def bulk_raw(t: Tables) -> DataFrame:
    """Bulk file with its sentinels: NA texts, zero money, dates that are none."""
    genre = _by_lang("'Horror'", "'Drama'", "'Thriller'", "'Mystery'")
    return titled_documents(t).selectExpr(
        "doc_id AS id",
        "title",
        "title AS original_title",
        "lang AS original_language",
        "text AS overview",
        "CASE WHEN n < 10 THEN 'NA' ELSE source END AS tagline",
        "CASE WHEN n = 19 THEN 'bad date' ELSE format_string('%04d-%02d-%02d', y, m, d) END AS release_date",
        "n_chars / 10D AS popularity",
        "n_chars AS vote_count",
        "CAST(n AS DOUBLE) AS vote_average",
        "n * 1000L AS budget",
        "n_chars * 1000000 AS revenue",
        "CAST(60 + n AS BIGINT) AS runtime",
        "'Released' AS status",
        f"concat({genre}, ', ', initcap(source), ',', {genre}) AS genre_names",
        f"{_by_lang('source', repr('NA'), 'source', 'source')} AS collection_name",
    )


def page_base(t: Tables) -> DataFrame:
    number = F.regexp_extract("url", r"/(..)/(\d+)", 2).cast("bigint")
    return t.pages.select("*", tag_text(F.col("html"), "title").alias("title"), number.alias("url_id")).selectExpr(
        "page_id",
        "url",
        "html",
        "regexp_extract(html, '<html lang=\"(..)\"', 1) AS lang",
        "title",
        "url_id",
        f"CAST({MIN_YEAR} + url_id % 50 + page_id % 3 - 1 AS INT) AS y",
        "length(html) AS size",
    )


def title_basics(t: Tables) -> DataFrame:
    return page_base(t).selectExpr(
        "concat('pg', page_id) AS tconst",
        f"{_by_lang(*map(repr, ('movie', 'movie', 'movie', 'short')))} AS titleType",
        "title AS primaryTitle",
        "title AS originalTitle",
        "y AS startYear",
        "CASE WHEN size >= 2000 THEN CAST(60 + page_id % 90 AS INT) END AS runtimeMinutes",
        f"{_by_lang(repr('Drama,Horror,Thriller'), repr('horror'), repr('Horror'), 'NULL')} AS genres",
    )


def title_ratings(t: Tables) -> DataFrame:
    return page_base(t).selectExpr(
        "concat('pg', page_id) AS tconst", "(size % 90 + 10) / 10D AS averageRating", "size AS numVotes"
    )


def _slot(name: str, content: str) -> str:
    return f"concat('<rt-text slot=\"{name}\">', {content}, '</rt-text>')"


def _ld(content: str) -> str:
    return f"concat('<script type=\"application/ld+json\">', {content}, '</script>')"


def scraped_pages(t: Tables) -> DataFrame:
    """pages wrapped in the markup of a review site. English and French pages have a JSON-LD record,
    German ones a broken record and slots, Spanish ones a title slot only."""
    safe = "replace(replace(title, '&', '&amp;'), '<', '&lt;')"
    english = """to_json(named_struct('@type', 'Movie', 'name', title, 'dateCreated', concat(y, '-03-01'),
        'genre', array('Horror', 'Mystery'),
        'aggregateRating', named_struct('name', 'Tomatometer', 'ratingValue', CAST(size % 101 AS STRING))))"""
    french = """concat('[{"name": ""}, ', to_json(named_struct('name', concat(title, ' (', y, ')'),
        'datePublished', concat('Published ', y), 'genre', 'Drama',
        'aggregateRating', named_struct('name', 'Popcorn', 'ratingValue', '12'))), ']')"""
    consensus = """concat('<div id="critics-consensus"><p>Fresh.</p> Critics Consensus <div>Page ', page_id,
        ' <b>is</b> fine.</div></div><div>after</div>')"""
    german = [
        _ld("""'{"name": "broken'"""),
        _slot("title", safe),
        _slot("metadata-prop", "'R'"),
        _slot("metadata-prop", "concat(y, ', 2h 7m')"),
        _slot("critics-score", "concat(size % 101, '%')"),
        """'<div id="critics-consensus"> </div>'""",
    ]
    head = _by_lang(
        f"concat({_ld(english)}, {_slot('title', repr('other'))}, {consensus})",
        f"concat({_ld(french)}, {_slot('critics-score', repr('33%'))})",
        f"concat({', '.join(german)})",
        _slot("title", safe),
    )
    hidden = """'<!-- <rt-text slot="title">hidden</rt-text> -->'"""
    audience = _slot("audience-score", "concat(page_id % 101, ' %')")
    return page_base(t).selectExpr("page_id", f"concat(html, {hidden}, {head}, {audience}) AS html")


def text_input(t: Tables) -> DataFrame:
    return titled_documents(t).selectExpr("CAST(doc_id AS STRING) AS id", "title", "text AS overview")


CLEANING = {
    "tmdb": lambda t: clean_api(api_raw(t)),
    "rotten_tomatoes": lambda t: clean_scraped(page_records(scraped_pages(t))),
    "kaggle": lambda t: clean_bulk(bulk_raw(t)),
    "imdb": lambda t: enrich_ratings(
        ratings_extract(title_basics(t), title_ratings(t), ordered=False), ordered=False
    ),
    "spark": lambda t: text_enrichment(text_input(t)),
}


def clean_sources(t: Tables, sources: list[str] | None = None) -> dict[str, DataFrame]:
    """The clean table of every source, each by its own cleaning query."""
    return {name: job(t) for name, job in CLEANING.items() if sources is None or name in sources}


def partials(t: Tables, sources: list[str] | None = None) -> DataFrame:
    """All partials, written once: a merge reads its input several times, each time other columns."""
    return cut_lineage(collect_partials(clean_sources(t, sources), sources))


def gold(t: Tables) -> DataFrame:
    """The unified table of the theme with its input order."""
    return build_gold(partials(t), keep_order=True)
