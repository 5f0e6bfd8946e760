"""Projections, filters and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from onefold.functions import scalars as S
from onefold.functions import similarity as M
from onefold.functions import text as X
from onefold.operators import clean as C
from onefold.functions.stopwords import ENGLISH
from onefold.operators.keywords import MIN_TOKEN_LENGTH, text_enrichment
from onefold.operators.pages import clean_scraped, page_records
from onefold.plans import adapters as A
from onefold.plans.gold import with_theme
from onefold.schema import BULK_COLUMNS, GENRE_NAMES
from onefold.workload import roles
from onefold.workload.registry import big, listed, query
from onefold.workload.sqlkit import (
    GENRES,
    distinct_list,
    norm_date,
    norm_text,
    ratio,
    significant,
    split_list,
    title_key,
    tokens,
    with_named,
)

c = F.col


@query(
    "b1_keep_columns",
    with_named(
        f"SELECT {', '.join(x for x in BULK_COLUMNS if x != 'overview')}, md5(overview) AS overview FROM bulk_raw"
    ),
)
def b1(t):
    wide = roles.bulk_raw(t).withColumn("homepage", F.lit("x"))
    return wide.select(*BULK_COLUMNS).withColumn("overview", F.md5("overview"))


@query(
    "b2_api_whitelist",
    with_named("SELECT id AS tmdb_id, title, vote_average, NULL::VARCHAR AS poster_path, '' AS genre_ids FROM api_raw"),
)
def b2(t):
    raw = roles.api_raw(t).drop("poster_path", "genre_ids").withColumn("adult", F.lit(False))
    return C.map_api_fields(raw).select(
        "tmdb_id", "title", "vote_average", "poster_path", F.array_join("genre_ids", "|").alias("genre_ids")
    )


@query(
    "b3_normalize_records",
    with_named(
        f"""SELECT id, {norm_text('title')} AS title, {norm_text('original_title')} AS original_title,
        md5({norm_text('overview')}) AS overview, {norm_date('release_date')} AS release_date, popularity, vote_count FROM api_raw"""
    ),
)
def b3(t):
    df = C.normalize_records(roles.api_raw(t)).withColumn("overview", F.md5("overview"))
    return df.select("id", "title", "original_title", "overview", "release_date", "popularity", "vote_count")


_PARTIAL = """SELECT seq, source_rank::BIGINT AS source_rank, tmdb_id, imdb_id, title, md5(overview) AS overview, release_date, year,
    runtime_minutes, popularity, budget, revenue, tagline, collection_name, tmdb_vote_average, tmdb_vote_count,
    imdb_average_rating, imdb_num_votes, overview_word_count, rt_tomatometer, rt_audience, rt_critics_consensus,
    array_to_string(genres, '|') AS genres, array_to_string(keywords, '|') AS keywords,
    array_to_string(sources, '|') AS sources FROM """


def _partial_view(df):
    seq = F.concat_ws(":", "seq.source_pos", "seq.key")
    plain = """tmdb_id imdb_id title release_date year runtime_minutes popularity budget revenue tagline collection_name
    tmdb_vote_average tmdb_vote_count imdb_average_rating imdb_num_votes overview_word_count rt_tomatometer rt_audience
    rt_critics_consensus""".split()
    return df.withColumns(listed("genres", "keywords", "sources")).select(
        seq.alias("seq"), big("source_rank").alias("source_rank"), F.md5("overview").alias("overview"), *plain,
        "genres", "keywords", "sources",
    )


@query("b4_adapter_tmdb", with_named(_PARTIAL + "p_tmdb"))
def b4(t):
    return _partial_view(A.tmdb_partials(C.clean_api(roles.api_raw(t))))


@query("b5_adapter_imdb", with_named(_PARTIAL + "p_imdb"))
def b5(t):
    return _partial_view(A.imdb_partials(C.ratings_extract(roles.title_basics(t), roles.title_ratings(t), ordered=False)))


@query("b6_adapter_kaggle", with_named(_PARTIAL + "p_kaggle"))
def b6(t):
    return _partial_view(A.kaggle_partials(C.clean_bulk(roles.bulk_raw(t))))


@query("b7_adapter_rotten", with_named(_PARTIAL + "p_rt"))
def b7(t):
    return _partial_view(A.rotten_partials(clean_scraped(page_records(roles.scraped_pages(t)))))


@query("b8_adapter_text", with_named(_PARTIAL + "p_spark"))
def b8(t):
    return _partial_view(A.text_partials(text_enrichment(roles.text_input(t))))


@query("b9_equality_filter", with_named("SELECT tconst, genres FROM basics WHERE titleType = 'movie'"))
def b9(t):
    return roles.title_basics(t).filter(c("titleType") == "movie").select("tconst", "genres")


@query("b10_theme_substring", with_named("SELECT tconst, genres FROM basics WHERE genres ILIKE '%horror%'"))
def b10(t):
    return roles.title_basics(t).filter(c("genres").ilike("%Horror%")).select("tconst", "genres")


@query(
    "b11_range_filters",
    with_named(
        "SELECT tconst, startYear, numVotes FROM basics JOIN rates USING (tconst) WHERE numVotes >= 3000 AND startYear >= 1990"
    ),
)
def b11(t):
    basics = roles.title_basics(t).filter(c("startYear") >= 1990)
    rates = roles.title_ratings(t).filter(c("numVotes") >= 3000)
    return basics.join(rates, "tconst").select("tconst", "startYear", "numVotes")


@query("b12_theme_member", with_named("SELECT seq, array_to_string(genres, '|') AS genres FROM p_imdb WHERE list_contains(genres, 'Horror')"))
def b12(t):
    df = with_theme(A.imdb_partials(C.ratings_extract(roles.title_basics(t), roles.title_ratings(t), ordered=False)))
    return df.select(F.concat_ws(":", "seq.source_pos", "seq.key").alias("seq"), F.array_join("genres", "|").alias("genres"))


@query(
    "b13_text_present",
    "SELECT count(*) AS with_text, count(*) FILTER (WHERE try_cast(conv_id AS BIGINT) IS NOT NULL) AS with_key FROM conversations WHERE text IS NOT NULL AND length(text) > 0",
)
def b13(t):
    present = t.conversations.filter(c("text").isNotNull() & (F.length("text") > 0))
    return present.agg(
        F.count(F.lit(1)).alias("with_text"), F.count_if(c("conv_id").try_cast("bigint").isNotNull()).alias("with_key")
    )


@query(
    "b14_drop_incomplete",
    with_named("SELECT tconst, runtimeMinutes, genres FROM basics WHERE runtimeMinutes IS NOT NULL AND genres IS NOT NULL"),
)
def b14(t):
    return roles.title_basics(t).dropna(subset=["runtimeMinutes", "genres"]).select("tconst", "runtimeMinutes", "genres")


@query("b15_drop_untitled", with_named("SELECT page_id, title FROM scraped WHERE title <> ''"))
def b15(t):
    return clean_scraped(page_records(roles.scraped_pages(t))).select("page_id", "title")


@query(
    "b16_choose_sources",
    with_named("SELECT source, count(*) AS rows FROM (SELECT source FROM p_kaggle UNION ALL SELECT source FROM p_imdb) GROUP BY 1"),
)
def b16(t):
    df = roles.partials(t, ["kaggle", "imdb"])
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


# Scalar functions

@query("h1_normalize_date", with_named(f"SELECT id, release_date AS raw, {norm_date('release_date')} AS iso FROM api_raw"))
def h1(t):
    return roles.api_raw(t).select("id", c("release_date").alias("raw"), S.normalize_date(c("release_date")).alias("iso"))


@query(
    "h2_normalize_text",
    f"SELECT page_id, md5({norm_text('html')}) AS plain_md5, length({norm_text('html')}) AS plain_length FROM pages",
)
def h2(t):
    plain = X.normalize_text(c("html"))
    return t.pages.select("page_id", F.md5(plain).alias("plain_md5"), big(F.length(plain)).alias("plain_length"))


@query("h3_year_of_iso", with_named("SELECT id, try_cast(substr(release_date, 1, 4) AS BIGINT) AS year FROM bulk_raw"))
def h3(t):
    return roles.bulk_raw(t).select("id", S.year_of_iso(c("release_date")).alias("year"))


@query("h4_to_int", "SELECT event_id, trunc(value)::BIGINT AS whole, NULL::BIGINT AS bad FROM events")
def h4(t):
    return t.events.select(
        "event_id", S.to_int(c("value").cast("string")).alias("whole"), S.to_int(c("event_type")).alias("bad")
    )


@query("h5_to_float", "SELECT c_custkey, c_acctbal AS number, NULL::DOUBLE AS bad FROM customer")
def h5(t):
    return t.customer.select(
        "c_custkey", S.to_float(c("c_acctbal").cast("string")).alias("number"), S.to_float(c("c_name")).alias("bad")
    )


@query(
    "h6_split_list",
    f"""SELECT p_partkey, array_to_string({split_list('p_name', ' ')}, '|') AS words,
    array_to_string({split_list("p_name || ', ,' || p_name || ',' || p_type")}, '|') AS items FROM part""",
)
def h6(t):
    doubled = F.concat("p_name", F.lit(", ,"), "p_name", F.lit(","), "p_type")
    return t.part.select(
        "p_partkey",
        F.array_join(X.split_list(c("p_name"), " "), "|").alias("words"),
        F.array_join(X.split_list(doubled), "|").alias("items"),
    )


@query("h7_title_key", with_named(f"SELECT page_id, {title_key('title')} AS key FROM page_base"))
def h7(t):
    return roles.page_base(t).select("page_id", X.title_key(c("title")).alias("key"))


@query(
    "h8_similarity",
    with_named(
        f"""SELECT page_id, {ratio('a', 'b')} AS ratio FROM (SELECT page_id, lower(p.title) AS a, lower(d.title) AS b
        FROM page_base p JOIN docs d ON d.doc_id = p.url_id)"""
    ),
)
def h8(t):
    p = roles.page_base(t).select("page_id", F.lower("title").alias("a"), c("url_id").alias("doc_id"))
    d = roles.titled_documents(t).select("doc_id", F.lower("title").alias("b"))
    return p.join(d, "doc_id").select("page_id", M.ratio(c("a"), c("b")).alias("ratio"))


@query("h9_strip_year", with_named("SELECT page_id, trim(title) AS bare FROM page_base"))
def h9(t):
    return roles.page_base(t).select(
        "page_id", X.strip_year_suffix(F.concat("title", F.lit(" ("), "y", F.lit(") "))).alias("bare")
    )


@query(
    "h10_first_year",
    "SELECT page_id, nullif(regexp_extract(url, '\\d{4}'), '')::BIGINT AS year FROM pages",
)
def h10(t):
    return t.pages.select("page_id", S.first_year(c("url")).alias("year"))


@query(
    "h11_percent",
    "SELECT l_returnflag, sum(round(l_discount * 100)::BIGINT)::BIGINT AS percent, count(*) AS rows FROM lineitem GROUP BY 1",
)
def h11(t):
    text = F.concat(F.lit("off: "), F.round(c("l_discount") * 100).cast("int"), F.lit(" % of price"))
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(S.percent(text)).alias("percent"), F.count(F.lit(1)).alias("rows"))


@query(
    "h12_decade",
    "SELECT ((year(o_orderdate) // 10) * 10)::VARCHAR || 's' AS decade, count(*) AS orders FROM orders GROUP BY 1",
)
def h12(t):
    return t.orders.groupBy(S.decade(F.year("o_orderdate")).alias("decade")).agg(F.count(F.lit(1)).alias("orders"))


@query("h13_single_genre", with_named("SELECT tconst, coalesce(trim(genres) = 'Horror', false) AS pure FROM basics"))
def h13(t):
    return roles.title_basics(t).select("tconst", X.is_only(c("genres"), "Horror").alias("pure"))


@query(
    "h14_genre_count",
    with_named("SELECT tconst, coalesce(len(list_filter(string_split(genres, ','), lambda x: x <> 'Horror')), 0) + 1 AS genres FROM basics"),
)
def h14(t):
    return roles.title_basics(t).select("tconst", big(F.size(X.other_items(c("genres"), "Horror")) + 1).alias("genres"))


@query("h15_composite_score", "SELECT p_partkey, round_even(p_retailprice * sqrt(p_size), 2) AS score FROM part")
def h15(t):
    return t.part.select("p_partkey", S.composite_score(c("p_retailprice"), c("p_size")).alias("score"))


@query("h16_na_to_null", with_named("SELECT id, nullif(tagline, 'NA') AS tagline, nullif(collection_name, 'NA') AS collection_name FROM bulk_raw"))
def h16(t):
    return roles.bulk_raw(t).select("id", *[S.na_to_null(c(n)).alias(n) for n in ("tagline", "collection_name")])


@query("h17_zero_to_null", "SELECT l_returnflag, count(nullif(l_discount, 0)) AS discounts, count(nullif(l_tax, 0)) AS taxes FROM lineitem GROUP BY 1")
def h17(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(S.zero_to_null(c("l_discount"))).alias("discounts"), F.count(S.zero_to_null(c("l_tax"))).alias("taxes")
    )


@query("h18_loose_date", with_named("SELECT id, strftime(try_strptime(release_date, '%Y-%m-%d'), '%Y-%m-%d') AS date FROM bulk_raw"))
def h18(t):
    return roles.bulk_raw(t).select("id", S.iso_date(c("release_date")).cast("string").alias("date"))


@query("h19_coerce_number", "SELECT event_id, regexp_extract(props, '\\d+')::BIGINT AS k, NULL::BIGINT AS bad FROM events")
def h19(t):
    return t.events.select(
        "event_id", S.to_int(F.get_json_object("props", "$.k")).alias("k"), S.to_int(c("props")).alias("bad")
    )


@query("h20_dump_null", "SELECT doc_id, CASE WHEN lang <> 'en' THEN source END AS source FROM documents")
def h20(t):
    marked = F.when(c("lang") == "en", F.lit("\\N")).otherwise(c("source"))
    return t.documents.select("doc_id", S.dump_null(marked).alias("source"))


@query("h21_iso_date", with_named("SELECT id, try_strptime(release_date, '%Y-%m-%d')::DATE AS date FROM api_raw"))
def h21(t):
    return roles.api_raw(t).select("id", S.iso_date(c("release_date")).alias("date"))


@query("h22_year_start", with_named("SELECT tconst, startYear || '-01-01' AS date FROM basics"))
def h22(t):
    return roles.title_basics(t).select("tconst", S.year_start(c("startYear")).alias("date"))


@query(
    "h23_scalar_or_list",
    "SELECT p_partkey, CASE WHEN p_size > 25 THEN replace(p_name, ' ', '|') ELSE p_name END AS items FROM part",
)
def h23(t):
    value = F.when(c("p_size") > 25, F.to_json(F.split("p_name", " "))).otherwise(c("p_name"))
    return t.part.select("p_partkey", F.array_join(X.as_list(value), "|").alias("items"))


@query("h24_tokenise", f"SELECT doc_id, md5(array_to_string({tokens('text')}, ' ')) AS words_md5, len({tokens('text')}) AS words FROM documents")
def h24(t):
    words = X.tokens(c("text"), MIN_TOKEN_LENGTH)
    return t.documents.select("doc_id", F.md5(F.array_join(words, " ")).alias("words_md5"), big(F.size(words)).alias("words"))


@query("h25_stop_words", f"SELECT conv_id, turn, array_to_string({significant('text')}, ' ') AS words FROM conversations")
def h25(t):
    words = X.without(X.tokens(c("text")), ENGLISH)
    return t.conversations.select("conv_id", "turn", F.array_join(words, " ").alias("words"))


@query("h26_significant_words", f"SELECT doc_id, len({significant('text')}) AS words FROM documents")
def h26(t):
    return t.documents.select("doc_id", big(F.size(X.without(X.tokens(c("text")), ENGLISH))).alias("words"))


@query("c10_genre_names", with_named(
    f"SELECT id, array_to_string(list_filter(list_transform(genre_ids, lambda g: {GENRES}[g]), lambda g: g IS NOT NULL), '|') AS genres FROM api_raw"
))
def c10(t):
    return roles.api_raw(t).select("id", F.array_join(X.names_of(c("genre_ids"), GENRE_NAMES), "|").alias("genres"))


@query("d14_ordered_distinct", f"SELECT conv_id, turn, array_to_string({distinct_list(tokens('text'))}, ' ') AS words FROM conversations")
def d14(t):
    words = F.array_distinct(X.tokens(c("text")))
    return t.conversations.select("conv_id", "turn", F.array_join(words, " ").alias("words"))


@query("g2_list_except", with_named(
    "SELECT tconst, coalesce(array_to_string(list_filter(string_split(genres, ','), lambda x: x <> 'Horror'), '|'), '') AS others FROM basics"
))
def g2(t):
    return roles.title_basics(t).select("tconst", F.array_join(X.other_items(c("genres"), "Horror"), "|").alias("others"))


