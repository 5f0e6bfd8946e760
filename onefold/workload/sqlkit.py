"""Building blocks of the check SQL: named subqueries and the expressions they share."""

from __future__ import annotations

import re

from onefold.functions.stopwords import ENGLISH
from onefold.schema import GENRE_NAMES, GOLD_SCHEMA, LIST_FIELDS

# Fixed value: white space in the Unicode sense, as a character class.
SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


STOP = f"[{quoted(ENGLISH)}]"


def norm_text(x: str) -> str:
    return (
        f"CASE WHEN length({x}) > 0 THEN trim(regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), "
        f"'{SPACE}+', ' ', 'g')) END"
    )


def norm_date(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
        f"THEN strftime(try_strptime({x}, '%Y-%m-%d'), '%Y-%m-%d') "
        f"WHEN regexp_full_match(trim({x}), '[+-]?\\d+') "
        f"THEN try_cast(trim({x}) AS HUGEINT)::VARCHAR || '-01-01' END"
    )


def title_key(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '^{SPACE}+|{SPACE}+$', '', 'g'))"


def split_list(x: str, sep: str = ",") -> str:
    items = f"list_filter(list_transform(string_split({x}, '{sep}'), lambda x: trim(x)), lambda x: x <> '')"
    return f"coalesce({distinct_list(items)}, []::VARCHAR[])"


def distinct_list(x: str) -> str:
    """Order-preserving distinct."""
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '\\W+'), lambda w: length(w) >= 3)"


def significant(x: str) -> str:
    return f"list_filter({tokens(x)}, lambda w: NOT list_contains({STOP}, w))"


def lcs(a: str, b: str) -> str:
    """Row-by-row dynamic programme over the characters of both strings."""
    return (
        f"list_last(list_reduce(list_transform(range(1, length({a}) + 1), lambda i: [i]), "
        f"lambda row, i: list_reduce(range(1, length({b}) + 1), lambda r, j: list_append(r, "
        f"CASE WHEN substr({a}, i[1], 1) = substr({b}, j, 1) THEN row[j] + 1 "
        f"ELSE greatest(r[j], row[j + 1]) END), [0::BIGINT]), "
        f"list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT)))"
    )


def ratio(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = {b} THEN 100 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 "
        f"ELSE round_even(100.0::DOUBLE * (2.0::DOUBLE * {lcs(a, b)} / (length({a}) + length({b}))), 0)::INT END"
    )


def near(a: str, b: str, threshold: int = 90) -> str:
    """Necessary condition for a ratio of at least `threshold`; lengths that differ too much settle it first.

    DuckDB's levenshtein counts bytes. With one byte for every character, whatever it is, the distance can only shrink.
    """
    byte = lambda x: f"regexp_replace({x}, '[^\\x00-\\x7F]', '~', 'g')"
    bound = f"((201 - 2 * {threshold}) * (length({a}) + length({b}))) // 200"
    return f"CASE WHEN abs(length({a}) - length({b})) > {bound} THEN false ELSE levenshtein({byte(a)}, {byte(b)}) <= {bound} END"


def by_lang(en: str, fr: str, de: str, es: str) -> str:
    return f"CASE lang WHEN 'en' THEN {en} WHEN 'fr' THEN {fr} WHEN 'de' THEN {de} ELSE {es} END"


# The character references that the given pages hold; each may lack its semicolon, where a title was cut off.
REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "copy": "©", "middot": "·", "amp": "&"}


def unescaped(x: str) -> str:
    """Every reference resolved once, from left to right."""
    rx = f"&(?:{'|'.join(REFERENCES)});?"
    chars = "MAP {" + ", ".join(f"'&{name}': '{char}'" for name, char in REFERENCES.items()) + "}"
    hits, pieces = f"regexp_extract_all({x}, '{rx}')", f"regexp_split_to_array({x}, '{rx}')"
    return (
        f"array_to_string(list_transform(list_zip({pieces}, {hits}), "
        f"lambda p: p[1] || coalesce({chars}[rtrim(p[2], ';')], '')), '')"
    )


GENRES = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in GENRE_NAMES.items()) + "}"
SCALARS = [f.name for f in GOLD_SCHEMA if f.name not in LIST_FIELDS]
TEXTS = {f.name for f in GOLD_SCHEMA if f.dataType.typeName() == "string"}
_SQL_TYPES = {"long": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "array": "VARCHAR[]"}


def partial(source: str, rank: int, key: str, table: str, **fields: str) -> str:
    """One branch of the union of partials."""
    given = {"sources": f"['{source}']", **fields}
    cols = []
    for f in GOLD_SCHEMA:
        kind = _SQL_TYPES[f.dataType.typeName()]
        value = given.get(f.name, "[]" if kind == "VARCHAR[]" else "NULL")
        cols.append(f"({value})::{kind} AS {f.name}")
    return (
        f"SELECT {', '.join(cols)}, '{source}' AS source, {rank} AS source_rank, "
        f"'{rank}:' || CASE WHEN regexp_full_match(({key})::VARCHAR, '\\d{{1,20}}') "
        f"THEN lpad(({key})::VARCHAR, 20, '0') ELSE ({key})::VARCHAR END AS seq FROM {table}"
    )


def _survivors(key: str, table: str) -> str:
    picks = []
    for c in SCALARS:
        present = f"{c} IS NOT NULL" + (f" AND {c} <> ''" if c in TEXTS else "")
        picks.append(f"arg_min({c}, (source_rank, seq)) FILTER (WHERE {present}) AS {c}")
    return (
        f"SELECT {key}, min(seq) AS first_seq, bool_or(tmdb_id IS NOT NULL) AS has_tmdb, {', '.join(picks)} "
        f"FROM {table} GROUP BY {key}"
    )


def _list_union(field: str) -> str:
    return (
        f"SELECT cluster_key, list(item ORDER BY first_seen) AS {field} FROM ("
        f"SELECT cluster_key, item, min((source_rank, seq, place)) AS first_seen FROM ("
        f"SELECT cluster_key, source_rank, seq, unnest({field}) AS item, generate_subscripts({field}, 1) AS place "
        f"FROM final) GROUP BY cluster_key, item) GROUP BY cluster_key"
    )


# Name -> (recursive?, SQL). A query lists what it needs by using the names.
NAMED: dict[str, str] = {
    "docs": """SELECT doc_id, text, lang, source, n_chars, split_part(text, chr(10), 1) AS title,
        (1970 + doc_id % 50)::INT AS y, (1 + doc_id % 12)::INT AS m, (1 + doc_id % 28)::INT AS d,
        substr(source, 4)::INT AS n FROM documents""",
    "api_raw": f"""SELECT doc_id AS id, '<i>' || title || '</i> ' AS title, 'original: ' || title AS original_title,
        lang AS original_language, text AS overview,
        {by_lang("y || '-' || m || '-' || d", "y || '-' || m || '-' || d", "y::VARCHAR", "'unknown'")} AS release_date,
        (quality * 75 + n) / 10.0::DOUBLE AS vote_average, n_chars AS vote_count, n_chars / 100.0::DOUBLE AS popularity,
        '/p/' || doc_id || '.jpg' AS poster_path,
        [{by_lang("27", "18", "53", "9648")}, n + 10400] AS genre_ids
        FROM docs JOIN labels USING (doc_id)""",
    "api_clean": f"""SELECT id AS tmdb_id, {norm_text('title')} AS title, {norm_text('original_title')} AS original_title,
        original_language, {norm_text('overview')} AS overview, {norm_date('release_date')} AS release_date,
        vote_average, vote_count, popularity, poster_path, genre_ids FROM api_raw""",
    "bulk_raw": f"""SELECT doc_id AS id, title, title AS original_title, lang AS original_language, text AS overview,
        CASE WHEN n < 10 THEN 'NA' ELSE source END AS tagline,
        CASE WHEN n = 19 THEN 'bad date' ELSE printf('%04d-%02d-%02d', y, m, d) END AS release_date,
        n_chars / 10.0::DOUBLE AS popularity, n_chars AS vote_count, n::DOUBLE AS vote_average, n * 1000::BIGINT AS budget,
        n_chars * 1000000 AS revenue, (60 + n)::BIGINT AS runtime, 'Released' AS status,
        {by_lang("'Horror'", "'Drama'", "'Thriller'", "'Mystery'")} || ', ' || upper(source[1]) || source[2:] || ',' ||
        {by_lang("'Horror'", "'Drama'", "'Thriller'", "'Mystery'")} AS genre_names,
        {by_lang('source', "'NA'", 'source', 'source')} AS collection_name FROM docs""",
    "bulk_clean": """SELECT * EXCLUDE (rn, release_date, collection_name, tagline, overview, budget, revenue),
        strftime(try_strptime(release_date, '%Y-%m-%d'), '%Y-%m-%d') AS release_date, nullif(collection_name, 'NA') AS collection_name,
        nullif(tagline, 'NA') AS tagline, nullif(overview, 'NA') AS overview, nullif(budget, 0) AS budget,
        nullif(revenue, 0) AS revenue
        FROM (SELECT *, row_number() OVER (PARTITION BY title, release_date ORDER BY id) AS rn FROM bulk_raw) WHERE rn = 1""",
    "page_base": f"""SELECT page_id, url, html, regexp_extract(html, '<html lang="(..)"', 1) AS lang,
        trim({unescaped("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")}) AS title,
        regexp_extract(url, '/(..)/(\\d+)', 2)::BIGINT AS url_id,
        (1970 + regexp_extract(url, '/(..)/(\\d+)', 2)::BIGINT % 50 + page_id % 3 - 1)::INT AS y,
        length(html)::INT AS size FROM pages""",
    "basics": f"""SELECT 'pg' || page_id AS tconst, {by_lang("'movie'", "'movie'", "'movie'", "'short'")} AS titleType,
        title AS primaryTitle, title AS originalTitle, y AS startYear,
        CASE WHEN size >= 2000 THEN (60 + page_id % 90)::INT END AS runtimeMinutes,
        {by_lang("'Drama,Horror,Thriller'", "'horror'", "'Horror'", 'NULL')} AS genres FROM page_base""",
    "rates": """SELECT 'pg' || page_id AS tconst, (size % 90 + 10) / 10.0::DOUBLE AS averageRating, size AS numVotes
        FROM page_base""",
    "extract": """SELECT tconst, primaryTitle, startYear, runtimeMinutes, genres, averageRating, numVotes
        FROM basics JOIN rates USING (tconst)
        WHERE titleType = 'movie' AND genres ILIKE '%Horror%' AND numVotes >= 1000 AND startYear >= 1970""",
    "enriched": """SELECT *, ((startYear // 10) * 10)::VARCHAR || 's' AS decade, trim(genres) = 'Horror' AS is_pure_horror,
        list_filter(string_split(genres, ','), lambda x: x <> 'Horror') AS sub_genres,
        len(list_filter(string_split(genres, ','), lambda x: x <> 'Horror')) + 1 AS num_genres,
        round_even(averageRating * sqrt(numVotes), 2) AS score FROM extract""",
    "scraped": f"""SELECT page_id, trim(regexp_replace(title, '\\s*\\(\\d{{4}}\\)\\s*$', '')) AS title,
        {by_lang('y::BIGINT', 'y::BIGINT', 'y::BIGINT', 'NULL')} AS year,
        {by_lang("['Horror', 'Mystery']", "['Drama']", '[]::VARCHAR[]', '[]::VARCHAR[]')} AS genres,
        {by_lang('(size % 101)::BIGINT', '33', '(size % 101)::BIGINT', 'NULL')} AS tomatometer,
        (page_id % 101)::BIGINT AS audience,
        {by_lang("'Page ' || page_id || ' is fine.'", 'NULL', 'NULL', 'NULL')} AS critics_consensus FROM page_base""",
    "scraped_clean": f"""SELECT page_id, {norm_text('title')} AS title, year, genres, tomatometer, audience, critics_consensus
        FROM scraped WHERE title <> ''""",
    "words": f"SELECT doc_id AS id, unnest({significant('text')}) AS term FROM documents WHERE length(text) > 0",
    "tf": "SELECT id, term, count(*) AS tf FROM words GROUP BY ALL",
    "vocab": """SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term HAVING count(*) >= 2
        ORDER BY cf DESC, term LIMIT 20000""",
    "idf": """SELECT term, df, cf, ln((SELECT count(*) + 1 FROM documents WHERE length(text) > 0) / (df + 1)) AS idf
        FROM vocab""",
    "topk": """SELECT * FROM (SELECT id, term, round(tf * idf, 9) AS weight,
        row_number() OVER (PARTITION BY id ORDER BY round(tf * idf, 9) DESC, cf, term) AS place FROM tf JOIN idf USING (term))
        WHERE place <= 10""",
    "enrichment": f"""SELECT doc_id AS tmdb_id, len({significant('text')})::BIGINT AS overview_word_count,
        coalesce(k.keywords, []) AS keywords FROM documents LEFT JOIN
        (SELECT id, list(term ORDER BY place) AS keywords FROM topk GROUP BY id) k ON k.id = doc_id WHERE length(text) > 0""",
    "p_tmdb": partial(
        "tmdb", 0, "tmdb_id", "api_clean", tmdb_id="tmdb_id", title="title", original_title="original_title",
        original_language="original_language", overview="overview", release_date="release_date",
        year="try_cast(substr(release_date, 1, 4) AS BIGINT)", poster_path="poster_path", popularity="popularity",
        tmdb_vote_average="vote_average", tmdb_vote_count="vote_count",
        genres=f"list_filter(list_transform(genre_ids, lambda g: {GENRES}[g]), lambda g: g IS NOT NULL)",
    ),
    "p_rt": partial(
        "rotten_tomatoes", 1, "page_id", "scraped_clean", title="title", year="year", rt_tomatometer="tomatometer",
        rt_audience="audience", rt_critics_consensus="critics_consensus", genres="genres",
    ),
    "p_kaggle": partial(
        "kaggle", 2, "id", "bulk_clean", tmdb_id="id", title="title", original_title="original_title",
        original_language="original_language", overview="overview", release_date="release_date",
        year="try_cast(substr(release_date, 1, 4) AS BIGINT)", runtime_minutes="runtime", budget="budget",
        revenue="revenue", tagline="tagline", collection_name="collection_name", status="status",
        genres=split_list("genre_names"),
    ),
    "p_imdb": partial(
        "imdb", 3, "tconst", "extract", imdb_id="tconst", title="nullif(primaryTitle, '')", year="startYear",
        release_date="CASE WHEN startYear <> 0 THEN startYear || '-01-01' END", runtime_minutes="runtimeMinutes",
        imdb_average_rating="averageRating", imdb_num_votes="numVotes", genres=split_list("genres"),
    ),
    "p_spark": partial(
        "spark", 4, "tmdb_id", "enrichment", tmdb_id="tmdb_id", overview_word_count="overview_word_count", keywords="keywords",
    ),
    "partials": "SELECT * FROM p_tmdb UNION ALL SELECT * FROM p_rt UNION ALL SELECT * FROM p_kaggle "
    "UNION ALL SELECT * FROM p_imdb UNION ALL SELECT * FROM p_spark",
    "keyed": """SELECT *, coalesce('t:' || tmdb_id, 'i:' || nullif(imdb_id, ''), 'r:' || seq) AS own_cluster FROM partials""",
    "exact": _survivors("own_cluster", "keyed"),
    "anchors": f"SELECT *, {title_key('title')} AS norm FROM exact WHERE has_tmdb AND title IS NOT NULL AND year IS NOT NULL",
    "floats": f"SELECT *, {title_key('title')} AS norm FROM exact WHERE NOT has_tmdb AND title IS NOT NULL AND year IS NOT NULL",
    "title_pairs": """SELECT DISTINCT f.norm AS fnorm, a.norm AS anorm FROM floats f JOIN anchors a
        ON a.year BETWEEN f.year - 1 AND f.year + 1""",
    "title_ratios": f"""SELECT fnorm, anorm, {ratio('fnorm', 'anorm')} AS ratio FROM title_pairs WHERE {near('fnorm', 'anorm')}""",
    "pairs": """SELECT f.own_cluster AS fkey, f.norm AS fnorm, f.year AS fyear, a.own_cluster AS akey, a.norm AS anorm,
        a.year AS ayear, a.first_seq AS aseq, r.ratio FROM floats f JOIN title_ratios r ON r.fnorm = f.norm
        JOIN anchors a ON a.norm = r.anorm AND a.year BETWEEN f.year - 1 AND f.year + 1 WHERE r.ratio >= 90""",
    "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fkey ORDER BY ratio DESC, ayear, aseq) AS rn FROM pairs)
        WHERE rn = 1""",
    "final": """SELECT k.* , coalesce(b.akey, k.own_cluster) AS cluster_key FROM keyed k LEFT JOIN best b ON b.fkey = k.own_cluster""",
    "merged": _survivors("cluster_key", "final"),
    "u_genres": _list_union("genres"),
    "u_keywords": _list_union("keywords"),
    "u_sources": _list_union("sources"),
    "unified": f"""SELECT m.cluster_key, m.first_seq, {', '.join('m.' + c for c in SCALARS)},
        coalesce(g.genres, []) AS genres, coalesce(w.keywords, []) AS keywords, coalesce(s.sources, []) AS sources
        FROM merged m LEFT JOIN u_genres g USING (cluster_key) LEFT JOIN u_keywords w USING (cluster_key)
        LEFT JOIN u_sources s USING (cluster_key)""",
    "gold": "SELECT * FROM unified WHERE list_contains(genres, 'Horror')",
    "numbered": "SELECT row_number() OVER (ORDER BY first_seq) AS id, * FROM gold",
    "genre_rows": """SELECT id AS movie_id, unnest(genres) AS name, generate_subscripts(genres, 1) AS place FROM numbered""",
    "genre_dim": """SELECT row_number() OVER (ORDER BY f) AS id, name FROM
        (SELECT name, min((movie_id, place)) AS f FROM genre_rows GROUP BY name)""",
    "keyword_rows": "SELECT DISTINCT id AS movie_id, unnest(keywords) AS keyword FROM numbered",
    "source_rows": "SELECT id AS movie_id, unnest(sources) AS source_name FROM numbered",
    "rating_rows": """SELECT id AS movie_id, 'tmdb' AS source, tmdb_vote_average AS score, NULL::DOUBLE AS audience_score,
        tmdb_vote_count AS vote_count, NULL AS critics_consensus FROM numbered WHERE tmdb_vote_average IS NOT NULL
        UNION ALL SELECT id, 'imdb', imdb_average_rating, NULL, imdb_num_votes, NULL FROM numbered
        WHERE imdb_average_rating IS NOT NULL
        UNION ALL SELECT id, 'rotten_tomatoes', rt_tomatometer::DOUBLE, rt_audience::DOUBLE, NULL, rt_critics_consensus
        FROM numbered WHERE coalesce(rt_tomatometer, rt_audience) IS NOT NULL OR rt_critics_consensus IS NOT NULL""",
}


def with_named(body: str, recursive: str | None = None) -> str:
    """`body` preceded by all named subqueries it needs, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"(?:FROM|JOIN)\s+\(?\s*([a-z_]+)", text):
            if word in NAMED and word not in order:
                need(NAMED[word])
                if word not in order:
                    order.append(word)

    need((recursive or "") + " " + body)
    parts = [f"{n} AS MATERIALIZED ({NAMED[n]})" for n in order]
    if recursive:
        parts.append(recursive)
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"


def gold_columns(prefix: str = "") -> str:
    """The unified columns with lists as text."""
    return ", ".join(
        f"array_to_string({prefix}{c}, '|') AS {c}" if c in LIST_FIELDS else f"{prefix}{c}" for c in GOLD_SCHEMA.fieldNames()
    )
