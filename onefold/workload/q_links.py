"""Joins, exact links, components and the fuzzy match."""

from __future__ import annotations

from pyspark.sql import functions as F

from onefold.operators import fuzzy
from onefold.operators.links import link_groups, with_cluster_key
from onefold.operators.survive import cluster_records, match_clusters, representatives
from onefold.operators.upsert import insert_if_absent, link_known
from onefold.plans.adapters import to_partials
from onefold.schema import GENRE_SEED
from onefold.session import cut_lineage
from onefold.workload import roles
from onefold.workload.registry import big, query
from onefold.workload.sqlkit import by_lang, with_named

c = F.col
SEED_SQL = "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in GENRE_SEED) + ") seed(tmdb_genre_id, name)"


def seq_text():
    return F.concat_ws(":", "seq.source_pos", "seq.key").alias("seq")


@query(
    "c1_ratings_join",
    """SELECT p_brand, count(*) AS rows, sum(l_quantity)::BIGINT AS quantity FROM part JOIN lineitem ON p_partkey = l_partkey
    GROUP BY 1""",
)
def c1(t):
    joined = t.part.join(t.lineitem, c("p_partkey") == c("l_partkey"))
    return joined.groupBy("p_brand").agg(F.count(F.lit(1)).alias("rows"), big(F.sum("l_quantity")).alias("quantity"))


@query(
    "c2_shared_id_links",
    with_named("SELECT tmdb_id, min(seq) AS first_seq, count(*) AS members FROM partials WHERE tmdb_id IS NOT NULL GROUP BY 1"),
)
def c2(t):
    df = link_groups(roles.partials(t), "tmdb_id")
    return df.select("tmdb_id", F.concat_ws(":", "first_seq.source_pos", "first_seq.key").alias("first_seq"), "members")


@query(
    "c3_own_id_links",
    """SELECT 'u' || user_id AS imdb_id, min('3:' || lpad(event_id::VARCHAR, 20, '0')) AS first_seq, count(*) AS members
    FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def c3(t):
    own = F.when(c("event_type") == "error", "").otherwise(F.concat(F.lit("u"), "user_id"))
    df = link_groups(to_partials(t.events, "imdb", c("event_id"), {"imdb_id": own}), "imdb_id")
    return df.select("imdb_id", F.concat_ws(":", "first_seq.source_pos", "first_seq.key").alias("first_seq"), "members")


@query(
    "c4_components",
    with_named(
        """SELECT r.seq, coalesce(m.component, r.node) AS cluster_key FROM records r LEFT JOIN
        (SELECT node, min(other) AS component FROM reach GROUP BY node) m USING (node)""",
        recursive="""records AS (
            SELECT '2:' || lpad(doc_id::VARCHAR, 20, '0') AS seq, 't:' || doc_id AS node, 'i:' || nullif(title, '') AS own FROM docs
            UNION ALL SELECT '0:' || lpad(page_id::VARCHAR, 20, '0'), 't:' || url_id, 'i:' || nullif(title, '') FROM page_base),
        steps AS (SELECT DISTINCT node AS a, own AS b FROM records WHERE own IS NOT NULL
            UNION SELECT DISTINCT own, node FROM records WHERE own IS NOT NULL),
        reach(node, other) AS (SELECT a, a FROM steps UNION SELECT r.node, s.b FROM reach r JOIN steps s ON s.a = r.other)""",
    ),
)
def c4(t):
    """Documents and pages carry both a document number and a title, so links run through both."""
    d, p = roles.titled_documents(t), roles.page_base(t)
    docs = to_partials(d, "kaggle", c("doc_id"), {"tmdb_id": c("doc_id"), "imdb_id": c("title")})
    pages = to_partials(p, "tmdb", c("page_id"), {"tmdb_id": c("url_id"), "imdb_id": c("title")})
    return with_cluster_key(docs.unionByName(pages)).select(seq_text(), "cluster_key")


def _reps(t):
    return cut_lineage(representatives(with_cluster_key(roles.partials(t))))


@query(
    "c5_anchor_split",
    with_named(
        """SELECT own_cluster AS cluster_key, has_tmdb AS anchored, title IS NOT NULL AND year IS NOT NULL AS matchable
        FROM exact"""
    ),
)
def c5(t):
    ready = c("title").isNotNull() & c("year").isNotNull()
    df = representatives(with_cluster_key(roles.partials(t)))
    return df.select("cluster_key", c("has_tmdb").alias("anchored"), ready.alias("matchable"))


@query(
    "c6_year_block",
    with_named(
        """SELECT f.own_cluster AS cluster_key, f.year, count(a.year) AS candidates FROM floats f LEFT JOIN anchors a
        ON a.year BETWEEN f.year - 1 AND f.year + 1 GROUP BY ALL"""
    ),
)
def c6(t):
    return fuzzy.candidate_counts(_reps(t))


@query(
    "c7_similar_titles",
    with_named("SELECT DISTINCT fnorm AS norm, fyear AS year, anorm AS anchor_norm, ayear AS anchor_year, ratio FROM pairs"),
)
def c7(t):
    reps = _reps(t)
    found = fuzzy.similar_titles(fuzzy.floating_titles(reps), fuzzy.anchored_titles(reps))
    return found.select("norm", "year", "anchor_norm", "anchor_year", "ratio")


@query(
    "c8_best_match",
    with_named("SELECT fkey AS cluster_key, akey AS anchor_key, ratio, ayear AS anchor_year FROM best"),
)
def c8(t):
    return match_clusters(with_cluster_key(roles.partials(t)))


@query("c9_final_clusters", with_named("SELECT seq, cluster_key FROM final"))
def c9(t):
    return cluster_records(roles.partials(t)).select(seq_text(), "cluster_key")


@query(
    "c11_known_genre_links",
    with_named(
        f"""SELECT movie_id, tmdb_genre_id FROM (SELECT id AS movie_id, unnest(genre_ids)::INT AS tmdb_genre_id FROM api_raw)
        JOIN {SEED_SQL} USING (tmdb_genre_id) EXCEPT SELECT doc_id, 27 FROM docs WHERE lang = 'en' AND n < 10"""
    ),
)
def c11(t):
    items = roles.api_raw(t).select(c("id").alias("movie_id"), F.explode("genre_ids").alias("tmdb_genre_id"))
    seed = t.spark.createDataFrame(GENRE_SEED, "tmdb_genre_id int, name string")
    existing = (
        roles.titled_documents(t)
        .filter("lang = 'en' AND n < 10")
        .select(c("doc_id").alias("movie_id"), F.lit(27).alias("tmdb_genre_id"))
    )
    link = ["movie_id", "tmdb_genre_id"]
    return link_known(items, F.broadcast(seed), "tmdb_genre_id", existing, link)


@query(
    "c12_seed_genres",
    with_named(
        f"""SELECT DISTINCT {by_lang('27', '18', '53', '9648')} AS tmdb_genre_id, 'known' AS name FROM docs WHERE lang <> 'de'
        UNION ALL SELECT * FROM {SEED_SQL} WHERE tmdb_genre_id NOT IN
        (SELECT {by_lang('27', '18', '53', '9648')} FROM docs WHERE lang <> 'de')"""
    ),
)
def c12(t):
    ids = F.when(c("lang") == "en", 27).when(c("lang") == "fr", 18).otherwise(9648)
    existing = t.documents.filter("lang <> 'de'").select(ids.alias("tmdb_genre_id"), F.lit("known").alias("name")).distinct()
    seed = t.spark.createDataFrame(GENRE_SEED, "tmdb_genre_id int, name string")
    return insert_if_absent(existing, seed, ["tmdb_genre_id"])
