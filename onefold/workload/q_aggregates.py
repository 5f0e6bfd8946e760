"""Aggregates, deduplication, ranking, numbering and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from onefold.operators import clean as C
from onefold.operators import keywords as K
from onefold.operators.ids import dense_ids, first_appearance_ids
from onefold.operators.links import with_cluster_key
from onefold.operators.quality import completeness, duplicates, quality_report
from onefold.operators.survive import cluster_records, merge_lists, merge_scalars, reconcile, representatives
from onefold.plans.adapters import source_rank
from onefold.plans.model import load_statistics, normalise
from onefold.schema import LIST_FIELDS
from onefold.session import cut_lineage
from onefold.workload import roles
from onefold.workload.q_sources import _COUNTS
from onefold.workload.registry import big, listed, query
from onefold.workload.sqlkit import SCALARS, with_named

c = F.col


def _extract(t, ordered=False):
    return C.ratings_extract(roles.title_basics(t), roles.title_ratings(t), ordered=ordered)


@query("d1_group_by_cluster", with_named("SELECT cluster_key, count(*) AS members FROM final GROUP BY 1"))
def d1(t):
    return cluster_records(roles.partials(t)).groupBy("cluster_key").agg(F.count(F.lit(1)).alias("members"))


@query("d2_survivorship", with_named(f"SELECT own_cluster AS cluster_key, {', '.join(SCALARS)} FROM exact"))
def d2(t):
    return merge_scalars(with_cluster_key(roles.partials(t))).drop("first_seq")


@query(
    "d3_list_union",
    with_named(
        f"""SELECT cluster_key, {', '.join(f"coalesce(array_to_string({n}, '|'), '') AS {n}" for n in LIST_FIELDS)}
        FROM u_sources LEFT JOIN u_genres USING (cluster_key) LEFT JOIN u_keywords USING (cluster_key)"""
    ),
)
def d3(t):
    return merge_lists(cluster_records(roles.partials(t))).withColumns(listed(*LIST_FIELDS))


@query("d4_representative", with_named("SELECT own_cluster AS cluster_key, title, year, has_tmdb FROM exact"))
def d4(t):
    return representatives(with_cluster_key(roles.partials(t))).drop("first_seq")


@query("d5_counts", with_named("SELECT count(*) AS total, count(*) FILTER (WHERE genres ILIKE '%horror%') AS themed FROM basics"))
def d5(t):
    return roles.title_basics(t).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(c("genres").ilike("%horror%")).alias("themed")
    )


@query(
    "d6_duplicate_keys",
    "SELECT count(o_custkey) - count(DISTINCT o_custkey) AS by_customer, count(o_orderkey) - count(DISTINCT o_orderkey) AS by_order FROM orders",
)
def d6(t):
    return t.orders.agg(duplicates("o_custkey").alias("by_customer"), duplicates("o_orderkey").alias("by_order"))


@query(
    "d7_completeness",
    with_named(
        """SELECT round(avg((release_date IS NOT NULL)::INT) * 100, 1) AS release_date,
        round(avg((collection_name IS NOT NULL)::INT) * 100, 1) AS collection_name, round(avg((budget IS NOT NULL)::INT) * 100, 1) AS budget
        FROM bulk_clean"""
    ),
)
def d7(t):
    df = C.clean_bulk(roles.bulk_raw(t))
    return df.agg(*[completeness(n).alias(n) for n in ("release_date", "collection_name", "budget")])


@query("d8_multi_source", with_named("SELECT count(*) AS multi_source FROM unified WHERE len(sources) >= 2"))
def d8(t):
    return reconcile(roles.partials(t)).agg(F.count_if(F.size("sources") >= 2).alias("multi_source"))


REPORT = """SELECT count(*) AS total, count(tmdb_id) - count(DISTINCT tmdb_id) AS duplicate_tmdb_id,
    count(imdb_id) - count(DISTINCT imdb_id) AS duplicate_imdb_id,
    round(avg((title IS NOT NULL)::INT) * 100, 1) AS completeness_title, round(avg((year IS NOT NULL)::INT) * 100, 1) AS completeness_year,
    round(avg((release_date IS NOT NULL)::INT) * 100, 1) AS completeness_release_date,
    count(*) FILTER (WHERE len(sources) >= 2) AS multi_source FROM gold"""


@query("d9_quality_report", with_named(REPORT))
def d9(t):
    return quality_report(roles.gold(t))


@query(
    "d10_summary",
    with_named(
        """SELECT count(*) AS films, min(startYear)::BIGINT AS first_year, max(startYear)::BIGINT AS last_year,
        round(avg(averageRating), 2) AS mean_rating, count(*) FILTER (WHERE is_pure_horror) AS pure_horror FROM enriched"""
    ),
)
def d10(t):
    return C.ratings_summary(C.enrich_ratings(_extract(t), ordered=False))


@query("d11_load_statistics", with_named(_COUNTS))
def d11(t):
    return load_statistics(normalise(roles.gold(t), ["first_seq"], surrogate_ids=False))


@query(
    "d12_last_write_wins",
    """SELECT user_id, event_id, event_type, value FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def d12(t):
    return C.keep_last(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("d13_keep_first", with_named("SELECT id, title FROM bulk_clean"))
def d13(t):
    return C.keep_first(roles.bulk_raw(t), ["title", "release_date"], ["id"]).select("id", "title")


@query("d15_term_frequency", with_named("SELECT id, count(*) AS terms, sum(tf)::BIGINT AS words, max(tf) AS most FROM tf GROUP BY id"))
def d15(t):
    tf = K.term_counts(K.term_lists(K.tokenized(roles.text_input(t))))
    return tf.groupBy("id").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("words"), F.max("tf").alias("most")
    )


@query("d16_vocabulary", with_named("SELECT term, df, cf FROM vocab"))
def d16(t):
    return K.vocabulary(K.term_lists(K.tokenized(roles.text_input(t))))


@query("d17_idf", with_named("SELECT term, df, round(idf, 9) AS idf FROM idf"))
def d17(t):
    lists = cut_lineage(K.term_lists(K.tokenized(roles.text_input(t))))
    idf = K.inverse_document_frequency(K.vocabulary(lists), lists)
    return idf.select("term", "df", F.round("idf", 9).alias("idf"))


@query("e1_top_terms", with_named("SELECT id, place, term FROM topk"))
def e1(t):
    lists = cut_lineage(K.term_lists(K.tokenized(roles.text_input(t))))
    top = K.top_terms(lists, K.inverse_document_frequency(K.vocabulary(lists), lists))
    return top.select("id", F.posexplode("keywords").alias("place", "term")).withColumn("place", big("place") + 1)


@query("e2_dense_ids", "SELECT row_number() OVER (ORDER BY source, doc_id) AS id, doc_id FROM documents")
def e2(t):
    return dense_ids(t.documents.select("source", "doc_id"), ["source", "doc_id"]).select("id", "doc_id")


@query(
    "e3_first_appearance_ids",
    "SELECT row_number() OVER (ORDER BY min(doc_id)) AS id, source FROM documents GROUP BY source",
)
def e3(t):
    return first_appearance_ids(t.documents, "source", ["doc_id"])


@query("e4_sort_descending", with_named("SELECT tconst, numVotes FROM extract ORDER BY numVotes DESC, tconst"))
def e4(t):
    return _extract(t, ordered=True).select("tconst", "numVotes")


@query(
    "e5_top_ten",
    with_named(
        """SELECT tconst, primaryTitle, averageRating, numVotes FROM basics JOIN rates USING (tconst)
        WHERE genres ILIKE '%horror%' ORDER BY numVotes DESC, tconst LIMIT 10"""
    ),
)
def e5(t):
    films = roles.title_basics(t).filter(c("genres").ilike("%horror%")).join(roles.title_ratings(t), "tconst")
    top = films.orderBy(F.desc("numVotes"), "tconst").limit(10)
    return top.select("tconst", "primaryTitle", "averageRating", "numVotes")


@query("e6_any_ten")
def e6(t):
    films = roles.title_basics(t).filter(c("genres").ilike("%horror%"))
    return films.select("tconst", "primaryTitle", "startYear", "genres").limit(10)


@query(
    "e7_source_rank",
    """SELECT role AS source, 5 AS rank, count(*) AS rows FROM conversations GROUP BY 1
    UNION ALL SELECT 'kaggle', 2, count(*) FROM documents""",
)
def e7(t):
    names = t.conversations.select(c("role").alias("source")).union(t.documents.select(F.lit("kaggle")))
    return names.groupBy("source", source_rank(c("source")).alias("rank")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "g1_union_partials",
    with_named("SELECT source, source_rank, count(*) AS rows, min(seq) AS first_seq FROM partials GROUP BY ALL"),
)
def g1(t):
    seq = F.min("seq")
    return roles.partials(t).groupBy("source", "source_rank").agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws(":", seq["source_pos"], seq["key"]).alias("first_seq")
    )
