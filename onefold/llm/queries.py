"""The registered queries of this subpackage, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onefold.llm import bloom_lm, exact_dedup, fill_middle, language, mixing, neighbours, phrases, pieces, quality, secret_scan, simhash, toxicity, warc
from onefold.llm.shared import fresh, in_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("""
    SELECT doc_id,
           first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
           row_number() OVER w = 1 AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW w AS (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST)
""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


@query()
def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = in_fold("doc_id", 4, 2)
    model = language.train(docs, ~held_out)
    return language.identify(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])


def _spans_sql() -> str:
    """Per rule, the rows `doc_id, start, rank, stop, kind, base` of its matches."""
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        rx = rule.java.replace("'", "''")
        parts.append(f"""
            SELECT doc_id, list_sum(list_transform(pieces[1:i], lambda x: length(x)))
                     + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start,
                   {rank} AS rank, length(hits[i]) AS chars, length(found[i]) AS held,
                   {rule.least} AS least, '{rule.kind}' AS kind, {rule.base} AS base
            FROM (SELECT doc_id, regexp_split_to_array(text, '{rx}') AS pieces,
                         regexp_extract_all(text, '{rx}', 0) AS hits,
                         regexp_extract_all(text, '{rx}', {rule.group}) AS found FROM texts),
                 range(1, len(hits) + 1) AS r(i)""")
    return " UNION ALL ".join(parts)


@query(f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    spans AS (
        SELECT *, kind || ':' || start::BIGINT || ':' || (start + chars)::BIGINT AS label
        FROM ({_spans_sql()}) WHERE held >= least
    ),
    told AS (
        SELECT doc_id,
               count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(label, ',' ORDER BY start, rank) FILTER (base) AS base_spans,
               string_agg(label, ',' ORDER BY start, rank) AS spans
        FROM spans GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN told USING (doc_id)
""")
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, folder, "documents"))


@query()
def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every text, their number, and whether decoding gives the text back."""
    vocabulary = pieces.load_pieces()
    docs = _table(spark, folder, "documents")
    text = fresh("_whole", docs.columns)
    encoded = pieces.encode(docs.withColumn(text, F.coalesce("text", F.lit(""))), vocabulary, ["doc_id", text])
    decoded = pieces.decode(encoded, vocabulary)
    same = F.col("decoded") == F.replace(F.col(text), F.lit(pieces.MARK), F.lit(" "))
    return decoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", same.alias("round_trip"))


@query()
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@query()
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out = in_fold("doc_id", 4, 2)
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality.resample(docs.withColumn("held_out", held_out), labels, ~held_out, ["doc_id", "held_out"])


@query()
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(_table(spark, folder, "documents"))


@query()
def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = _table(spark, folder, "documents"), in_fold("doc_id", 5, 1)
    return bloom_lm.lm_scores(docs.withColumn("held_out", held_out), ~held_out, ["doc_id", "held_out"])


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    held_out = in_fold("doc_id", 4, 2)
    weights, bias = toxicity.train(docs, labels, ~held_out)
    return toxicity.toxicity(docs.withColumn("held_out", held_out), weights, bias, ["doc_id", "held_out"])


def _base32_sql(hexed: str) -> str:
    five = f"('0x' || substr({hexed}, 5 * g + 1, 5))::INTEGER"
    return (
        "list_aggregate(flatten(list_transform(range(8), lambda g: list_transform([15, 10, 5, 0], "
        f"lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({five}) >> s) & 31) + 1, 1)))), 'string_agg', '')"
    )


@query(f"""
    WITH pays AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    firsts AS (
        SELECT *, row_number() OVER w AS nth, first_value(page_id) OVER w AS first_id
        FROM pays WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST)
    )
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32_sql("sha1(html)")} AS payload_digest,
           CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN nth > 1 THEN first_id END AS refers_to
    FROM firsts
""")
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as its record in the archives tells it."""
    read = warc.round_trip(_table(spark, folder, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _fill_sql() -> str:
    marks = " OR ".join(f"contains(text, '{m.decode()}')" for m in fill_middle.SENTINELS.values())
    unit = "('0x' || substr(h, {}, 8))::BIGINT"
    return f"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('{fill_middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h,
               regexp_extract_all(coalesce(text, ''), E'[^\n]*\n|[^\n]+') AS units
        FROM documents
    ),
    drawn AS (
        SELECT doc_id, text, units, len(units) AS n,
               least({unit.format(1)} % (len(units) + 1), {unit.format(9)} % (len(units) + 1)) AS a,
               greatest({unit.format(1)} % (len(units) + 1), {unit.format(9)} % (len(units) + 1)) AS b,
               CASE WHEN text = '' OR {marks} OR {unit.format(17)} % 100 >= 100 THEN 'plain'
                    WHEN {unit.format(25)} % 100 < {fill_middle.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
        FROM cut
    ),
    parts AS (
        SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
               array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
        FROM drawn
    )
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                  WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """


@query(_fill_sql())
def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Forms, cut lengths, the digest of the output, and of the text rebuilt from the output alone."""
    outputs = fill_middle.transformed(_table(spark, folder, "documents"), ["doc_id"])
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return fill_middle.restored(outputs, kept).drop("restored")


def _phrases_sql() -> str:
    low, high = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ratio = "(1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // ({}::HUGEINT * {}::HUGEINT)"
    return f"""
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), '{high}', '{low}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM texts),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
    one AS (SELECT lang, w[i] AS w1, count(*) AS f FROM places GROUP BY ALL),
    two AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM places WHERE i < len(w) GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
    three AS (
        SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
        FROM places WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= {phrases.LEAST}
    ),
    longer AS (
        SELECT lang, w1, w2, max(f) AS f
        FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL
    ),
    pairs AS (
        SELECT lang, w1 || ' ' || w2 AS phrase, two.f AS a, x.f AS l, y.f AS r, longer.f AS longest
        FROM two JOIN one x USING (lang, w1) JOIN one y ON y.lang = two.lang AND y.w1 = two.w2 LEFT JOIN longer USING (lang, w1, w2)
    ),
    triples AS (
        SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2
        FROM three t
        JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
        JOIN one z ON z.lang = t.lang AND z.w1 = t.w3
        JOIN two xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2
        JOIN two yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3
    ),
    cuts AS (SELECT *, {ratio.format("l1", "r1")} AS s1, {ratio.format("l2", "r2")} AS s2 FROM triples),
    candidates AS (
        SELECT lang, phrase, a, l, r, {ratio.format("l", "r")} AS score FROM pairs
        WHERE longest IS NULL OR 100 * longest < {phrases.HALF_PERCENT} * a
        UNION ALL
        SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
        FROM cuts
    ),
    sizes AS (SELECT lang, sum(f) AS n FROM one GROUP BY lang),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM candidates
    )
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked JOIN sizes USING (lang) WHERE rank <= {phrases.TOP}
    """


@query(_phrases_sql())
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))
