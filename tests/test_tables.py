"""Cleaning, keywords, ids, upserts, checks, the model, files and the whole run, on small inputs."""

import json
import math

import pytest
from helpers import partial, partials_df
from pyspark.sql import functions as F

from onefold.operators import checks, clean, keywords, upsert
from onefold.operators.ids import dense_ids, first_appearance_ids
from onefold.operators.quality import quality_report
from onefold.plans import model
from onefold.plans.adapters import collect_partials, imdb_partials, source_rank
from onefold.plans.gold import build_gold, typed, with_theme
from onefold.plans.run import ingest, run
from onefold.schema import API_SCHEMA, BULK_COLUMNS, GOLD_SCHEMA, TITLE_BASICS_SCHEMA
from onefold.sources import readers, writers


def gold_df(spark):
    rows = [
        partial("tmdb", 1, tmdb_id=1, title="A", year=1990, release_date="1990-05-01", genres=["Horror", "Drama"],
                keywords=["x", "y", "x"], tmdb_vote_average=7.0, tmdb_vote_count=3),
        partial("imdb", 2, imdb_id="t1", title="A", year=1990, imdb_average_rating=6.5),
        partial("rotten_tomatoes", 3, title="a", year=1991, rt_critics_consensus="fine"),
        partial("kaggle", 4, tmdb_id=2, title="B", year=2000, genres=["Horror"], keywords=["z"]),
        partial("kaggle", 5, tmdb_id=3, title="C", year=2000, genres=["horror"]),
    ]
    return build_gold(partials_df(spark, rows), keep_order=True)


def test_gold_model_report_and_reload(spark, tmp_path):
    gold = gold_df(spark)
    assert typed(gold).schema == GOLD_SCHEMA or typed(gold).schema.fieldNames() == GOLD_SCHEMA.fieldNames()
    report = quality_report(typed(gold)).first()
    assert (report.total, report.duplicate_tmdb_id, report.completeness_title, report.multi_source) == (2, 0, 100.0, 1)
    tables = model.normalise(gold, ["first_seq"])
    expected = {"movies": 2, "genres": 2, "movie_genres": 3, "movie_keywords": 3, "ratings": 3, "sources_metadata": 4}
    for _ in range(2):
        writers.publish(spark, tables, str(tmp_path / "model"))
    where = writers.current_snapshot(spark, str(tmp_path / "model"))
    stored = {n: spark.read.parquet(f"{where}/{n}") for n in model.TABLES}
    assert {r.table_name: r.rows for r in model.load_statistics(stored).collect()} == expected
    assert [(r.id, r.name) for r in stored["genres"].orderBy("id").collect()] == [(1, "Horror"), (2, "Drama")]
    assert str(stored["movies"].orderBy("id").first().release_date) == "1990-05-01"
    assert model.violations(stored).count() == 0
    broken = {**stored, "genres": stored["genres"].union(stored["genres"]),
              "ratings": stored["ratings"].withColumn("source", F.lit("other"))}
    rules = {r.rule for r in model.violations(broken).collect()}
    assert {"genres.name unique", "genres.id primary", "ratings.source allowed"} <= rules


def test_empty_gold_has_null_completeness(spark):
    row = quality_report(spark.createDataFrame([], GOLD_SCHEMA)).first()
    assert (row.total, row.completeness_title, row.multi_source) == (0, None, 0)


def test_theme_is_exact(spark):
    df = spark.createDataFrame([(["Horror"],), (["horror"],), ([],), (None,)], "genres array<string>")
    assert with_theme(df).count() == 1


def test_keywords_follow_tf_idf(spark):
    docs = [("1", "ghost ghost castle common"), ("2", "ghost night common"), ("3", "castle night night common"),
            ("x", "night castle common"), ("4", "the of"), ("5", ""), ("6", "ghost ghost castle common"), ("6", "ghost ghost castle common")]
    df = spark.createDataFrame(docs, "id string, overview string")
    got = sorted((r.tmdb_id, r.overview_word_count, tuple(r.keywords)) for r in keywords.text_enrichment(df, k=2).collect())
    # seven documents have text, two of them twice the same; 'common' is in six
    assert [g[:2] for g in got] == [(1, 4), (2, 3), (3, 4), (4, 0), (6, 4), (6, 4)]
    by_id = {g[0]: g[2] for g in got}
    ghost, castle = 2 * math.log(8 / 5), math.log(8 / 6)
    assert ghost > castle and by_id[1] == ("ghost", "castle") and by_id[4] == ()
    assert by_id[3] == ("night", "castle")


def test_term_in_every_document_still_counts(spark):
    df = spark.createDataFrame([("1", "word"), ("2", "word")], "id string, overview string")
    assert [r.keywords for r in keywords.text_enrichment(df).collect()] == [["word"], ["word"]]


def test_dense_ids_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"))
    got = [r.id for r in dense_ids(df, ["k"], partitions=13).orderBy("k").collect()]
    assert got == list(range(1, 5001))
    names = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a")], "o int, v string")
    assert {(r.id, r.v) for r in first_appearance_ids(names, "v", ["o"]).collect()} == {(1, "b"), (2, "a")}


def test_keep_first_and_last_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", "d")], "n int, t string, d string")
    assert {r.n for r in clean.keep_first(df, ["t", "d"], ["n"]).collect()} == {1, 3}
    assert {r.n for r in clean.keep_last(df, ["t", "d"], ["n"]).collect()} == {2, 3}


def test_bulk_clean_repairs_sentinels(spark):
    row = {c: None for c in BULK_COLUMNS} | {"id": 1, "title": "T", "release_date": "x", "tagline": "NA", "budget": 0, "revenue": 5}
    df = spark.createDataFrame([(row["id"], "T", "x", "NA", 0, 5)], "id bigint, title string, release_date string, tagline string, budget bigint, revenue bigint")
    missing = [c for c in BULK_COLUMNS if c not in df.columns]
    got = clean.clean_bulk(df.withColumns({c: F.lit(None).cast("string") for c in missing})).first()
    assert (got.release_date, got.tagline, got.budget, got.revenue) == (None, None, None, 5)


def test_ratings_extract_ignores_case_and_filters(spark):
    basics = spark.createDataFrame(
        [("a", "movie", "A", "A", 1990, 90, "horror"), ("b", "movie", "B", "B", 1960, 90, "Horror"),
         ("c", "short", "C", "C", 1990, 9, "Horror"), ("d", "movie", "D", "D", None, 90, "Horror"),
         ("e", "movie", "E", "E", 1991, None, "Drama,Horror")], TITLE_BASICS_SCHEMA)
    ratings = spark.createDataFrame([("a", 7.0, 1000), ("e", 5.0, 2500), ("b", 5.0, 9999), ("d", 1.0, 9999)], "tconst string, averageRating double, numVotes int")
    got = clean.enrich_ratings(clean.ratings_extract(basics, ratings)).collect()
    assert [(r.tconst, r.decade, r.num_genres, r.score) for r in got] == [("e", "1990s", 2, 250.0), ("a", "1990s", 2, 221.36)]


def test_imdb_adapter_blank_and_zero(spark):
    df = spark.createDataFrame([("", "", 0, None, "Crime,Drama", 5.0, 10)], "tconst string, primaryTitle string, startYear int, runtimeMinutes int, genres string, averageRating double, numVotes int")
    r = imdb_partials(df).first()
    assert (r.imdb_id, r.title, r.release_date, r.genres, r.sources) == (None, None, None, ["Crime", "Drama"], ["imdb"])


def test_unknown_sources(spark):
    assert spark.range(1).select(source_rank(F.lit("elsewhere"))).first()[0] == 5
    with pytest.raises(ValueError, match="nowhere"):
        collect_partials({}, ["nowhere"])
    with pytest.raises(ValueError, match="nowhere"):
        ingest({}, "unused", ["nowhere"])


def test_api_fields(spark):
    got = clean.clean_api(spark.createDataFrame([(5, "<b>T</b>")], "id bigint, title string")).first()
    assert (got.tmdb_id, got.title, got.overview, got.genre_ids) == (5, "T", None, [])
    with pytest.raises(ValueError):
        clean.map_api_fields(spark.createDataFrame([("T",)], "title string"))


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "old", "keep", None), (2, "same", "keep", None)], "k int, v string, other string, at timestamp")
    rows = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (3, "new", 1)], "k int, v string, o int")
    got = {r.k: r for r in upsert.upsert(target, rows, ["k"], ["v"], ["o"], touched="at").collect()}
    assert {k: (r.v, r.other, r.at is not None) for k, r in got.items()} == {
        1: ("last", "keep", True), 2: ("same", "keep", False), 3: ("new", None, True)}
    seeds = upsert.insert_if_absent(target.select("k", "v"), rows.select("k", "v").filter("k <> 1"), ["k"])
    assert sorted(r.k for r in seeds.collect()) == [1, 2, 3]


def test_cascade_delete_and_checks(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (2, "bbbb"), (9, "c"), (None, "d")], "movie_id int, v string")
    _, kept = upsert.delete_cascade(parents, {"c": (child, "movie_id")}, parents.filter("id = 2"))
    assert [r.movie_id for r in kept["c"].collect()] == [1]
    assert [r.value for r in checks.foreign_key(child, "movie_id", parents, "id", "fk").collect()] == ["9"]
    assert checks.max_length(child, "v", 3, "len").first().rows == 1
    assert checks.not_null(child, "movie_id", "nn").first().rows == 1
    assert checks.unique(child.union(child), ["movie_id"], "pk", primary=True).count() == 4


def test_json_array_must_be_a_list(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps([{"tmdb_id": 1, "title": "é"}, {"tmdb_id": 2}], ensure_ascii=False, indent=2))
    bad.write_text('{"tmdb_id": 1}')
    got = readers.read_json(spark, str(good), API_SCHEMA, one_array=True).collect()
    assert [(r.tmdb_id, r.title) for r in got] == [(1, "é"), (2, None)]
    with pytest.raises(Exception, match="list"):
        readers.read_json(spark, str(bad), API_SCHEMA, one_array=True).collect()


def test_csv_and_dump_round_trips(spark, tmp_path):
    text = spark.createDataFrame([("1", 'say "hi", then\nleave', None), ("2", " spaced ", "x")], "id string, title string, overview string")
    writers.write_csv(text, str(tmp_path / "csv"))
    assert sorted(readers.read_csv(spark, str(tmp_path / "csv"), text.schema).collect()) == sorted(text.collect())
    dump = spark.createDataFrame([("a", "movie", '"Quoted', "x", None, 5, None)], TITLE_BASICS_SCHEMA)
    writers.write_dump(dump, str(tmp_path / "dump"))
    assert readers.read_dump(spark, str(tmp_path / "dump"), TITLE_BASICS_SCHEMA).collect() == dump.collect()
    writers.write_dump(dump.withColumn("startYear", F.lit("19x")), str(tmp_path / "bad"))
    with pytest.raises(Exception, match="malformed"):
        readers.read_dump(spark, str(tmp_path / "bad"), TITLE_BASICS_SCHEMA).collect()


def test_parts_hold_every_row_and_replace_old_ones(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("o").alias("overview"))
    for parts in (5, 3):
        writers.write_parts(df, str(tmp_path / "parts"), parts, "id", ["id", "title", "overview"])
    got = spark.read.csv(str(tmp_path / "parts"), header=True).groupBy("part").count().collect()
    assert sorted(r["count"] for r in got) == [2, 4, 4]


def test_run_isolates_a_failure_and_merges_what_is_there(spark, tmp_path):
    def bulk():
        rows = [(1, "A", "1990-01-01", "Horror"), (2, "B", "1991-01-01", "Drama")]
        df = spark.createDataFrame(rows, "id bigint, title string, release_date string, genre_names string")
        return clean.clean_bulk(df.withColumns({c: F.lit(None).cast("string") for c in BULK_COLUMNS if c not in df.columns}))

    def broken():
        raise RuntimeError("down")

    summary = run(spark, {"kaggle": bulk, "tmdb": broken}, str(tmp_path))
    assert summary["ingest"] == {"tmdb": False, "kaggle": True}
    assert summary["gold"]["total"] == 1 and summary["load"]["movies"] == 1
    again = run(spark, {}, str(tmp_path), skip_ingest=True, load=False)
    assert again["gold"] == summary["gold"] and again["load"] is None


def test_json_lists_are_spread_and_anything_else_is_refused(spark, tmp_path):
    schema = "id long, name string"
    want = [(i, f"n,[{i}]") for i in range(500)]
    df = spark.createDataFrame([*want, (500, None)], schema)
    writers.write_json_lists(df, str(tmp_path / "lists"), "id", rows_per_file=100)
    got = readers.read_json(spark, str(tmp_path / "lists"), df.schema, one_array=True).select("id", "name")
    assert sorted(map(tuple, got.collect())) == sorted([*want, (500, None)])
    (tmp_path / "pretty.json").write_text('\n  [\n {"id": 1,\n "name": "a"},\n {"id": 2}\n]\n')
    assert readers.read_json(spark, str(tmp_path / "pretty.json"), df.schema, one_array=True).count() == 2
    (tmp_path / "object.json").write_text('{"id": 1, "name": "[a]"}')
    with pytest.raises(ValueError, match="object.json"):
        readers.read_json(spark, str(tmp_path / "object.json"), df.schema, one_array=True)


def test_broken_rows_are_told_and_the_rest_is_loaded(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, name string").schema
    (tmp_path / "a.json").write_text('{"id": 1, "name": "x"}\n{"id": "z"}\n{"id": 2,\n{"id": 3}\n')
    good, bad = readers.read_isolated(spark, str(tmp_path / "a.json"), schema)
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert sorted(r.raw for r in bad.collect()) == ['{"id": "z"}', '{"id": 2,'] and bad.first().file.endswith("a.json")
    (tmp_path / "b.csv").write_text('id,name\n1,x\ntwo,y\n3,"a, b"\n4,p,q\n')
    good, bad = readers.read_isolated(spark, str(tmp_path / "b.csv"), schema, "csv", header=True)
    assert sorted(map(tuple, good.collect())) == [(1, "x"), (3, "a, b")] and sorted(r.raw for r in bad.collect()) == ["4,p,q", "two,y"]


def test_versions_decide_and_not_clocks(spark, tmp_path):
    root = str(tmp_path / "model")
    tables = lambda n: {"t": spark.createDataFrame([(n,)], "n int")}
    read = lambda: spark.read.parquet(f"{writers.current_snapshot(spark, root)}/t").first().n
    first = writers.publish(spark, tables(1), root)
    assert read() == 1
    # A second writer saw no commit yet and claims the number that is taken: it must take the next one.
    assert not writers.commit(spark, root, 1, "late")
    second = writers.publish(spark, tables(2), root)
    assert read() == 2 and writers.committed(spark, root) == {1: first, 2: second}
    assert writers.commit(spark, root, 7, first) and not writers.commit(spark, root, 7, second)
    assert read() == 1 and writers.publish(spark, tables(3), root) and read() == 3 and max(writers.committed(spark, root)) == 8


def test_a_wanted_source_without_a_job_is_told(spark, tmp_path):
    assert ingest({}, str(tmp_path), ["imdb"]) == {"imdb": False} and ingest({}, str(tmp_path)) == {}


def test_texts_that_only_the_key_needs_are_not_shuffled(spark):
    from onefold.plans.adapters import to_partials

    docs = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c")], "id long, body string")
    rows = to_partials(docs, "kaggle", F.col("id"), {"tmdb_id": F.col("id")})
    assert rows.select("seq").distinct().count() == 3
    plan = rows._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Window":
        plan = plan.children().head()
    assert "body" not in plan.output().mkString(",")
