"""Linking, fuzzy matching and merging against a plain Python model on small random inputs."""

import random

import pytest
from helpers import clusters, lcs, partial, partials_df, ratio
from pyspark.sql import functions as F

from onefold.functions.similarity import lcs_length
from onefold.operators import fuzzy
from onefold.operators.fuzzy import candidate_counts, similar_titles
from onefold.operators.links import connected_components, link_groups, with_link_keys
from onefold.operators.survive import cluster_records, reconcile, representatives
from onefold.operators.links import with_cluster_key
from onefold.schema import SOURCE_PRIORITY


def found_clusters(spark, rows, **options):
    ordered = sorted(rows, key=lambda r: r["seq"])
    position = {r["seq"]: i for i, r in enumerate(ordered)}
    groups = {}
    for r in cluster_records(partials_df(spark, rows), **options).select("seq", "cluster_key").collect():
        groups.setdefault(r.cluster_key, []).append(position[tuple(r.seq)])
    return {frozenset(m) for m in groups.values()}


def noisy(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randint(0, len(chars))
        if chars and rng.random() < 0.5:
            chars.pop(min(at, len(chars) - 1))
        else:
            chars.insert(at, rng.choice("abé "))
    return "".join(chars)


def random_rows(seed, n=120, length=(1, 25)):
    rng = random.Random(seed)
    titles = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(*length))) for _ in range(12)]
    rows = []
    for i in range(n):
        source = rng.choice(SOURCE_PRIORITY)
        fields = {}
        if source in ("tmdb", "kaggle", "spark"):
            fields["tmdb_id"] = rng.randint(0, 40)
        if source == "imdb":
            fields["imdb_id"] = rng.choice(["", f"tt{rng.randint(0, 30)}"])
            if rng.random() < 0.2:
                fields["tmdb_id"] = rng.randint(0, 40)
        if source != "spark" and rng.random() < 0.9:
            fields["title"] = noisy(rng, rng.choice(titles), rng.randint(0, 3))
        if source != "spark" and rng.random() < 0.9:
            fields["year"] = rng.randint(1990, 1994)
        rows.append(partial(source, i, **fields))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_the_plain_model(spark, seed):
    rows = random_rows(seed)
    assert found_clusters(spark, rows) == clusters(rows)[1]


def test_long_titles_and_other_parameters(spark):
    rows = random_rows(5, n=60, length=(95, 130))
    assert found_clusters(spark, rows) == clusters(rows)[1]
    rows = random_rows(6, n=60)
    options = {"threshold": 40, "tolerance": 2}
    assert found_clusters(spark, rows, **options) == clusters(rows, **options)[1]


@pytest.mark.parametrize(("threshold", "longest"), [(40, 30), (60, 30), (85, 30), (97, 30), (40, 300), (75, 300), (90, 300), (97, 300)])
def test_similar_titles_loses_no_pair(spark, threshold, longest):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, longest))) for _ in range(10)]
    size, edits = (60, 5) if longest == 30 else (18, 60)
    left = sorted({noisy(rng, rng.choice(base), rng.randint(0, edits)) for _ in range(size)} - {""})
    right = sorted({noisy(rng, rng.choice(base), rng.randint(0, edits)) for _ in range(size)} - {""})
    floating = spark.createDataFrame([(t, 2000) for t in left], "norm string, year bigint")
    anchored = spark.createDataFrame([(t, 2001, t) for t in right], "anchor_norm string, anchor_year bigint, anchor string")
    got = {(r.norm, r.anchor_norm, r.ratio) for r in similar_titles(floating, anchored, threshold).collect()}
    expected = {(a, b, ratio(a, b)) for a in left for b in right if ratio(a, b) >= threshold}
    assert got == expected


def test_probes_and_keys_grow_with_the_length_of_titles(spark):
    """Rows per character stay the same, from 30 characters to 3,000."""
    rng = random.Random(4)
    for threshold in (60, 90, 97):
        for size in (30, 300, 3000):
            text = "".join(rng.choice("abcdefghijklmnop") for _ in range(size))
            floating = spark.createDataFrame([(text, 2000)], "norm string, year bigint")
            anchored = spark.createDataFrame([(text, 2000, "x")], "anchor_norm string, anchor_year bigint, anchor string")
            assert fuzzy._probes(floating, threshold).count() <= 5 * size
            assert fuzzy._index(anchored, floating, threshold, 1).count() <= 3 * size


def test_lcs_equals_the_plain_model(spark):
    rng = random.Random(9)
    rows = []
    for n, m in [(0, 5), (1, 1), (40, 62), (62, 62), (63, 63), (61, 300), (124, 125), (187, 400), (400, 2000)]:
        a, b = ("".join(rng.choice("abcdé 😀\n") for _ in range(size)) for size in (n, m))
        rows += [(a, b, lcs(a, b)), (b, a, lcs(a, b)), (a, a, n), (a, noisy(rng, a, 9), None)]
    rows = [(a, b, lcs(a, b) if n is None else n) for a, b, n in rows]
    got = spark.createDataFrame(rows, "a string, b string, n int").repartition(8)
    assert got.filter(F.col("n") != lcs_length(F.col("a"), F.col("b"))).count() == 0


def test_components_of_chain_star_and_cycle(spark):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)]
    edges += [("hub", f"leaf{i}") for i in range(200)] + [("x", "y"), ("y", "z"), ("z", "x"), ("self", "self")]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"c{i:03}"] for i in range(41)} == {"c000"}
    assert {got[f"leaf{i}"] for i in range(200)} == {"hub"}
    assert got["z"] == "x" and "self" not in got


def test_same_id_links_and_other_id_stays_apart(spark):
    rows = [partial("tmdb", 1, tmdb_id=0), partial("kaggle", 2, tmdb_id=0), partial("kaggle", 3, tmdb_id=8)]
    assert found_clusters(spark, rows) == {frozenset({0, 1}), frozenset({2})}
    assert link_groups(partials_df(spark, rows), "tmdb_id").filter("members = 2").count() == 1


def test_transitive_link_through_both_ids(spark):
    rows = [
        partial("tmdb", 1, tmdb_id=5),
        partial("kaggle", 2, tmdb_id=5, imdb_id="tt1"),
        partial("imdb", 3, imdb_id="tt1"),
        partial("imdb", 4, imdb_id=""),
        partial("imdb", 5, imdb_id=""),
    ]
    assert found_clusters(spark, rows) == {frozenset({0, 1, 2}), frozenset({3}), frozenset({4})}


def film(source, key, title, year, **more):
    return partial(source, key, title=title, year=year, **more)


@pytest.mark.parametrize(
    "title, year, linked",
    [("The Texas Chainsaw Massacre", 1974, True), ("The Texas Chainsaw Massacre", 1975, True),
     ("The Texas Chainsaw Massacre", 2001, False), ("A quiet place", 1974, False)],
)
def test_fuzzy_match_by_title_and_year(spark, title, year, linked):
    rows = [film("tmdb", 1, "The Texas Chain Saw Massacre", 1974, tmdb_id=1), film("imdb", 2, title, year, imdb_id="t")]
    assert len(found_clusters(spark, rows)) == (1 if linked else 2)


def test_equal_ratio_prefers_the_earlier_year_unless_asked(spark):
    rows = [
        film("tmdb", 1, "Alien", 1980, tmdb_id=1),
        film("tmdb", 2, "Alien", 1979, tmdb_id=2),
        film("imdb", 3, "alien ", 1980, imdb_id="t"),
    ]
    assert frozenset({1, 2}) in found_clusters(spark, rows)
    assert frozenset({0, 2}) in found_clusters(spark, rows, nearest_year=True)


def test_two_floats_share_one_anchor_but_never_each_other(spark):
    rows = [film("tmdb", 1, "Carrie", 1976, tmdb_id=1)]
    rows += [film("imdb", k, "Carrie", 1976, imdb_id=f"t{k}") for k in (2, 3)]
    rows += [film("rotten_tomatoes", k, "Shutter", 2004) for k in (4, 5)]
    assert sorted(len(c) for c in found_clusters(spark, rows)) == [1, 1, 3]


def test_clusters_without_title_or_year_are_skipped(spark):
    rows = [film("tmdb", 1, "Carrie", None, tmdb_id=1), film("imdb", 2, "Carrie", 1976, imdb_id="t"), partial("imdb", 3, year=1976)]
    assert len(found_clusters(spark, rows)) == 3


def test_candidate_counts(spark):
    rows = [film("tmdb", k, f"T{k}", 1990 + k, tmdb_id=k) for k in range(4)] + [film("imdb", 9, "x", 1991, imdb_id="t"), film("imdb", 10, "x", 1950, imdb_id="u")]
    reps = representatives(with_cluster_key(partials_df(spark, rows)))
    assert {(r.year, r.candidates) for r in candidate_counts(reps).collect()} == {(1991, 3), (1950, 0)}


def test_merge_takes_best_source_and_unions_lists(spark):
    rows = [
        partial("imdb", 1, tmdb_id=7, title="low", genres=["Horror", "Mystery"], imdb_num_votes=5, year=1990),
        partial("tmdb", 2, tmdb_id=7, title="high", overview="", genres=["Horror", "Thriller"], popularity=0.0),
        partial("kaggle", 3, tmdb_id=7, title="mid", overview="text", budget=10),
        partial("elsewhere", 4, tmdb_id=7, title="last", tagline="tag"),
    ]
    got = reconcile(partials_df(spark, rows)).first()
    assert (got.title, got.overview, got.budget, got.popularity, got.tagline) == ("high", "text", 10, 0.0, "tag")
    assert got.genres == ["Horror", "Thriller", "Mystery"]
    assert got.sources == ["tmdb", "kaggle", "imdb", "elsewhere"]


def test_three_sources_end_to_end(spark):
    rows = [
        film("tmdb", 1, "Hereditary", 2018, tmdb_id=1, genres=["Horror"]),
        partial("kaggle", 2, tmdb_id=1, budget=10_000_000),
        film("imdb", 3, "hereditary", 2018, imdb_id="tt7", imdb_average_rating=7.3, genres=["Drama"]),
    ]
    got = reconcile(partials_df(spark, rows)).collect()
    assert len(got) == 1
    assert (got[0].tmdb_id, got[0].imdb_id, got[0].budget, got[0].imdb_average_rating) == (1, "tt7", 10_000_000, 7.3)
    assert got[0].genres == ["Horror", "Drama"]


def test_records_without_a_key_of_their_own_stay_apart(spark):
    """Null, blank and repeated natural keys, whole copies included, in all floating sources."""
    from onefold.plans import adapters as A

    bulk = spark.createDataFrame(
        [(i, t, y) for i, t, y in [(None, "A", 1), (None, "B", 2), (None, "B", 2), (5, "C", 3), (5, "D", 4)]],
        "id long, title string, release_date string",
    )
    for name in ("original_title", "original_language", "overview", "tagline", "collection_name", "status", "genre_names"):
        bulk = bulk.withColumn(name, F.lit(None).cast("string"))
    for name in ("runtime", "budget", "revenue"):
        bulk = bulk.withColumn(name, F.lit(None).cast("long"))
    scraped = spark.createDataFrame(
        [("A", "1"), ("B", "2"), ("B", "2")], "title string, year string"
    ).selectExpr("*", "'' AS tomatometer", "'' AS audience", "'' AS critics_consensus", "array('x') AS genres")
    for found, rows in ((A.kaggle_partials(bulk), 5), (A.rotten_partials(scraped), 3)):
        keys = [r.k for r in found.selectExpr("seq.key AS k").collect()]
        assert len(set(keys)) == rows == len(keys) and None not in keys
    assert with_link_keys(A.rotten_partials(scraped)).select("row_key").distinct().count() == 3
