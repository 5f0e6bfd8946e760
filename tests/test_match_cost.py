"""What the match does for each pair of titles that share a segment."""

import random

from pyspark.sql import functions as F

from onefold.functions.similarity import PROFILE_WORDS, profile, profile_distance
from onefold.operators.fuzzy import similar_titles


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row
        row = [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[-1]))
    return row[-1]


def test_profiles_never_exceed_the_distance(spark):
    random.seed(3)
    texts = ["".join(random.choices("abcdé ñ中𝄞z", k=random.randint(1, 60))) for _ in range(40)] + ["e" * 30, "e" * 46, "x"]
    pairs = [(a, b) for a in texts for b in texts]
    words = lambda c: [profile(F.col(c))[n] for n in range(PROFILE_WORDS)]
    bounds = spark.createDataFrame(pairs, "a string, b string").select("a", "b", profile_distance(words("a"), words("b")).alias("n"))
    found = {(r.a, r.b): r.n for r in bounds.collect()}
    assert all(n <= len(a) + len(b) - 2 * lcs(a, b) for (a, b), n in found.items())
    assert found[("e" * 30, "x")] > 0 and all(found[(t, t)] == 0 for t in texts)


def test_a_pair_is_verified_once_behind_the_cheap_conditions(spark):
    """Spark takes what a condition names twice out of it and computes it for every pair, whatever is false before."""
    floating = spark.createDataFrame([("the house by the river", 2000), ("a long way from home", 2001)], "norm string, year int")
    anchored = spark.createDataFrame([("the house by a river", 2000, 1), ("a long way from rome", 2001, 2)], "anchor_norm string, anchor_year int, anchor int")
    found = similar_titles(floating, anchored, 80)
    assert found.count() == 2
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x and "segment" in x]
    assert "exists(" not in "".join(joins)  # lambdas keep Spark from generating code for a join
    assert joins and all(x.count("levenshtein(") == 1 and "regexp_extract_all" not in x for x in joins)
    assert all(x.index("bit_count(") < x.index("last_found") < x.index("levenshtein(") for x in joins)
