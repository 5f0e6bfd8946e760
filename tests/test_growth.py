"""Plans that must stay bounded in memory when the tables grow."""

from onefold.operators.fuzzy import similar_titles


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_substrings_of_titles_are_never_broadcast(spark):
    """They multiply after the last shuffle, so the size that Spark sees tells nothing about them."""
    floating = spark.createDataFrame([("the house by the river", 2000), ("a long way from home", 2001)], "norm string, year int")
    anchored = spark.createDataFrame([("the house by a river", 2000, 1), ("a long way from rome", 2001, 2)], "anchor_norm string, anchor_year int, anchor int")
    found = similar_titles(floating, anchored, 80)
    plan = final_plan(found).split("+- == Initial Plan ==")[0]
    assert found.count() == 2
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "segment" in x]
    assert [x for x in plan.splitlines() if "SortMergeJoin" in x and "segment" in x]
