"""Plans whose driver memory must not grow with rows that Spark cannot count."""

import pytest

from onefold.llm import simhash


@pytest.mark.parametrize("hot", [20_000, 1])
def test_keys_and_midpoints_of_fingerprints_are_never_broadcast(spark, hot):
    """A fingerprint has dozens of keys and 2,081 midpoints, of which Spark's size of the table knows nothing."""
    classes = spark.createDataFrame([(0,), (1,), (7,), (1 << 40,)], "fp long")
    found = simhash.links(classes, hot)
    assert {x for r in found.collect() for x in r} == {0, 1, 7, 1 << 40}
    plan = found._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    joins = [x for x in plan.splitlines() if "Join" in x and "LeftAnti" not in x and "LeftSemi" not in x]
    assert joins and not [x for x in joins if "Broadcast" in x]
