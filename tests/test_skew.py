"""The skew-safe joins give the rows of the plain joins, with hot keys and null keys present."""

from onefold.skew import hot_keys, lookup_join, salted_join


def sides(spark):
    left = spark.createDataFrame([(1 if i % 3 else (i if i % 2 else None), i) for i in range(600)], "k int, v int")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 600, 3)] + [(1, 11)], "k int, w int")
    return left, right


def rows(df):
    return sorted(map(str, df.select("k", "v", "w").collect()))


def test_hot_keys_are_found_and_bounded(spark):
    left, _ = sides(spark)
    assert [r.k for r in hot_keys(left, ["k"], share=0.1, rows=10).collect()] == [1]
    assert hot_keys(left, ["k"]) is None


def test_lookup_join_equals_left_join(spark):
    left, right = sides(spark)
    assert rows(lookup_join(left, right, ["k"], share=0.1, rows=10)) == rows(left.join(right, ["k"], "left"))
    without_hot = right.filter("k <> 1")
    assert rows(lookup_join(left, without_hot, ["k"], share=0.1, rows=10)) == rows(left.join(without_hot, ["k"], "left"))


def test_salted_join_equals_inner_join(spark):
    left, right = sides(spark)
    double = right.union(right)
    assert rows(salted_join(left, double, ["k"], share=0.1, rows=10)) == rows(left.join(double, ["k"]))
