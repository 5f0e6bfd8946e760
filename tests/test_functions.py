"""Scalar, text and list functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from onefold.functions import scalars as S
from onefold.functions import similarity as M
from onefold.functions import text as X
from onefold.schema import GENRE_NAMES

def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


CASES = [
    ("date", lambda c: S.normalize_date(c), ["1999-12-31", "1999-1-2", "1999", " 78 ", "", "soon", "2023-02-30", None],
     ["1999-12-31", "1999-01-02", "1999-01-01", "78-01-01", None, None, None, None]),
    ("iso", lambda c: S.iso_date(c).cast("string"), ["1999-1-2", "bad", "1999-02-29", None], ["1999-01-02", None, None, None]),
    ("year", lambda c: S.year_of_iso(c), ["1991-05-06", "??", "????-01", None], [1991, None, None, None]),
    ("first year", lambda c: S.first_year(c), ["R, 2018, 2h", "none", None], [2018, None, None]),
    ("int", lambda c: S.to_int(c), ["500.9", " 7 ", "", "NaN", "12d", "x", None], [500, 7, None, None, None, None, None]),
    ("float", lambda c: S.to_float(c), ["7.5", "1e2", "", "x", None], [7.5, 100.0, None, None, None]),
    ("percent", lambda c: S.percent(c), ["90%", "  72 %", "Score", None], [90, 72, None, None]),
    ("na", lambda c: S.na_to_null(c), ["NA", "na", "x", None], [None, "na", "x", None]),
    ("dump null", lambda c: S.dump_null(c), ["\\N", "x"], [None, "x"]),
    ("text", lambda c: X.normalize_text(c), ["<b>a</b>b", " a\t\n b ", "<br>", "", None], ["ab", "a b", "", None, None]),
    ("title key", lambda c: X.title_key(c), ["  The Fog ", None], ["the fog", ""]),
    ("suffix", lambda c: X.strip_year_suffix(c), ["Us (2019) ", "Us", "(1999) Us", None], ["Us", "Us", "(1999) Us", None]),
    ("split", lambda c: X.split_list(c), ["Horror, Drama,,Horror", " ", "", None], [["Horror", "Drama"], [], [], []]),
    ("others", lambda c: X.other_items(c, "Horror"), ["Horror,Drama", "Drama", None], [["Drama"], ["Drama"], []]),
    ("only", lambda c: X.is_only(c, "Horror"), [" Horror ", "Horror,Drama", None], [True, False, False]),
    ("as list", lambda c: X.as_list(c), ['["a","b"]', "a", "", None], [["a", "b"], ["a"], [], []]),
    ("tokens", lambda c: X.tokens(c), ["It's The HAUNTED house!", "a b", ""], [["the", "haunted", "house"], [], []]),
    ("stop", lambda c: X.without(X.tokens(c), ["the"]), ["the fog the fog"], [["fog", "fog"]]),
]


@pytest.mark.parametrize("column, inputs, expected", [k[1:] for k in CASES], ids=[k[0] for k in CASES])
def test_text_in(spark, column, inputs, expected):
    assert values(spark, column(F.col("v")), inputs) == expected


def test_number_functions(spark):
    c = F.col("v")
    assert values(spark, S.decade(c), [1999, 2000, None], "int") == ["1990s", "2000s", None]
    assert values(spark, S.year_start(c), [1999, 0, None], "int") == ["1999-01-01", None, None]
    assert values(spark, S.zero_to_null(c), [0, 5, None], "bigint") == [None, 5, None]
    assert values(spark, S.composite_score(c, F.lit(10_000)), [7.3], "double") == [730.0]


def test_genre_names_keep_order_and_drop_unknown(spark):
    assert values(spark, X.names_of(F.col("v"), GENRE_NAMES), [[27, 99999, 53], [], None], "array<int>") == [["Horror", "Thriller"], [], []]


def test_ratio_counts_a_substitution_twice(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", ""), ("", "a"), ("abc", "abc")], "a string, b string")
    assert [r[0] for r in df.select(M.ratio(F.col("a"), F.col("b"))).collect()] == [62, 100, 0, 100]
