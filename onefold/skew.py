"""Joins that stay balanced when one key holds a large share of all rows.

A key is *hot* when it holds at least `share` of the rows of the side that is counted, so there can
never be more than `1 / share` hot keys. That bound is what makes it safe to list and broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 500
HOT_ROWS = 50_000
SALTS = 64


def hot_keys(
    df: DataFrame,
    keys: list[str],
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
    rows_per_key: int | None = None,
) -> DataFrame | None:
    """Keys that hold at least `share` of the rows of `df`, or None when there are none.

    At most `1 / share` keys can qualify, and those are among the `1 / share` largest. Keys below
    `rows` rows fit any task and are never treated as hot.
    """
    if rows_per_key is not None and rows_per_key < rows:
        return None
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.filter(F.col("_n") >= rows).orderBy(F.desc("_n")).limit(int(1 / share)).collect()
    if not largest:
        return None
    floor = df.count() * share
    hot = [tuple(r)[:-1] for r in largest if r["_n"] >= floor]
    return df.sparkSession.createDataFrame(hot, df.select(*keys).schema) if hot else None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
    rows_per_key: int | None = None,
) -> DataFrame:
    """Left join to a `right` side that is unique per key.

    Rows of hot keys get their values from a broadcast of the bounded hot part of `right` and are
    spread over salted keys that match nothing, so no task receives a hot key as a whole. Where the
    caller knows that no key has more than `rows_per_key` rows, a small bound saves the search.
    """
    hot = hot_keys(left, keys, share, rows, rows_per_key)
    if hot is None:
        return left.join(right, keys, "left")
    values = [c for c in right.columns if c not in keys]
    marks = F.broadcast(hot.withColumn("_is_hot", F.lit(True)))
    hot_values = F.broadcast(
        right.join(F.broadcast(hot), keys, "left_semi").select(*keys, F.struct(*values).alias("_hot"))
    )
    cold_values = right.select(*keys, F.lit(0).alias("_salt"), F.struct(*values).alias("_cold"))
    alone = F.col("_is_hot").isNotNull()
    for k in keys:
        alone = alone | F.col(k).isNull()
    spread = F.lit(1) + F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
    return (
        left.join(marks, keys, "left")
        .join(hot_values, keys, "left")
        .withColumn("_salt", F.when(alone, spread).otherwise(F.lit(0)))
        .join(cold_values, [*keys, "_salt"], "left")
        .withColumn("_value", F.coalesce("_hot", "_cold"))
        .select(*left.columns, *[F.col("_value")[v].alias(v) for v in values])
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    condition: Column | None = None,
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
    rows_per_key: int | None = None,
) -> DataFrame:
    """Inner join where `left` may have hot keys: those are split over salts, and only the rows of
    `right` that meet a hot key are repeated once per salt.

    Both sides are sorted and merged, never broadcast: rows that multiply after their last shuffle, as salts and the
    substrings of a title do, are not in the size by which Spark would choose a broadcast.
    """
    hot = hot_keys(left, keys, share, rows, rows_per_key)
    if hot is None:
        joined = left.join(right.hint("merge"), keys)
        return joined if condition is None else joined.filter(condition)
    marks = F.broadcast(hot.withColumn("_is_hot", F.lit(True)))
    all_salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted_left = left.join(marks, keys, "left").withColumn(
        "_salt",
        F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")).otherwise(0),
    )
    salted_right = right.join(marks, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_is_hot"), all_salts).otherwise(F.array(F.lit(0))))
    )
    joined = salted_left.drop("_is_hot").join(salted_right.drop("_is_hot").hint("merge"), [*keys, "_salt"])
    if condition is not None:
        joined = joined.filter(condition)
    return joined.drop("_salt")
