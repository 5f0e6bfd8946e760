"""Constraint checks: every function returns the violations as rows `(rule, value, rows)`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shape(df: DataFrame, rule: str, value: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), value.alias("value"), F.col("rows"))


def _text(*columns: str) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def unique(df: DataFrame, columns: list[str], rule: str, primary: bool = False) -> DataFrame:
    """Keys that occur more than once. A null is no value for a unique key, and a violation of a primary one."""
    present = df if primary else df.dropna(subset=columns)
    counted = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    bad = F.col("rows") > 1
    if primary:
        for c in columns:
            bad = bad | F.col(c).isNull()
    return _shape(counted.filter(bad), rule, _text(*columns))


def not_null(df: DataFrame, column: str, rule: str) -> DataFrame:
    counted = df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
    return _shape(counted, rule, F.lit("null"))


def allowed(df: DataFrame, column: str, values, rule: str) -> DataFrame:
    bad = df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return _shape(bad, rule, _text(column))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """Values of the child that the parent does not have. They are reduced to distinct values first, so
    a frequent one weighs nothing in the join."""
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    orphans = values.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")
    return _shape(orphans, rule, _text(column))


def max_length(df: DataFrame, column: str, limit: int, rule: str) -> DataFrame:
    bad = df.filter(F.length(column) > limit).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
    return _shape(bad, rule, F.lit(f"longer than {limit}"))
