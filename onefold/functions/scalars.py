"""Dates, numbers and sentinels as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a number, a full date and a plain integer look as text.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(inf|infinity|nan)\s*$"
FULL_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def normalize_date(text: Column) -> Column:
    """Full dates become zero-padded ISO text, a bare year becomes its first of January, the rest null."""
    full = F.when(text.rlike(FULL_DATE), F.date_format(F.try_to_date(text, "yyyy-M-d"), "yyyy-MM-dd"))
    year = F.when(text.rlike(WHOLE_NUMBER), F.trim(text).try_cast("decimal(38,0)").cast("string"))
    return F.coalesce(full, F.concat(year, F.lit("-01-01")))


def iso_date(text: Column) -> Column:
    """ISO text to a date; anything else is null."""
    return F.when(text.rlike(FULL_DATE), F.try_to_date(text, "yyyy-M-d"))


def year_of_iso(text: Column) -> Column:
    """The first four characters as a year."""
    head = F.substring(text, 1, 4)
    return F.when((F.length(text) >= 4) & head.rlike(WHOLE_NUMBER), head.try_cast("bigint"))


def first_year(text: Column) -> Column:
    """The first run of four digits as a year."""
    return F.regexp_extract(text, r"\d{4}", 0).try_cast("bigint")


def year_start(year: Column) -> Column:
    """A year as the text of its first day; null and 0 have none."""
    return F.when(year != 0, F.concat(year.cast("string"), F.lit("-01-01")))


def to_float(value: Column) -> Column:
    """Number text to double, bad text to null."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def to_int(value: Column) -> Column:
    """Number text to bigint, cutting off the fraction; bad text to null."""
    return to_float(value).try_cast("bigint")


def percent(text: Column) -> Column:
    """The number in front of the first percent sign."""
    return F.regexp_extract(text, r"(\d{1,3})\s*%", 1).try_cast("bigint")


def decade(year: Column) -> Column:
    """1994 -> '1990s'."""
    return F.concat((F.floor(year / 10) * 10).cast("bigint").cast("string"), F.lit("s"))


def composite_score(rating: Column, votes: Column) -> Column:
    """Rating weighted by the root of its votes, two decimals, ties to even."""
    return F.bround(rating * F.sqrt(votes), 2)


def na_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit("NA"))


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def dump_null(text: Column) -> Column:
    r"""The dump marker `\N` becomes null."""
    return F.nullif(text, F.lit("\\N"))
