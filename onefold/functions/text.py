"""Text, title and list functions, Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A markup tag, and white space in the Unicode sense.
TAG = r"<[^>]+>"
SPACE = r"(?U)[\s\x1c-\x1f]+"
YEAR_SUFFIX = r"\s*\(\d{4}\)\s*$"


def normalize_text(text: Column) -> Column:
    """Drop tags, collapse white space, trim. Null and empty become null; tags alone leave ''."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, TAG, ""), SPACE, " "))
    return F.when(F.length(text) > 0, plain)


def title_key(title: Column) -> Column:
    """Titles are compared trimmed and in lower case; a missing one compares as ''."""
    return F.lower(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def strip_year_suffix(title: Column) -> Column:
    """'Title (2018)' -> 'Title'."""
    return F.trim(F.regexp_replace(title, YEAR_SUFFIX, ""))


def split_list(text: Column, sep: str = ",") -> Column:
    """Separated text to an ordered list of distinct, trimmed, non-blank items; null to an empty list."""
    items = F.transform(F.split(text, sep), lambda x: F.trim(x))
    return F.coalesce(F.array_distinct(F.filter(items, lambda x: x != "")), F.array().cast("array<string>"))


def other_items(text: Column, item: str) -> Column:
    """The comma-separated items without `item`; null to an empty list."""
    return F.coalesce(F.array_remove(F.split(text, ","), item), F.array().cast("array<string>"))


def is_only(text: Column, item: str) -> Column:
    """Whether the trimmed text is exactly `item`."""
    return F.coalesce(F.trim(text) == item, F.lit(False))


def as_list(json_text: Column) -> Column:
    """A JSON list of strings, or one bare string, as a list; null to an empty list."""
    return F.coalesce(
        F.when(F.ltrim(json_text).startswith("["), F.from_json(json_text, "array<string>")).when(
            json_text != "", F.array(json_text)
        ),
        F.array().cast("array<string>"),
    )


def names_of(ids: Column, names: dict[int, str]) -> Column:
    """Dictionary lookup inside an array: order kept, unknown ids dropped."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(
        F.filter(F.transform(ids, lambda i: F.try_element_at(table, i)), lambda n: n.isNotNull()),
        F.array().cast("array<string>"),
    )


def tokens(text: Column, min_length: int = 3) -> Column:
    """Lower-case words of at least `min_length` characters, split on anything but ASCII word characters."""
    return F.filter(F.split(F.lower(text), r"\W+"), lambda w: F.length(w) >= min_length)


def without(words: Column, stop: list[str]) -> Column:
    """Words that are not stop words; repeats stay."""
    return F.filter(words, lambda w: ~w.isin(stop))
