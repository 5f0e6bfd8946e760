"""Fields from scraped HTML pages, as column expressions over a table of pages.

The embedded JSON-LD record is the first choice, the page's markup slots are the fallback.
"""

from __future__ import annotations

import json
from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.functions.scalars import first_year, percent, to_int
from onefold.functions.text import TAG, as_list, normalize_text, strip_year_suffix

# How the wanted parts of a page are marked.
COMMENT = r"(?s)<!--.*?-->"
JSONLD = r"(?is)<script\b[^>]*\btype\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
SLOT = r"(?is)<rt-text\b[^>]*>.*?</rt-text>"
CONSENSUS_ID = r"(?is)<([a-z][\w-]*)\b[^>]*\bid\s*=\s*[\"']critics-consensus[\"'][^>]*>(.*)$"
CONSENSUS_LABEL = r"(?s)^.*?Critics Consensus\s*"
RECORD = (
    "struct<name: string, dateCreated: string, datePublished: string, genre: string, aggregateRating: string>"
)
# A character reference: decimal, hexadecimal, or a name; a name may lack the semicolon.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
# Named references as the standard library lists them: all of HTML 5, those that need no semicolon, and, as the
# default, those and the names of HTML 4. A map is part of every plan that holds it, so the default is the small one.
ALL_NAMES = {f"&{name}": text for name, text in html5.items()}
SHORT_NAMES = {n: text for n, text in ALL_NAMES.items() if not n.endswith(";")}
NAMES = {**{f"&{name};": chr(code) for name, code in name2codepoint.items()}, **SHORT_NAMES}
LEGACY = sorted(SHORT_NAMES, key=lambda n: (-len(n), n))
REPLACEMENT = "\ufffd"


def _windows_characters() -> dict[int, str]:
    """What the numbers 128 to 159 stand for in pages: the characters of code page 1252, where it has one."""
    return {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}


def _as_map(entries: dict) -> Column:
    """A map literal from text to text."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _numeric(reference: Column) -> Column:
    """The character of `&#123;` or `&#x7b;`: none for control codes and non-characters."""
    hexed = F.regexp_extract(reference, "(?i)^&#x0*([0-9a-f]*)", 1)
    digits = F.regexp_extract(reference, "^&#0*([0-9]*)", 1)
    is_hex = reference.rlike("(?i)^&#x")
    far = F.when(is_hex, F.length(hexed) > 6).otherwise(F.length(digits) > 7)
    code = F.when(far, F.lit(str(1 << 30))).when(is_hex, F.conv(hexed, 16, 10)).otherwise(digits).try_cast("int")
    code = F.coalesce(code, F.lit(0))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    odd = code.between(1, 8) | code.between(14, 31) | (code == 11) | code.between(127, 159) | code.between(0xFDD0, 0xFDEF)
    return (
        F.when(code.isin(list(_windows_characters())), F.try_element_at(_as_map(_windows_characters()), code.cast("string")))
        .when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit(REPLACEMENT))
        .when(odd | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE), F.lit(""))
        .otherwise(char)
    )


def _named(reference: Column, names: Column) -> Column:
    """The text of a name; of an unknown one the longest beginning that needs no semicolon, or nothing, is resolved."""
    short = F.regexp_extract(reference, "^(?:" + "|".join(LEGACY) + ")", 0)
    begun = F.concat(F.try_element_at(names, short), F.substr(reference, F.length(short) + 1))
    return F.coalesce(F.try_element_at(names, reference), begun, reference)


def unescape(text: Column, names: dict[str, str] = NAMES) -> Column:
    """The text with every character reference resolved once: `&amp;lt;` is `&lt;`. Unknown names stay as they are."""
    hits = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))

    def resolved(known: Column) -> Column:
        found = F.transform(hits, lambda h: F.when(h.startswith("&#"), _numeric(h)).otherwise(_named(h, known)))
        pieces = F.zip_with(F.split(text, REFERENCE, -1), found, lambda piece, char: F.concat(piece, F.coalesce(char, F.lit(""))))
        return F.array_join(pieces, "")

    once = F.element_at(F.transform(F.array(_as_map(names)), resolved), 1)
    return F.when(text.contains("&"), once).otherwise(text)


def inner_text(markup: Column, glue: str = "") -> Column:
    """The text pieces between tags, each trimmed, empty ones dropped, joined by `glue`."""
    pieces = F.transform(F.split(markup, TAG), lambda p: F.regexp_replace(unescape(p), r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.filter(pieces, lambda p: p != ""), glue)


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first `<tag>` element, null when there is none."""
    return inner_text(F.nullif(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", 0), F.lit("")))


def slot_elements(html: Column) -> Column:
    """All slot elements of a page, with their markup."""
    found = F.regexp_extract_all(html, F.lit(SLOT), 0)
    return F.when(html.contains("<rt-text"), found).otherwise(F.array().cast("array<string>"))


def named_slots(slots: Column, name: str) -> Column:
    return F.filter(slots, lambda s: s.rlike(rf"(?is)^<rt-text\b[^>]*\bslot\s*=\s*[\"']{name}[\"']"))


def slot_text(slots: Column, name: str) -> Column:
    """Text of the first slot of that name, null when the page has none."""
    return inner_text(F.try_element_at(named_slots(slots, name), F.lit(1)))


def jsonld_record(html: Column) -> Column:
    """The first record with a name among all JSON-LD blocks; a block holds one record or a list."""
    texts = F.flatten(
        F.transform(
            F.regexp_extract_all(html, F.lit(JSONLD), 1),
            lambda s: F.coalesce(
                F.when(F.ltrim(s).rlike(r"^\s*\["), F.from_json(s, "array<string>")).otherwise(F.array(s)),
                F.array().cast("array<string>"),
            ),
        )
    )
    records = F.transform(texts, lambda s: F.from_json(s, RECORD))
    return F.try_element_at(F.filter(records, lambda r: r["name"] != ""), F.lit(1))


def element_text(tag: Column, rest: Column) -> Column:
    """Text of the element `tag` from the markup behind its opening, pieces joined by a space.

    The element ends where its own tag is closed as often as it was opened.
    """
    parts = F.regexp_extract_all(rest, F.lit(r"(?s)<[^>]*>|[^<]+"), 0)

    def walk(state: Column, part: Column) -> Column:
        name = F.regexp_extract(F.lower(part), r"^</?([a-z][\w-]*)", 1)
        step = F.when(name != F.lower(tag), 0).when(part.startswith("</"), -1).otherwise(1)
        open_now = state["depth"] > 0
        return F.struct(
            F.when(open_now, state["depth"] + step).otherwise(F.lit(0)).alias("depth"),
            F.when(open_now & ~part.startswith("<"), F.concat(state["text"], F.array(part)))
            .otherwise(state["text"])
            .alias("text"),
        )

    start = F.struct(F.lit(1).alias("depth"), F.array().cast("array<string>").alias("text"))
    pieces = F.aggregate(parts, start, walk, lambda s: s["text"])
    clean = F.transform(pieces, lambda p: F.regexp_replace(unescape(p), r"^\s+|\s+$", ""))
    return F.array_join(F.filter(clean, lambda p: p != ""), " ")


def consensus_text(tag: Column, rest: Column) -> Column:
    """The consensus without its label; blank becomes null."""
    return F.nullif(F.trim(F.regexp_replace(element_text(tag, rest), CONSENSUS_LABEL, "")), F.lit(""))


def page_records(pages: DataFrame) -> DataFrame:
    """`page_id, title, year, genres, tomatometer, audience, critics_consensus` from `page_id, html`.

    The large text is searched once per kind of part, behind a plain substring test; the fields are
    then taken from the short pieces found.
    """
    html, ld, slots = F.col("html"), F.col("ld"), F.col("slots")
    element = F.when(html.contains("critics-consensus"), F.nullif(F.regexp_extract(html, CONSENSUS_ID, 0), F.lit("")))
    found = (
        pages.select(
            "page_id", F.when(html.contains("<!--"), F.regexp_replace(html, COMMENT, "")).otherwise(html).alias("html")
        )
        .select(
            "page_id",
            F.when(html.contains("ld+json"), jsonld_record(html)).alias("ld"),
            slot_elements(html).alias("slots"),
            element.alias("element"),  # from here to the end; its tag is found again at once, without the page before it
        )
    )
    rating = F.from_json(ld["aggregateRating"], "struct<name: string, ratingValue: string>")
    slot_years = F.filter(
        F.transform(named_slots(slots, "metadata-prop"), lambda s: first_year(F.regexp_replace(s, TAG, ""))),
        lambda y: y.isNotNull() & (y != 0),
    )
    tomato = F.when(F.lower(rating["name"]).startswith("tomato"), to_int(rating["ratingValue"]))
    return found.select(
        "page_id",
        strip_year_suffix(F.coalesce(ld["name"], slot_text(slots, "title"))).alias("title"),
        F.coalesce(
            first_year(F.coalesce(F.nullif(ld["dateCreated"], F.lit("")), ld["datePublished"])),
            F.try_element_at(slot_years, F.lit(1)),
        ).alias("year"),
        as_list(ld["genre"]).alias("genres"),
        F.coalesce(tomato, percent(slot_text(slots, "critics-score"))).alias("tomatometer"),
        percent(slot_text(slots, "audience-score")).alias("audience"),
        F.when(
            F.col("element").isNotNull(),
            consensus_text(F.regexp_extract("element", CONSENSUS_ID, 1), F.regexp_extract("element", CONSENSUS_ID, 2)),
        ).alias("critics_consensus"),
    )


def clean_scraped(records: DataFrame) -> DataFrame:
    """Scraped records ready for harmonisation: untitled ones dropped, text normalised, genres never null.

    Titles go through an explode of one, which a filter on them stays above: below the extraction, it would make the
    titles from whole pages a second time.
    """
    titles = records.withColumn("title", F.explode_outer(F.array("title")))
    return titles.filter(F.col("title") != "").withColumns(
        {
            "title": normalize_text(F.col("title")),
            "genres": F.coalesce("genres", F.array().cast("array<string>")),
            "critics_consensus": normalize_text(F.col("critics_consensus")),
        }
    )
