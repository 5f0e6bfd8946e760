"""Page extraction on small hand-made pages."""

import html
import random

from pyspark.sql import functions as F

from onefold.operators.pages import ALL_NAMES, NAMES, clean_scraped, page_records, unescape

RECORD = """<script type="application/ld+json">{"name": "The Hollow (2011)", "dateCreated": "2011-10-07",
"genre": ["Horror", "Drama"], "aggregateRating": {"name": "TOMATOmeter", "ratingValue": "81.0"}}</script>"""
SLOTS = """<rt-text slot="title">Slot &amp; Title</rt-text><rt-text slot='metadata-prop'>R</rt-text>
<rt-text slot="metadata-prop"> 1998, 1h</rt-text><rt-text slot="critics-score"><b>64</b>%</rt-text>
<rt-text slot="audience-score"> 7 % </rt-text>"""
CONSENSUS = """<div id="critics-consensus"><div>Fresh</div> Critics Consensus <p>Slow, <i>but</i> good.</p></div><div>not this</div>"""


def extract(spark, html):
    return page_records(spark.createDataFrame([(1, html)], "page_id bigint, html string")).first()


def test_record_comes_first(spark):
    r = extract(spark, f"<html>{RECORD}{SLOTS}{CONSENSUS}</html>")
    assert (r.title, r.year, r.genres, r.tomatometer, r.audience) == ("The Hollow", 2011, ["Horror", "Drama"], 81, 7)
    assert r.critics_consensus == "Slow, but good."


def test_slots_are_the_fallback(spark):
    r = extract(spark, f"<script type='application/ld+json'>{{bad</script>{SLOTS}")
    assert (r.title, r.year, r.genres, r.tomatometer, r.critics_consensus) == ("Slot & Title", 1998, [], 64, None)


def test_other_rating_and_single_genre(spark):
    ld = '[{"name": ""}, {"name": "X", "genre": "Horror", "aggregateRating": {"name": "Other", "ratingValue": "3"}}]'
    r = extract(spark, f'<script type="application/ld+json">{ld}</script><rt-text slot="critics-score">55%</rt-text>')
    assert (r.title, r.genres, r.tomatometer) == ("X", ["Horror"], 55)


def test_empty_page_and_commented_markup(spark):
    r = extract(spark, "<html><body></body></html>")
    assert list(r)[1:] == [None, None, [], None, None, None]
    assert extract(spark, '<!-- <rt-text slot="title">T</rt-text> -->').title is None


def test_blank_consensus_and_untitled_rows(spark):
    assert extract(spark, '<p id="critics-consensus"> Critics Consensus </p>').critics_consensus is None
    rows = [(1, "", ["a"], "x"), (2, " A  <i>b</i>", None, None), (3, None, None, None)]
    df = spark.createDataFrame(rows, "page_id int, title string, genres array<string>, critics_consensus string")
    got = clean_scraped(df).collect()
    assert [(r.page_id, r.title, r.genres) for r in got] == [(2, "A b", [])]


def test_references_equal_the_standard_library(spark):
    rng = random.Random(3)
    names = ["amp", "lt", "gt", "quot", "nbsp", "copy", "copyright", "notin", "notit", "not", "nosuch", "eacute", "Eacute", "hellip", "CounterClockwiseContourIntegral", "am", "a", "ampx"]
    numbers = ["65", "0", "1", "11", "13", "31", "127", "128", "129", "150", "160", "8364", "55296", "64976", "65534", "128512", "1114111", "1114112", "99999999999999999999", "0000065"]
    parts = [f"&{n}{e}" for n in names for e in (";", "", " ", ";;", "=")] + [f"&#{n}{e}" for n in numbers for e in (";", "", " x")]
    parts += [f"&#{x}{int(n):x}{e}" for n in numbers for x in "xX" for e in (";", "", "g")] + ["&", "&&amp;", "&;", "&#;", "&#x;", "&#xg;", "plain", "é", "&amp;lt;", "&amp;amp;"]
    rows = [(p,) for p in parts] + [("".join(rng.choice([*parts, "text ", "<"]) for _ in range(12)),) for _ in range(200)] + [("",)]
    texts = spark.createDataFrame(rows, "t string")
    for names, known in ((ALL_NAMES, rows), (NAMES, [r for r in rows if "Integral" not in (r[0] or "")])):
        got = texts.join(spark.createDataFrame(known, texts.schema).distinct(), "t", "left_semi").select("t", unescape(F.col("t"), names).alias("u"))
        assert [(r.t, r.u) for r in got.collect() if r.u != html.unescape(r.t)] == []
