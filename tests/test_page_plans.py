"""Pages are searched once."""

from onefold.operators.pages import clean_scraped, page_records


def test_untitled_pages_are_dropped_after_the_extraction(spark):
    """A filter on the title below the extraction searched whole pages a second time."""
    pages = spark.createDataFrame([(1, '<rt-text slot="title">A <b>b</b></rt-text>'), (2, "<p>none</p>")], "page_id long, html string")
    clean = clean_scraped(page_records(pages))
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "html" in x]
    assert [(r.page_id, r.title) for r in clean.collect()] == [(1, "Ab")]
