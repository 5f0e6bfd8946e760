"""Passed columns and extra columns whose names an operator uses itself."""

from collections import Counter

import pytest
from fixtures import documents
from pyspark.sql import functions as F

from onefold.llm import bloom_lm, exact_dedup, fill_middle, language, mixing, neighbours, phrases, pieces, quality, secret_scan, simhash, toxicity, warc

NAMES = ["score", "_text", "held_out", "fp", "row", "id", "lang_pred", "predicted", "kept", "_row", "_chunk", "n", "ids", "weight", "digest", "run", "size", "sid", "place", "length", "key", "found", "k1"]


@pytest.fixture(scope="module")
def docs(spark):
    plain = documents(spark).select("doc_id", "text", "lang", "source")
    return plain.select("*", *[F.concat(F.lit(f"{name}:"), F.col("doc_id").cast("string")).alias(name) for name in NAMES]).cache()


def passing(spark, docs, columns):
    labels = spark.createDataFrame([(4, 1, 0), (9, 1, 0), (12, 0, 1), (13, 0, 0)], "doc_id long, quality int, toxic int")
    vocabulary = pieces.load_pieces()
    weights, bias = toxicity.train(docs, labels, F.lit(True))
    return {
        "language": lambda: language.identify(docs, language.train(docs, F.lit(True)), columns),
        "pieces": lambda: pieces.decode(pieces.encode(docs, vocabulary, columns, name="_ids"), vocabulary, "_ids"),
        "quality": lambda: quality.resample(docs, labels, F.lit(True), columns),
        "lm": lambda: bloom_lm.lm_scores(docs, F.lit(True), columns),
        "toxicity": lambda: toxicity.toxicity(docs, weights, bias, columns),
        "fill": lambda: fill_middle.transformed(docs, columns),
    }


@pytest.mark.parametrize("name", ["language", "pieces", "quality", "lm", "toxicity", "fill"])
def test_passed_columns_keep_names_and_values(spark, docs, name):
    columns = ["doc_id", *NAMES]
    made = passing(spark, docs, columns)[name]()
    assert made.columns[: len(columns)] == columns and len({c.lower() for c in made.columns}) == len(made.columns)
    assert Counter(made.select(*columns).collect()) == Counter(docs.select(*columns).collect())


def test_extra_columns_change_nothing(spark, docs):
    plain = docs.select("doc_id", "text", "lang", "source")
    same = lambda f: Counter(map(tuple, f(docs).collect())) == Counter(map(tuple, f(plain).collect()))
    for f in (exact_dedup.exact_duplicates, simhash.near_duplicates, secret_scan.secret_report, mixing.mix_report):
        assert same(f), f.__name__
    assert same(lambda df: phrases.collocations(df, least=2, top=20))
    for f in (exact_dedup.keep_distinct, simhash.keep_one_each, mixing.mixed_documents):
        assert f(docs).columns == docs.columns
        assert Counter(f(docs).select("doc_id", "text").collect()) == Counter(f(plain).select("doc_id", "text").collect()), f.__name__


def test_extra_columns_of_vectors_and_pages(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], f"u{i}", "<p>x</p>", i, i, i) for i in range(45)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>, url string, html string, id long, rank long, score long")
    found = neighbours.nearest(wide, F.col("id") % 20 == 0, leaves=10_000).collect()
    assert Counter(found) == Counter(neighbours.nearest(wide.select("vec_id", "embedding"), F.col("id") % 20 == 0, leaves=10_000).collect())
    pages = wide.withColumnRenamed("vec_id", "page_id")
    assert Counter(r.record_type for r in warc.round_trip(pages).collect()) == {"response": 1, "revisit": 44}
