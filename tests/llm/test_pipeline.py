from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from onefold.llm import mixing, pieces, quality
from onefold.llm.queries import CHECKS, QUERIES
from compare import compare, duck
from fixtures import documents
from test_dedup import components_brute, fingerprint_brute

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = quality.resample(docs, labels, F.lit(True), ["doc_id"]).filter("kept")
    texts = dict(docs.join(kept, "doc_id", "left_semi").select("doc_id", "text").collect())
    last = {t: i for i, t in sorted(texts.items(), key=lambda x: x[0])}
    distinct = sorted(last.values())
    label = components_brute([fingerprint_brute(texts[i]) for i in distinct])
    firsts = sorted({min(i for i, x in zip(distinct, label, strict=True) if x == own) for own in set(label)})
    stage = docs.filter(F.col("doc_id").isin(firsts))
    mixed = mixing.mixed_documents(stage).select("doc_id", "text").collect()
    walker = pieces.Walker(pieces.load_pieces())
    want = sorted((r.doc_id, ids.tolist()) for r, ids in zip(mixed, walker.encode_texts([r.text for r in mixed]), strict=True))
    got = sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == want and len(np.unique([i for i, _ in got])) == len({i for i, _ in want})


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(50), FOLDER).columns == docs.columns


def test_last_stage_decodes_what_it_encodes(spark, monkeypatch):
    docs = documents(spark)
    rows = corpus_pipeline.pieces_stage(spark, docs, FOLDER).collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    real = pieces.decode
    monkeypatch.setattr(pieces, "decode", lambda df, v: real(df, v).withColumn("decoded", F.concat("decoded", F.lit("x"))))
    assert not any(r.round_trip for r in corpus_pipeline.pieces_stage(spark, docs, FOLDER).collect())


def test_a_task_of_the_last_stage_holds_one_python_worker(spark):
    plan = corpus_pipeline.pieces_stage(spark, documents(spark), FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_queries_equal_their_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), duck(FOLDER), CHECKS[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert Path(corpus_pipeline.__file__).parent == Path(entry.__file__).parent
