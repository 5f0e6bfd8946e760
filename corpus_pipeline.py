"""A corpus pipeline of five stages. Each stage's result is written as Parquet and read as the next one's input.

So a stage's documents are a plain scan: its rows are known by file and place, and no stage copies them to number them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onefold.llm import exact_dedup, mixing, pieces, quality, simhash
from onefold.llm.shared import fresh, text_of
from onefold.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws; all labels of the folder teach."""
    return quality.sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.keep_distinct(docs, scanned=True)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id."""
    return simhash.keep_one_each(docs, scanned=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passages that the mix takes, as documents."""
    return mixing.mixed_documents(docs, scanned=True)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, source, ids, n_pieces, round_trip` of every passage; the last tells whether decoding gives it back.

    The ids are written before they are decoded: a task that did both would hold two Python workers, and an executor
    keeps as many workers through all stages as its tasks ever held at once.
    """
    vocabulary = pieces.load_pieces()
    text = fresh("_whole", docs.columns)
    encoded = cut_lineage(pieces.encode(docs.withColumn(text, text_of("text")), vocabulary, ["doc_id", "source", text]))
    decoded = pieces.decode(encoded, vocabulary)
    same = F.col("decoded") == F.replace(F.col(text), F.lit(pieces.MARK), F.lit(" "))
    return decoded.select("doc_id", "source", "ids", F.size("ids").alias("n_pieces"), same.alias("round_trip"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", pieces_stage),
]

# Hashed models, fingerprints, draws and merges by rank are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
