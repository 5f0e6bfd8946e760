"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every scan partition is one run: its rows reduced to one row per digest. Runs then meet in rounds, as
in a binomial exchange: round j lets the runs that differ in digit j of their number trade rows, each
taking the digests whose own digit j it has. A round merges `fan_in` sorted runs, so a digest held by
a third of all rows reaches a task as at most `fan_in` rows. After the last round each digest has one
row, which knows the identifier that stays and the size of its group.

Digests are SHA-256. At every level rows only merge if length and an independent 64-bit hash of the
text agree as well; texts that differ there stay apart.

Null texts count as empty. Of rows that share the largest identifier exactly one stays; a null
identifier is smaller than any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.llm.shared import identified, text_of, without_rows
from onefold.session import cut_lineage

FAN_IN = 16
TEXT = ["digest", "second", "chars"]


def digest_rows(docs: DataFrame, id_column: str, text_column: str, row: Column | None = None) -> DataFrame:
    """`row, id, run, digest, second, chars` of every row, written once."""
    text = text_of(text_column)
    return cut_lineage(
        docs.select(
            (F.monotonically_increasing_id() if row is None else row).alias("row"),
            F.col(id_column).alias("id"),
            F.spark_partition_id().cast("bigint").alias("run"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.xxhash64(text).alias("second"),
            F.length(text).alias("chars"),
        )
    )


def sorted_runs(rows: DataFrame) -> DataFrame:
    """One row per run and digest: the largest (id, row) and the number of copies."""
    return rows.groupBy("run", *TEXT).agg(
        F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("copies")
    )


def merge_tree(runs: DataFrame, run_count: int, fan_in: int = FAN_IN) -> DataFrame:
    """One row per digest after all rounds."""
    levels = 0
    while fan_in**levels < run_count:
        levels += 1
    home = F.pmod(F.col("second"), F.lit(max(1, fan_in**levels)))
    merged = runs.withColumnRenamed("run", "slot")
    for level in range(levels):
        step = fan_in**level
        digit = lambda c, step=step: F.pmod(F.floor(c / step), F.lit(fan_in))
        moved = F.col("slot") + (digit(home) - digit(F.col("slot"))) * step
        merged = (
            merged.withColumn("slot", moved)
            .groupBy("slot", *TEXT)
            .agg(F.max("best").alias("best"), F.sum("copies").alias("copies"))
        )
    return merged.drop("slot") if levels else merged.groupBy(*TEXT).agg(
        F.max("best").alias("best"), F.sum("copies").alias("copies")
    )


def decisions(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Every row with the row that stays for its text: `row, id, keep_id, group_size, kept, digest`.

    Results go back down the tree: first to the runs, one row for each run and digest, then to the
    rows of a run. Neither join meets more rows of a key than there are runs or rows in a run.
    """
    last = rows.agg(F.max("run")).first()[0]
    runs = sorted_runs(rows)
    final = merge_tree(runs, 0 if last is None else last + 1, fan_in)
    answers = runs.select("run", *TEXT).join(final, TEXT)
    return rows.join(answers, ["run", *TEXT]).select(
        "row",
        "id",
        F.col("best.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"),
        "digest",
    )


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, `keep_id`, `group_size`, `kept` and the text's SHA-256 in hex."""
    return decisions(digest_rows(docs, id_column, text_column)).select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_distinct(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scanned: bool = False
) -> DataFrame:
    """The documents that stay, with all their columns. For `scanned` see `shared.identified`."""
    rows, name = identified(docs, scanned)
    found = decisions(digest_rows(rows, id_column, text_column, F.col(name)))
    kept = without_rows(rows, name, found.filter(~F.col("kept")).select(F.col("row").alias(name)))
    return kept.select(*[kept[c] for c in docs.columns])
