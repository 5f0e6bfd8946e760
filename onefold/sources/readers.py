"""Typed readers. Schemas are always given, nothing is inferred from a sample."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from onefold.session import cut_lineage

MAX_AGE_DAYS = 7
SPREAD_BYTES = 32 << 20  # files that one task reads are worth a shuffle from this size on


def read_json(spark: SparkSession, path: str, schema: StructType, one_array: bool = False) -> DataFrame:
    """JSON records. `one_array` reads files that each hold one JSON list; it must be a list.

    Prefer line-delimited files where there is a choice: only those can be split between tasks. A list is read
    record by record, never as one value, and records of large files are spread over the cluster right after the scan.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if not one_array:
        return reader.json(path)
    if not_lists := _files_without_list(spark, path):
        raise ValueError(f"a JSON source must be a list of records: {', '.join(not_lists)}")
    return _spread(spark, path, reader.option("multiLine", True).json(path))


def _spread(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows of files that cannot be split, spread over the cluster; small ones stay in their order."""
    size = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    return rows.hint("rebalance") if size and size >= SPREAD_BYTES else rows


def _files_without_list(spark: SparkSession, path: str, shown: int = 10) -> list[str]:
    """Files below `path` whose text does not begin with a bracket. Texts are cut at commas, so no value is long."""
    parts = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    first = parts.filter("block = 0").withColumn("at", F.monotonically_increasing_id()).groupBy("file")
    first = first.agg(F.min(F.struct("at", F.substring("value", 1, 64).alias("head"))).alias("x"))
    wrong = first.filter(~F.col("x.head").rlike(r"^[\s\x{feff}]*\[")).select("file").orderBy("file").limit(shown)
    return [r["file"] for r in wrong.collect()]


def read_isolated(spark: SparkSession, path: str, schema: StructType, fmt: str = "json", **options) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, and the rejected ones as `file, raw`: broken lines, malformed values.

    For line-delimited JSON and CSV. The scan is written once, so both results come from one reading.
    """
    corrupt = "_corrupt"
    while corrupt in schema.fieldNames():
        corrupt = "_" + corrupt
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    rows = reader.options(**options).format(fmt).load(path)
    rows = cut_lineage(rows.withColumn("_file", F.col("_metadata.file_path")))
    good = rows.filter(F.col(corrupt).isNull()).drop(corrupt, "_file")
    return good, rows.filter(F.col(corrupt).isNotNull()).select(F.col("_file").alias("file"), F.col(corrupt).alias("raw"))


def read_dump(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    r"""Gzipped tab-separated dump: header, no quoting, `\N` for null, a malformed number is an error.

    Columns are found by their header name, the file may hold others. A gzip file is read by one task,
    so its rows are spread over the cluster right after the scan.
    """
    raw = spark.read.csv(path, sep="\t", header=True, nullValue="\\N", quote="")

    def typed(f):
        value = F.col(f.name).try_cast(f.dataType)
        broken = F.col(f.name).isNotNull() & value.isNull()
        error = F.raise_error(F.concat(F.lit(f"{f.name} is malformed: "), F.col(f.name)))
        return F.when(broken, error.cast(f.dataType)).otherwise(value).alias(f.name)

    return raw.select(*[typed(f) for f in schema]).hint("rebalance")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header, quoted text that may run over several lines, and doubled quotes. Takes globs.

    Such a file is read by one task, so rows of large files are spread over the cluster right after the scan.
    """
    rows = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST")
    return _spread(spark, path, rows)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_spread(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A Parquet scan for work that is heavy per row. Files that cannot be split into at least one part
    per core are spread by `key`; a table of many files is read as it is, without a shuffle."""
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_fresh(spark: SparkSession, path: str, fmt: str, schema: StructType, days: float = MAX_AGE_DAYS) -> DataFrame:
    """Only the files below `path` that are younger than `days` days."""
    since = dt.datetime.now(dt.timezone.utc) - dt.timedelta(days=days)
    return (
        spark.read.schema(schema)
        .option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
        .option("timeZone", "UTC")
        .format(fmt)
        .load(path)
    )


def missing_as_empty(spark: SparkSession, read, schema: StructType) -> DataFrame:
    """The result of `read()`, or an empty table when its path does not exist."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def flatten_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Records of landed API result pages, with `page` and `place` in it; pages 1 to `max_pages`."""
    wanted = pages if max_pages is None else pages.filter(F.col("page").between(1, max_pages))
    return wanted.select("page", F.posexplode("results").alias("place", "r")).select("page", "place", "r.*")
