"""Sinks. Every one is a plain parallel Spark write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from onefold.operators.ids import dense_ids


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One record per line, UTF-8, characters kept as they are; nulls are written out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; lists become JSON text, white space and line breaks stay."""
    flat = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.mode(mode).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_dump(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    r"""Gzipped tab-separated files with header and `\N` for null, unquoted."""
    df.write.mode(mode).csv(
        path,
        sep="\t",
        header=True,
        nullValue="\\N",
        quote="",
        compression="gzip",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_once(df: DataFrame, path: str, force: bool = False) -> None:
    """Does nothing when the output exists, unless `force`."""
    write_parquet(df, path, "overwrite" if force else "ignore")


def write_parts(df: DataFrame, path: str, parts: int, key: str, columns: list[str]) -> None:
    """CSV in `parts` runs of equal length in the order of the unique `key`; older parts are replaced.

    One part is one folder `part=N`, so that a part too large for one file may have several.
    """
    numbered = dense_ids(df.select(*columns), [key], "_row")
    run = F.greatest(F.ceil(F.max("_row") / parts), F.lit(1))
    length = numbered.agg(run.alias("n")).scalar()
    cut = numbered.withColumn("part", F.floor((F.col("_row") - 1) / length).cast("int")).drop("_row")
    (
        cut.write.mode("overwrite")
        .partitionBy("part")
        .csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )


def append_log(df: DataFrame, path: str) -> None:
    """Append-only log of what was loaded, with the time of loading."""
    df.withColumn("ingested_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_json_lists(df: DataFrame, path: str, key: str, rows_per_file: int = 20_000) -> None:
    """JSON files that each hold one list of records, of about `rows_per_file`, in the order of `key` within a file."""
    files = 1 + df.count() // rows_per_file
    rows = df.select(
        F.pmod(F.xxhash64(key), F.lit(files)).cast("int").alias("part"),
        F.lit(1).alias("kind"),
        F.col(key).alias("place"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
    )
    first = F.row_number().over(Window.partitionBy("part").orderBy("place")) == 1
    rows = rows.withColumn("value", F.when(first, F.col("value")).otherwise(F.concat(F.lit(","), "value")))
    none = F.lit(None).cast(df.schema[key].dataType)
    for kind, mark in ((0, "["), (2, "]")):
        ends = df.sparkSession.range(files).select(F.col("id").cast("int").alias("part"), F.lit(kind).alias("kind"), none.alias("place"), F.lit(mark).alias("value"))
        rows = rows.unionByName(ends)
    rows = rows.repartition("part").sortWithinPartitions("part", "kind", "place")
    rows.select("part", "value").write.mode("overwrite").partitionBy("part").text(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> str:
    """Write all tables into a new snapshot below `root`, parents first, then switch readers to it.

    The switch is a commit with the next version number, made only after every table is complete. A number is
    created exclusively: of two writers one gets it, the other takes the next. No clock decides. A rebuild that
    fails leaves the previous snapshot in place; one that is repeated replaces everything.
    """
    snapshot = uuid.uuid4().hex
    for name, df in tables.items():
        write_parquet(df, f"{root}/snapshots/{snapshot}/{name}")
    version = max(committed(spark, root), default=0) + 1
    while not commit(spark, root, version, snapshot):
        version += 1
    return snapshot


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def commit(spark: SparkSession, root: str, version: int, snapshot: str) -> bool:
    """Claims a version number for a snapshot; False where another writer has it.

    The entry is written aside and moved into a folder of its own, which only one writer can make.
    """
    system, entry = _files(spark, f"{root}/commits/{version:020d}")
    system.mkdirs(entry.getParent())
    _, aside = _files(spark, f"{root}/claims/{version:020d}-{snapshot}")
    system.mkdirs(aside)
    system.create(_files(spark, f"{aside}/{snapshot}")[1], False).close()
    if system.exists(entry):
        return False
    try:
        # A folder that exists takes the moved one inside, or the move fails; the entry then names another snapshot.
        system.rename(aside, entry)
    except Exception as e:
        if "exist" not in str(e).lower():
            raise
    return snapshot in _names(system, entry)


def _names(system, folder) -> list[str]:
    return [f.getPath().getName() for f in system.listStatus(folder) if f.isFile()] if system.exists(folder) else []


def committed(spark: SparkSession, root: str) -> dict[int, str]:
    """Version -> snapshot of all commits below `root`."""
    system, folder = _files(spark, f"{root}/commits")
    entries = system.listStatus(folder) if system.exists(folder) else []
    found = {int(e.getPath().getName()): _names(system, e.getPath()) for e in entries}
    return {version: names[0] for version, names in found.items() if len(names) == 1}


def current_snapshot(spark: SparkSession, root: str) -> str:
    """Folder of the snapshot with the largest version number."""
    versions = committed(spark, root)
    return f"{root}/snapshots/{versions[max(versions)]}"


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 50_000, **options: str) -> None:
    """Bulk write to a configured database, one connection per partition."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode("append").save()
