"""Small helpers that several operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onefold.session import cut_lineage

BROADCAST_ROWS = 500_000  # of row ids, some tens of bytes each
BATCH_BYTES = 4 << 20

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Fixed value: lower case for A-Z and nothing else, as a table over bytes.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, whose session from now on sends workers Arrow batches of about `BATCH_BYTES` at most.

    Rows hold whole texts or whole chunks, and the thousands that a batch may have by count need not fit a worker.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def text_of(column: str) -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as their count of bytes each, as far as the largest needs them, and bytes of one place together.

    Laid out so, numbers compress far better.
    """
    numbers = np.ascontiguousarray(numbers)
    used = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([used]) + numbers.view(np.uint8).reshape(-1, numbers.itemsize)[:, :used].T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    """The numbers that `planes` packed."""
    held = np.frombuffer(data, dtype=np.uint8)
    parts = held[1:].reshape(held[0], -1)
    out = np.zeros((parts.shape[1], np.dtype(kind).itemsize), dtype=np.uint8)
    out[:, : held[0]] = parts.T
    return out.view(kind).ravel()


def in_fold(id_column: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id's text leaves `fold`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds == fold


def fresh(name: str, taken: list[str]) -> str:
    """`name`, with underscores in front until no column has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def output_names(wanted: list[str] | tuple[str, ...], taken: list[str]) -> list[str]:
    """Names for the columns an operator adds: as wanted, with underscores in front of those that `taken` has."""
    names: list[str] = []
    for name in wanted:
        names.append(fresh(name, [*taken, *names]))
    return names


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A new schema with one more field."""
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """`df` written once with a number for each row, and the name of that column.

    Numbers are part of the written table, so every later read sees the same ones, whatever executor
    is lost meanwhile.
    """
    name = fresh("_row", df.columns)
    return cut_lineage(df.withColumn(name, F.monotonically_increasing_id())), name


def identified(df: DataFrame, scanned: bool) -> tuple[DataFrame, str]:
    """`df` with a column that tells its rows apart in every later read, and the name of that column.

    A plain scan of Parquet files (`scanned`), with at most projections and filters that always say the same, needs
    no copy: a row is known by its file and its place in it. Anything else is written once, numbered.
    """
    if not scanned:
        return numbered(df)
    name, file = fresh("_row", df.columns), df.metadataColumn("_metadata")
    return df.withColumn(name, F.struct(F.xxhash64(file["file_path"]).alias("file"), file["row_index"].alias("at"))), name


def without_rows(df: DataFrame, name: str, dropped: DataFrame) -> DataFrame:
    """The rows of `df` whose `name` is not in the one column of `dropped`.

    Few dropped rows are broadcast, after they are counted, so that whole texts need not be shuffled.
    """
    dropped = cut_lineage(dropped)
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return df.join(dropped, name, "left_anti")


def hash_share(bound: int, total: int, *columns: str) -> Column:
    """True for a fixed pseudorandom share of rows, about `bound` out of `total`."""
    steps = 1 << 40
    limit = steps if total <= bound else int(steps * (bound / total))
    return F.pmod(F.xxhash64(F.lit(977), *columns), F.lit(steps)) < F.lit(limit)


def running_start(
    df: DataFrame, group: str, order: list[str], value: str, name: str, chunk_bits: int = 12
) -> DataFrame:
    """Adds the sum of `value` over the earlier rows of the group, by ascending `order`.

    Rows are summed in chunks of neighbouring values of the first order column, a long, so a task sorts
    one chunk of a group or the chunk sums of a group, never all rows of a large group.
    """
    chunk, before = fresh("_chunk", df.columns), fresh("_before", df.columns)
    df = df.withColumn(chunk, F.shiftright(order[0], chunk_bits))
    sums = df.groupBy(group, chunk).agg(F.sum(value).alias(before))
    within_group = Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.coalesce(F.sum(before).over(within_group), F.lit(0)))
    within_chunk = Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(value).over(within_chunk), F.lit(0))
    return df.join(sums, [group, chunk]).withColumn(name, F.col(before) + inner).drop(chunk, before)
