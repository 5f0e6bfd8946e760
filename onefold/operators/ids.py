"""Dense row numbers 1..n without gathering the table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from onefold.session import cut_lineage

# A row number inside a partition takes the low bits of the built-in increasing id.
_LOW_BITS = 33


def dense_ids(df: DataFrame, order: list, name: str = "id", partitions: int | None = None) -> DataFrame:
    """Adds `name`: 1..n in the order of the unique key `order` (column names or sort expressions).

    Rows are range-partitioned and numbered inside their partition; each partition then adds the
    number of rows before it. That offset table has one row per partition.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = cut_lineage(
        ranged.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mid", _LOW_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_mid") - F.shiftleft("_part", _LOW_BITS)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_part", "_mid", "_offset")
    )


def first_appearance_ids(df: DataFrame, value: str, order: list[str], name: str = "id") -> DataFrame:
    """`(name, value)`: distinct values numbered by where they first appear in `order`."""
    first = df.groupBy(value).agg(F.min(F.struct(*order)).alias("_first"))
    return dense_ids(first, ["_first"], name).select(name, value)
