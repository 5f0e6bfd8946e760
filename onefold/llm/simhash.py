"""Near duplicates by SimHash fingerprints, found through Golay keys of their segments.

A fingerprint has 64 bits, cut into segments of 22, 21 and 21. Of up to four differing bits, some two
segments have at most one each, or else the bits lie (2, 2, 0). So the pigeonhole gives six kinds of key:

* three pairs of segments with at most one error each: one side has the near keys of the first segment
  and the key of the second, the other side the key of the first and the near keys of the second;
* three choices of the segment without error: its value, and the near keys of one segment beside it.

Rows with equal keys meet in an equality join, which verifies the distance and keeps a pair for the one
kind of key that its own errors name, so links come out once or a few times. Only distinct fingerprints
take part: copies never meet each other.

A key that more than `hot` fingerprints hold is left out of that join. All fingerprints of such keys go
through midpoints instead: two fingerprints lie within four bits if and only if some value lies within
two bits of both. Each is tied to the least fingerprint around each of its 2,081 midpoints, which links
the same components with work in proportion to the number of fingerprints.

Null and empty texts have fingerprint zero and are linked like any other; repeated rows keep one row
each. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onefold.llm.components import connected_components
from onefold.llm.golay import keys, near_keys
from onefold.llm.shared import ASCII_LOWER, fresh, identified, in_small_batches, without_rows
from onefold.session import cut_lineage
from onefold.skew import lookup_join

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and number of bits
PAIRS = ((0, 1), (0, 2), (1, 2))
HOT = 20_000  # fingerprints of one key that still meet pairwise
COPIES = 1_000  # rows of one fingerprint from which on they are spread
KIND_SHIFT = 40


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not words:
        return 0
    count = max(1, len(words) - SHINGLE_WORDS + 1)
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0] + [e + 1 for e in ends[: count - 1]]
    shingles = map(joined.__getitem__, map(slice, starts, ends[min(SHINGLE_WORDS, len(words)) - 1 :]))
    digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(digests), 8 << 16):
        part = np.frombuffer(digests[at : at + (8 << 16)], dtype=np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > count).tobytes(), "big")


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, columns: list[str], text_column: str) -> DataFrame:
    """`columns` and `fp`, the fingerprint as a signed long, of every row."""
    text = fresh("_text", columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _signed([fingerprint(t) for t in batch.column(len(columns)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(fps)], names=[*columns, "fp"])

    picked = docs.select(*columns, F.col(text_column).alias(text))
    schema = picked.drop(text).schema.add("fp", "long")
    return in_small_batches(picked).mapInArrow(run, schema)


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    wide = fps.view(np.uint64)
    return [((wide >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


def _fuzzy_keys(fps: np.ndarray, probing: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions in `fps` and their keys, for one side of the join."""
    parts = _segments(fps)
    exact = [keys(p) for p in parts]
    near = [near_keys(p, n) for p, (_, n) in zip(parts, SEGMENTS, strict=True)]
    rows, found = [], []
    for kind, (a, b) in enumerate(PAIRS):
        at, key = near[b] if probing else near[a]
        both = (exact[a][at] << 12) | key if probing else (key << 12) | exact[b][at]
        rows.append(at)
        found.append((kind << KIND_SHIFT) | both)
    for whole in range(3):
        at, key = near[(whole + 1) % 3]
        rows.append(at)
        found.append(((len(PAIRS) + whole) << KIND_SHIFT) | (key << 22) | parts[whole][at])
    return np.concatenate(rows), np.concatenate(found)


def _keyed(classes: DataFrame, probing: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for start in range(0, len(fps), 4096):
                part = fps[start : start + 4096]
                rows, found = _fuzzy_keys(part, probing)
                yield pa.RecordBatch.from_arrays([pa.array(part[rows]), pa.array(found)], names=["fp", "key"])

    return classes.select("fp").mapInArrow(run, "fp long, key long")


def _errors(difference: Column, segment: int) -> Column:
    at, n = SEGMENTS[segment]
    mask = ((1 << n) - 1) << at
    return F.bit_count(difference.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)))


def links(classes: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs `u, v` of fingerprints that tie all within `MAX_BITS` of each other together."""
    store, probe = _keyed(classes, False), _keyed(classes, True)
    crowded = store.groupBy("key").count().filter(F.col("count") > hot).select("key")
    crowded = cut_lineage(crowded)
    some_crowded = not crowded.isEmpty()
    left, right = store.withColumnRenamed("fp", "u"), probe.withColumnRenamed("fp", "v")
    if some_crowded:
        left, right = left.join(crowded, "key", "left_anti"), right.join(crowded, "key", "left_anti")
    apart = F.col("u").bitwiseXOR(F.col("v"))
    errors = [_errors(apart, s) for s in range(3)]
    kind = F.when(F.lit(False), F.lit(0))
    for number, (a, b) in enumerate(PAIRS):
        kind = kind.when((errors[a] <= 1) & (errors[b] <= 1), F.lit(number))
    for whole in range(3):
        kind = kind.when(errors[whole] == 0, F.lit(len(PAIRS) + whole))
    # Spark would judge the keys by the fingerprints they come from and broadcast them; there are dozens for each.
    right = right.withColumnRenamed("key", "other_key").hint("merge")
    found = left.join(
        right,
        (F.col("key") == F.col("other_key"))
        & (F.col("v") < F.col("u"))
        & (F.bit_count(apart) <= MAX_BITS)
        & (kind == F.shiftright("key", KIND_SHIFT)),
    ).select("u", "v")
    if some_crowded:
        members = store.union(probe).join(crowded, "key", "left_semi").select("fp").distinct()
        found = found.union(midpoint_links(members))
    return found


def midpoint_links(members: DataFrame) -> DataFrame:
    """Stars around every value that lies within two bits of several fingerprints."""
    masks = [0, *(1 << b for b in range(64)), *((1 << a) | (1 << b) for a, b in combinations(range(64), 2))]
    around = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks])
    points = members.select("fp", F.explode(F.transform(around, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    least = least.drop("n").hint("merge")  # 2,081 points of a fingerprint count as one row when Spark sizes them
    return points.join(least, "point").filter("fp > v").select(F.col("fp").alias("u"), "v").distinct()


def components(prints: DataFrame, id_column: str, hot: int = HOT) -> DataFrame:
    """`fp, component_id` for every fingerprint in `prints`: the smallest id that it can reach."""
    classes = cut_lineage(prints.groupBy("fp").agg(F.min(id_column).alias("least_id")))
    roots = cut_lineage(connected_components(links(classes, hot)))
    linked = roots.withColumnRenamed("node", "fp").join(classes, "fp")
    merged = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    merged = roots.join(merged, "root").select(F.col("node").alias("fp"), "component_id")
    return classes.join(merged, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: id, `fingerprint` in hex and `component_id`."""
    prints = cut_lineage(fingerprints(docs, [id_column], text_column))
    return lookup_join(prints, components(prints, id_column, hot), ["fp"], rows=COPIES).select(
        id_column, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT, scanned: bool = False
) -> DataFrame:
    """The documents with one row per component, the one with the smallest id, with all their columns.

    For `scanned` see `shared.identified`.
    """
    rows, name = identified(docs, scanned)
    prints = cut_lineage(fingerprints(rows, [id_column, name], text_column))
    found = components(prints, id_column, hot)
    firsts = prints.groupBy("fp").agg(F.min(F.struct(F.col(id_column).isNull(), F.col(id_column), F.col(name))).alias("first"))
    firsts = firsts.join(found, "fp").groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")))
    kept = firsts.agg(F.min("first").alias("first")).select(F.col(f"first.{name}").alias(name))
    rest = without_rows(rows, name, prints.select(name).join(kept, name, "left_anti"))
    return rest.select(*[rest[c] for c in docs.columns])
