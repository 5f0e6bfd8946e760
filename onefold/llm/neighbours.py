"""Approximate nearest neighbours by largest inner product, with a forest of random-projection trees.

Vectors get one more coordinate that makes all their lengths equal; then the largest inner product is
the smallest distance, which the trees split. A tree halves a bounded hash sample of `sample` vectors
at the median along a difference of two of them, the widest spread of `DRAWS` draws, level by level. Every vector is then routed to its
leaf in each tree. A query keeps one priority queue over all trees: it always opens the branch that is
nearest anywhere in the forest, by the squared margins on its way, until it has opened `leaves` leaves. Queries and vectors meet by
leaf; each meeting keeps its best candidates by exact inner products in double precision, and the
distinct candidates of a query are ranked at the end.

Vectors without any structure need about half of a table for a recall of 0.9 (64 uniform dimensions,
measured), so the defaults open that much: the forest stops at `MAX_DEPTH`, and the work of a query
grows with the table. Where vectors have structure, a larger depth at the same `leaves` reads less.

Leaves are cut into blocks by their counts, on both sides, so no task holds more than two blocks of
`BLOCK` vectors; the forest has a fixed largest size and is broadcast. Of identical vectors only the
`top` + 1 with the smallest ids can ever be among the `top` nearest, so only they are candidates, and
identical queries are searched once.

Vectors that are null, zero or hold null or non-finite components take no part, nor do those whose
length is not the most common one. Empty tables give empty results; repeated rows count as one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onefold.llm.shared import hash_share
from onefold.session import cut_lineage

TOP = 20
TREES, LEAVES = 12, 56
SAMPLE, DRAWS = 20_000, 8
LEAF_ROWS, MAX_DEPTH = 512, 6
BLOCK = 2_048
SEED = 42


def usable_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """`id, v` of the rows that take part, repeated rows once; `v` as doubles."""
    v = F.col(vector_column).cast("array<double>")
    ok = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.filter(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & ok)
    rows = rows.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


class Forest:
    """Perfect binary trees; node i of a level-ordered tree has the children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, reach: float, depth: int, trees: int = TREES):
        self.reach, self.depth, self.trees = reach, depth, trees
        random = np.random.default_rng(SEED)
        points = lifted(sample, reach)
        nodes = (1 << depth) - 1
        self.normals = np.zeros((trees, nodes, points.shape[1] if len(points) else 1))
        self.cuts = np.zeros((trees, nodes))
        for t in range(trees):
            members = {0: np.arange(len(points))}
            for node in range(nodes):
                own = members.pop(node)
                normal, along = _widest(points[own], random)
                self.normals[t, node] = normal
                self.cuts[t, node] = np.median(along) if len(own) else 0.0
                right = along > self.cuts[t, node]
                members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]

    @classmethod
    def of(cls, parts: dict) -> Forest:
        forest = cls.__new__(cls)
        vars(forest).update(parts)
        return forest

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, trees side by side."""
        points = lifted(vectors, self.reach)
        out = np.zeros((len(points), self.trees), dtype=np.int64)
        for t in range(self.trees):
            node = np.zeros(len(points), dtype=np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", points, self.normals[t, node])
                node = 2 * node + 1 + (along > self.cuts[t, node])
            out[:, t] = node
        return out

    def search(self, query: np.ndarray, leaves: int = LEAVES) -> list[tuple[int, int]]:
        """(tree, leaf) of the leaves a query opens, over one queue for the whole forest."""
        point = np.append(query, 0.0)
        margins = self.normals @ point - self.cuts
        queue = [(0.0, t, 0) for t in range(self.trees)]
        first_leaf, found = (1 << self.depth) - 1, []
        while queue and len(found) < leaves:
            bound, t, node = heapq.heappop(queue)
            while node < first_leaf:
                margin = margins[t, node]
                near, far = (2, 1) if margin > 0 else (1, 2)
                heapq.heappush(queue, (bound + margin * margin, t, 2 * node + far))
                node = 2 * node + near
            found.append((t, node))
        return found


def _widest(points: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The unit direction with the widest spread of a few draws, and the points along it."""
    best = (-1.0, None, None)
    for _ in range(DRAWS):
        a, b = points[random.choice(len(points), 2)] if len(points) else np.zeros((2, points.shape[1]))
        normal = a - b if np.any(a != b) else random.normal(size=points.shape[1])
        normal = normal / np.linalg.norm(normal)
        along = points @ normal
        spread = along.var() if len(points) else 0.0
        if spread > best[0]:
            best = (spread, normal, along)
    return best[1], best[2]


def lifted(vectors: np.ndarray, reach: float) -> np.ndarray:
    """Vectors with one more coordinate, after which each has length `reach`."""
    rest = np.sqrt(np.maximum(0.0, reach * reach - np.einsum("ij,ij->i", vectors, vectors)))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def build_forest(vectors: DataFrame, sample: int = SAMPLE, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> Forest:
    """The forest over a bounded sample of `vectors`; its depth follows their number."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    row = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("reach")).first()
    picked = vectors.filter(hash_share(sample, row["n"], "id", "v")).orderBy("id").limit(2 * sample).select("v").collect()
    points = np.array([r["v"] for r in picked]) if picked else np.zeros((0, 1))
    depth = 0
    while depth < MAX_DEPTH and row["n"] > leaf_rows << depth and len(points) > 8 << depth:
        depth += 1
    return Forest(points, row["reach"] or 0.0, depth, trees)


def _matrix(column: pa.Array, start: int, stop: int) -> np.ndarray:
    part = column.slice(start, stop - start)
    return part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _routed(vectors: DataFrame, parts, step: int, opened) -> DataFrame:
    """`tree, leaf, id, v`: one row per vector and leaf that `opened(forest, matrix)` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest.of(parts.value)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                stop = min(start + step, batch.num_rows)
                rows, trees, leaves = opened(forest, _matrix(batch.column(1), start, stop))
                part = batch.slice(start, stop - start).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(trees, pa.int32()), pa.array(leaves, pa.int64()), *part.columns],
                    names=["tree", "leaf", "id", "v"],
                )

    return vectors.select("id", "v").mapInArrow(run, "tree int, leaf long, id long, v array<double>")


def _leaf_of_each(forest: Forest, vectors: np.ndarray):
    leaves = forest.route(vectors)
    rows = np.repeat(np.arange(len(vectors)), forest.trees)
    return rows, np.tile(np.arange(forest.trees), len(vectors)), leaves.ravel()


def _opened_leaves(count: int):
    def opened(forest: Forest, vectors: np.ndarray):
        found = [(i, t, leaf) for i, q in enumerate(vectors) for t, leaf in forest.search(q, count)]
        rows, trees, leaves = np.array(found, dtype=np.int64).reshape(-1, 3).T
        return rows, trees, leaves

    return opened


def _best_in_block(top: int):
    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(queries) or not len(members):
            return empty
        members = members.sort_values("id", kind="stable")
        ids, m = members["id"].to_numpy(), np.stack(members["v"].to_numpy())
        keep, out = min(top, len(ids)), []
        for start in range(0, len(queries), 256):
            part = queries.iloc[start : start + 256]
            q = np.stack(part["v"].to_numpy())
            rough = q @ m.T
            least = np.partition(rough, len(ids) - keep, axis=1)[:, len(ids) - keep, None]
            row, at = np.nonzero(rough >= least - 1e-9 * (1.0 + np.abs(least)))
            score = (m[at] * q[row]).sum(axis=1)  # the same order of additions wherever a vector lies
            found = pd.DataFrame({"query": part["id"].to_numpy()[row], "id": ids[at], "score": score})
            found = found.sort_values(["query", "score", "id"], ascending=[True, False, True])
            out.append(found.groupby("query", sort=False).head(keep))
        return pd.concat(out, ignore_index=True)

    return run


def _blocks(rows: DataFrame, side: str) -> DataFrame:
    """How many blocks each leaf's rows on this side are cut into; at most one row per leaf of the forest."""
    n = F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int")
    return rows.groupBy("tree", "leaf").agg(n.alias(f"{side}_blocks"))


def nearest(
    table: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    top: int = TOP,
    trees: int = TREES,
    leaves: int = LEAVES,
    sample: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `top` nearest found of every row for which `is_query` holds.

    `is_query` is a condition on the column `id`.
    """
    spark = table.sparkSession
    rows = usable_vectors(table, id_column, vector_column)
    same = Window.partitionBy("w1", "w2").orderBy("id")
    marked = rows.distinct().withColumns({"w1": F.xxhash64("v"), "w2": F.hash("v")})
    marked = cut_lineage(marked)
    candidates = marked.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= top + 1)
    candidates = cut_lineage(candidates.select("id", "v"))
    queries = marked.filter(is_query)
    searched = queries.groupBy("w1", "w2").agg(F.min("id").alias("lead"))
    leads = queries.join(searched, ["w1", "w2"]).filter(F.col("id") == F.col("lead")).select("id", "v")
    forest = build_forest(candidates, sample, trees, leaf_rows)
    parts = spark.sparkContext.broadcast(vars(forest))

    members = cut_lineage(_routed(candidates, parts, 8_192, _leaf_of_each))
    probes = cut_lineage(_routed(leads, parts, 1_024, _opened_leaves(leaves)))
    counts = F.broadcast(_blocks(members, "member").join(_blocks(probes, "probe"), ["tree", "leaf"]))
    cut = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cell = ["tree", "leaf", "member_block", "probe_block"]
    left = probes.join(counts, ["tree", "leaf"]).select(
        "tree", "leaf", every("member_blocks").alias("member_block"), cut("probe_blocks").alias("probe_block"), "id", "v"
    )
    right = members.join(counts, ["tree", "leaf"]).select(
        "tree", "leaf", cut("member_blocks").alias("member_block"), every("probe_blocks").alias("probe_block"), "id", "v"
    )
    found = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInPandas(_best_in_block(top + 1), "query long, id long, score double")
    )
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    best = best.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= top + 1)
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(searched, ["w1", "w2"])
        .select(F.col("id").alias("query_id"), F.col("lead").alias("query"))
        .join(best.withColumnRenamed("id", "vec_id").drop("place"), "query")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
