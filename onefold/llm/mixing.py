"""Mixing sources to target weights by drawing fixed-length blocks.

The words of a source, document after document, are packed into blocks of `BLOCK_WORDS`, or of a hundredth of the
source's size or target where that is less (one word at least); the last block may be shorter. The mix is a row of
output shards with `SHARD_SLOTS` slots each; every shard draws how many of its slots each source gets from
one multinomial distribution. A source's slots, numbered through all shards, go through a pseudorandom
permutation of the numbers of its blocks, one permutation for each pass over the source, and a slot is
filled by joining the block with that number. Sums of multinomial draws stray from the targets, so slots
beyond a source's exact number are handed to the sources that drew too few; all else stays as drawn. The last slot
of a source takes only the words still missing, so a source misses its target by a block at most, that is by 1 %.

Targets: sources in order of code points, null last, weigh 5, 2, 1 in turn and share 150 % of all words.
None gets more than twice its own words; what is over is shared anew by weight. So no block is used more
than twice, and neither is any word.

Documents are packed in the order of a hash of id and text, and every draw has a fixed seed: reruns agree,
however the input is dealt out. Null texts have size zero; documents of size zero are never taken. Repeated rows are documents of
their own. There may be up to `MAX_SOURCES` sources; beyond that the operator refuses, since the table of
sources is broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onefold.llm.shared import WORD, fresh, identified, in_small_batches, running_start, text_of
from onefold.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS, SHARD_SLOTS = 128, 4_096
ORDER_BITS, CHUNK_ROWS = 62, 2_048
MAX_SOURCES, PER_SOURCE = 100_000, 100
TASK_SLOTS = 1 << 17
SEED = 42
SPAN = re.compile(WORD)


def targets_of(sizes: list[int], weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Target words of each source, whose sizes come in order."""
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    caps = [most * s for s in sizes]
    target, open_ones, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_ones:
        unit = left / sum(weight[i] for i in open_ones)
        over = {i for i in open_ones if weight[i] * unit > caps[i]}
        for i in over or open_ones:
            target[i] = caps[i] if over else weight[i] * unit
        if not over:
            break
        left -= sum(caps[i] for i in over)
        open_ones -= over
    return target


class Plan:
    """What is known per source: sizes, targets, block length, blocks, slots, and the words that its last slot takes.

    Bounded by `MAX_SOURCES`.
    """

    def __init__(self, names: list[str | None], sizes: list[int], block_words: int):
        self.names, self.sizes = names, sizes
        self.targets = targets_of(sizes)
        size, words = np.array(sizes, dtype=np.int64), np.rint(self.targets).astype(np.int64)
        self.length = np.clip(np.minimum(size, words) // PER_SOURCE, 1, block_words)
        self.blocks = -(-size // self.length)
        passes = words // np.maximum(1, size)
        rest = words - passes * size
        self.slots = passes * self.blocks - (-rest // self.length)
        self.last_words = np.where(rest > 0, rest - (-(-rest // self.length) - 1) * self.length, self.length)

    @property
    def total_slots(self) -> int:
        return int(self.slots.sum())


def plan_sources(sized: DataFrame, block_words: int) -> Plan:
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    return Plan([r["source"] for r in rows], [r["size"] for r in rows], block_words)


def shard_draws(spark: SparkSession, plan: Plan, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """`shard, sid, drawn`: the multinomial draw of every output shard."""
    total = plan.total_slots
    shards = max(1, math.ceil(total / shard_slots))
    chance = plan.slots / max(1, total)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                size = min(shard_slots, total - shard * shard_slots)
                drawn = np.random.default_rng([SEED, shard]).multinomial(size, chance)
                at = np.nonzero(drawn)[0]
                yield pd.DataFrame({"shard": shard, "sid": at.astype(np.int32), "drawn": drawn[at]})

    return spark.range(shards if total else 0).mapInPandas(run, "shard long, sid int, drawn long")


def permuted(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(size): Feistel rounds, walked on until a value is in range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([SEED, key]).integers(1, 1 << 63, size=4, dtype=np.uint64)

    def rounds(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(7) & low)
        return (left << np.uint64(half)) | right

    x = rounds(numbers.astype(np.uint64))
    while len(outside := np.nonzero(x >= size)[0]):
        x[outside] = rounds(x[outside])
    return x.astype(np.int64)


def filled_slots(draws: DataFrame, plan: Plan) -> DataFrame:
    """`sid, block, pass_no, most`: the block of every slot of the mix, and the words that the slot takes at most.

    `draws` has `first`, the source's slots before. Draws are few and slots many, so draws are dealt out by the slots
    they make.
    """
    drawn = np.zeros(len(plan.slots), dtype=np.int64)
    for row in draws.groupBy("sid").agg(F.sum("drawn").alias("n")).collect():  # one row per source at most
        drawn[row["sid"]] = row["n"]
    extra, missing = np.maximum(drawn - plan.slots, 0), np.maximum(plan.slots - drawn, 0)
    extra_before = np.concatenate([[0], np.cumsum(extra)])
    missing_until = np.cumsum(missing)
    slots, blocks, length, last_words = plan.slots, plan.blocks, plan.length, plan.last_words

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for sid, first, n in zip(frame["sid"], frame["first"], frame["drawn"], strict=True):
                own = np.arange(first, first + n)
                sids = np.full(n, sid)
                over = own >= slots[sid]
                spare = extra_before[sid] + own[over] - slots[sid]
                sids[over] = np.searchsorted(missing_until, spare, side="right")
                taker = sids[over]
                own[over] = drawn[taker] + spare - (missing_until[taker] - missing[taker])
                block, passes = np.zeros(n, dtype=np.int64), own // np.maximum(1, blocks[sids])
                for s in np.unique(sids):
                    for p in np.unique(passes[sids == s]):
                        at = (sids == s) & (passes == p)
                        block[at] = permuted(own[at] - p * blocks[s], int(blocks[s]), int(2 * s + p))
                most = np.where(own == slots[sids] - 1, last_words[sids], length[sids])
                yield pd.DataFrame({"sid": sids.astype(np.int32), "block": block, "pass_no": passes.astype(np.int32), "most": most})

    tasks = 1 + plan.total_slots // TASK_SLOTS
    return draws.repartition(tasks, "shard", "sid").mapInPandas(run, "sid int, block long, pass_no int, most long")


def _sized(docs: DataFrame, columns: list[Column], id_column: str, source_column: str, text_column: str) -> DataFrame:
    """`columns`, `source`, `size` in words and `place`, a hash that orders documents, written once."""
    size = F.regexp_count(text_of(text_column), F.lit(WORD)).cast("bigint")
    place = F.shiftrightunsigned(F.xxhash64(id_column, text_column), 64 - ORDER_BITS)
    return cut_lineage(
        docs.select(*columns, F.col(source_column).alias("source"), size.alias("size"), place.alias("place"))
    )


def _taken_pieces(sized: DataFrame, plan: Plan) -> DataFrame:
    """`row, low, high, pass_no`: word ranges of documents that slots of the mix take. `sized` has `row, sid, length`."""
    chunk_bits = ORDER_BITS - max(0, (sized.count() // CHUNK_ROWS).bit_length())
    placed = running_start(sized.filter("size > 0"), "sid", ["place", "row"], "size", "start", chunk_bits)
    blocks = F.sequence(F.expr("start div length"), F.expr("(start + size - 1) div length"))
    packed = placed.select("sid", "row", "size", "start", "length", F.explode(blocks).alias("block"))
    draws = cut_lineage(shard_draws(sized.sparkSession, plan))
    slots = filled_slots(running_start(draws, "sid", ["shard"], "drawn", "first"), plan)
    # Spark would judge the slots by the few draws they come from and broadcast them; they grow with the mix.
    taken = packed.join(slots.hint("merge"), ["sid", "block"]).select(
        "row",
        (F.greatest(F.col("block") * F.col("length"), "start") - F.col("start")).alias("low"),
        (F.least(F.col("block") * F.col("length") + F.col("most"), F.col("start") + F.col("size")) - F.col("start")).alias("high"),
        "pass_no",
    )
    return taken.filter("low < high")


def _with_plan(sized: DataFrame, block_words: int) -> tuple[DataFrame, Plan, DataFrame]:
    """`sized` with `sid` and `length` of a block, the plan, and the table of sources, which `MAX_SOURCES` bounds."""
    plan = plan_sources(sized, block_words)
    columns = zip(plan.names, plan.sizes, plan.targets, plan.length.tolist(), strict=True)
    rows = [(n, i, s, float(t), b) for i, (n, s, t, b) in enumerate(columns)]
    sources = sized.sparkSession.createDataFrame(rows, "name string, sid int, source_size long, target double, length long")
    wanted = F.broadcast(sources.select("name", "sid", "length"))
    return sized.join(wanted, F.col("source").eqNullSafe(F.col("name"))).drop("name"), plan, sources


def mix_report(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: id, `size`, `source_size`, `target` of its source, and the words `taken` of it."""
    named = [F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id")]
    sized, plan, sources = _with_plan(_sized(docs, named, id_column, source_column, text_column), block_words)
    taken = _taken_pieces(sized, plan).groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return (
        sized.join(taken, "row", "left")
        .join(F.broadcast(sources.drop("name", "length")), "sid")
        .select(
            F.col("id").alias(id_column),
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        )
    )


def cut_text(text: str, size: int, ranges: list[tuple[int, int]]) -> list[str]:
    """The passages of a text that word ranges name; ranges that touch make one passage."""
    joined: list[list[int]] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(high, joined[-1][1])
        else:
            joined.append([low, high])
    if joined == [[0, size]]:
        return [text]
    spans = [m.span() for m in SPAN.finditer(text)]
    return [text[spans[low][0] : spans[high - 1][1]] for low, high in joined]


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    length_column: str = "n_chars",
    block_words: int = BLOCK_WORDS,
    scanned: bool = False,
) -> DataFrame:
    """The mix as documents: a row for every unbroken passage that a pass takes of a document.

    Columns are those of `docs`. A document that a pass takes whole keeps its text as it is; of others
    each run of taken blocks is a row. `length_column`, where there is one, gets the passage's length. For `scanned`
    see `shared.identified`.
    """
    rows, name = identified(docs, scanned)
    sized, plan, _ = _with_plan(
        _sized(rows, [F.col(name).alias("row")], id_column, source_column, text_column), block_words
    )
    words, taken = fresh("_words", rows.columns), fresh("_taken", rows.columns)
    ranges = _taken_pieces(sized, plan).groupBy("row").agg(
        F.collect_list(F.struct("pass_no", "low", "high")).alias(taken)  # at most two for each block of a document
    )
    ranges = ranges.join(sized.select("row", F.col("size").alias(words)), "row").withColumnRenamed("row", name)
    picked = rows.join(ranges, name).select(*[rows[c] for c in docs.columns], words, taken)
    at = docs.columns.index(text_column)
    length_at = docs.columns.index(length_column) if length_column in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, texts = [], []
            columns = zip(*(batch.column(i).to_pylist() for i in (at, batch.num_columns - 2, batch.num_columns - 1)), strict=True)
            for row, (text, size, found) in enumerate(columns):
                for p in sorted({r["pass_no"] for r in found}):
                    own = [(r["low"], r["high"]) for r in found if r["pass_no"] == p]
                    for passage in cut_text(text, size, own):
                        take.append(row)
                        texts.append(passage)
            out = batch.take(pa.array(take, pa.int64()))
            arrays = out.columns[:-2]
            arrays[at] = pa.array(texts, arrays[at].type)
            if length_at is not None:
                arrays[length_at] = pa.array([len(t) for t in texts]).cast(arrays[length_at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-2])

    return in_small_batches(picked).mapInArrow(run, docs.schema)
