"""Phrase collocations by best-first branch and bound.

Pass one turns every text into codes: pieces between the marks `[.,;:!?\\x0A-\\x0D]`, words between blanks, a code
for each word by its rank in the chunk's own dictionary, zero at the end of a piece. Chunks are written, so later
passes read numbers and never split a text again. A word is known by a 64-bit hash; should two words of a
language share one and count, which a second hash tells, all is coded anew with another seed.

A phrase w1..wk with count a and a cut into parts with counts l and r scores floor(1000000 a a / (l r)); the
lowest cut counts. Prefix counts bound what can grow from a prefix: with b = f(w1 w2) no phrase that begins with
w1 w2 has a > b, and since its rest occurs at least a times, no score above floor(1000000 b / f(w1)). The pair
(this bound, b) is admissible for the order by score, then count: for the pair itself and all that extends it.

* Words below `least` grow nothing, so only pairs of frequent words are counted (pass two).
* The frontier holds all pairs. Each wave expands its best part: one pass over the chunks counts the triples that
  begin or end with an expanded pair. That settles whether the pair survives and what grows from it.
* The known survivors give each language its `top`-th best (score, count). Pairs whose bound reaches it, ties
  included, are the next wave; where too few are known, the wave grows eightfold. The search ends when no open
  bound reaches the `top`-th best, or nothing is open.

A pass tells wanted words and pairs by a sieve, a Bloom filter of at most `SIEVE_BITS` bits whatever it holds. What
it lets through by mistake costs work, never a result: a triple is counted everywhere or nowhere. Products are
decimals of 38 digits. Joins that meet a hot word spread it (`lookup_join`).

Null texts count as empty, a null language as `und`. Every repeated row counts. Ties at the last rank are broken by
the phrase in UTF-8 byte order. Very long texts are cut into chunks between pieces; a piece is never cut. Empty
tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onefold.llm.shared import from_planes, in_small_batches, planes
from onefold.session import cut_lineage, scratch_path
from onefold.skew import lookup_join

MARKS = b".,;:!?\n\x0b\x0c\r"
# Fixed value: lower case for A-Z, marks as line feeds, tabs as blanks, as a table over bytes.
PLAIN = bytes(10 if b in MARKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
LEAST, TOP, HALF_PERCENT = 10, 2_000, 50
CHUNK_CODES, FLUSH_ROWS = 1_500_000, 100_000
SIEVE_BITS, SIEVE_SEGMENTS, BITS_PER_KEY = 1 << 28, 256, 16
GROWTH, SEEDS, SALTS = 8, 16, 16
CODED = "lang string, words array<string>, hashes array<bigint>, counts array<bigint>, codes binary"


# ---- pass one: texts to codes ----


class Coder(dict):
    """Word -> code from 1 on, with the codes of the texts so far."""

    def __init__(self):
        super().__init__()
        self.codes = array("I")

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self) + 1
        return code

    def add(self, text: bytes) -> None:
        of, codes = self.__getitem__, self.codes
        for piece in text.translate(PLAIN).split(b"\n"):
            if words := piece.split():
                codes.extend(map(of, words))
                codes.append(0)

    def row(self, lang: str, seed: int) -> list[pa.Array]:
        """The chunk, with codes by falling count; bytes of equal place lie together, which packs better."""
        codes = np.frombuffer(self.codes, dtype=np.uint32)
        counts = np.bincount(codes, minlength=len(self) + 1)[1:]
        order = np.argsort(-counts, kind="stable")
        place = np.zeros(len(self) + 1, dtype="<u4")
        place[order + 1] = np.arange(1, len(self) + 1)
        names = list(self)
        names = [names[i] for i in order.tolist()]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names), dtype=np.uint64, count=len(names))
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        words = pa.array(names, pa.binary()).cast(pa.string())
        return [
            pa.array([lang]),
            one(words),
            one(pa.array(hashes.view(np.int64))),
            one(pa.array(counts[order].astype(np.int64))),
            pa.array([planes(place[codes])], pa.binary()),
        ]


def coded_chunks(docs: DataFrame, lang_column: str, text_column: str, seed: int, chunk_codes: int) -> DataFrame:
    """The written chunks of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Coder] = {}
        names = ["lang", "words", "hashes", "counts", "codes"]

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, coder in held.items():
                if coder:
                    yield pa.RecordBatch.from_arrays(coder.row(lang, seed), names=names)
            held.clear()

        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                coder = held.setdefault(lang, Coder())
                size -= len(coder.codes)
                coder.add(text)
                size += len(coder.codes)
                if size >= chunk_codes:
                    yield from flushed()
                    size = 0
        yield from flushed()

    texts = docs.select(F.coalesce(lang_column, F.lit("und")).alias("lang"), F.coalesce(text_column, F.lit("")).alias("text"))
    path = scratch_path(docs.sparkSession, "phrases")
    in_small_batches(texts).mapInArrow(run, CODED).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(CODED).parquet(path)


def frequent_words(coded: DataFrame, least: int) -> DataFrame:
    """`lang, w, n` of words that occur `least` times, and whether two words share the hash `w`."""
    entry = F.explode(F.arrays_zip("words", "hashes", "counts")).alias("x")
    words = coded.select("lang", entry).select("lang", F.col("x.hashes").alias("w"), F.col("x.counts").alias("n"), F.xxhash64("x.words").alias("v"))
    words = words.groupBy("lang", "w").agg(F.sum("n").alias("n"), (F.min("v") != F.max("v")).alias("clash"))
    return cut_lineage(words.filter(F.col("n") >= least))


# ---- sieves ----


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lang_key(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))


def pair_key(first: np.ndarray, second: np.ndarray, lang: np.uint64) -> np.ndarray:
    return mixed(mixed(first ^ lang) + second)


def word_key(word: np.ndarray, lang: np.uint64) -> np.ndarray:
    return mixed(word ^ lang)


def sieve_places(keys: np.ndarray, segment_bits: int) -> list[np.ndarray]:
    last = np.uint64(segment_bits - 1)
    return [(keys & last).astype(np.int64), ((keys >> np.uint64(28)) & last).astype(np.int64)]


def sieved(keys: np.ndarray, flat: bytes) -> np.ndarray:
    """True for keys that the sieve may hold."""
    bits = np.frombuffer(flat, dtype=np.uint8)
    segment_bits = len(bits) * 8 // SIEVE_SEGMENTS
    base = (keys >> np.uint64(56)).astype(np.int64) * segment_bits
    held = np.ones(len(keys), dtype=bool)
    for place in sieve_places(keys, segment_bits):
        at = base + place
        held &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return held


def sieve_of(df: DataFrame, columns: list[str], key: Callable) -> Broadcast:
    """A broadcast sieve of the rows' keys: `lang` and `columns`. It never takes more than `SIEVE_BITS` bits."""
    wanted = min(SIEVE_BITS, max(1 << 20, BITS_PER_KEY * df.count()))
    segment_bits = (1 << (wanted - 1).bit_length()) // SIEVE_SEGMENTS

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            parts = [batch.column(i + 1).to_numpy().view(np.uint64) for i in range(len(columns))]
            made = np.zeros(len(langs), dtype=np.uint64)
            for lang in set(langs.tolist()):
                own = langs == lang
                made[own] = key(*(p[own] for p in parts), lang_key(lang))
            segment = (made >> np.uint64(56)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(segment), pa.array(made.view(np.int64))], names=["segment", "key"])

    def build(table: pa.Table) -> pa.Table:
        bits = np.zeros(segment_bits, dtype=bool)
        for place in sieve_places(table.column("key").to_numpy().view(np.uint64), segment_bits):
            bits[place] = True
        data = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"segment": table.column("segment").slice(0, 1), "data": pa.array([data], pa.binary())})

    made = df.select("lang", *columns).mapInArrow(keys, "segment int, key long")
    parts = made.groupBy("segment").applyInArrow(build, "segment int, data binary").collect()  # SIEVE_BITS at most
    held = {r["segment"]: bytes(r["data"]) for r in parts}
    none = bytes(segment_bits // 8)
    return df.sparkSession.sparkContext.broadcast(b"".join(held.get(s, none) for s in range(SIEVE_SEGMENTS)))


# ---- passes over the chunks ----


def _chunk(lang: str, hashes: np.ndarray, packed: bytes, words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, the hash of each code (zero for none), and which positions hold a frequent word."""
    codes = from_planes(packed, "<u4")
    of = np.concatenate([np.zeros(1, dtype=np.uint64), hashes])
    keep = sieved(word_key(of, lang_key(lang)), words)
    keep[0] = False
    return codes, of, keep[codes]


def _count_grams(coded: DataFrame, find: Callable, length: int) -> DataFrame:
    """`lang, w1, .., n`: how often each phrase that `find` picks occurs in a chunk, summed over chunks."""
    names = ["lang", *(f"w{i + 1}" for i in range(length)), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                lang, packed = batch.column(0)[at].as_py(), batch.column(2)[at].as_buffer()
                hashes = batch.column(1)[at].values.to_numpy().view(np.uint64)
                grams, n = find(lang, hashes, packed)
                for i in range(0, len(n), FLUSH_ROWS):
                    part = [g[i : i + FLUSH_ROWS].view(np.int64) for g in grams]
                    own = pa.array([lang]).take(pa.array(np.zeros(len(part[0]), dtype=np.int64)))
                    yield pa.RecordBatch.from_arrays([own, *map(pa.array, part), pa.array(n[i : i + FLUSH_ROWS])], names=names)

    schema = "lang string, " + "".join(f"w{i + 1} long, " for i in range(length)) + "n long"
    counted = in_small_batches(coded.select("lang", "hashes", "codes")).mapInArrow(run, schema)
    return counted.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def count_pairs(coded: DataFrame, words: Broadcast, least: int) -> DataFrame:
    """`lang, w1, w2, n` of pairs of neighbours that occur `least` times."""

    def find(lang: str, hashes: np.ndarray, packed: bytes) -> tuple[list[np.ndarray], np.ndarray]:
        codes, of, keep = _chunk(lang, hashes, packed, words.value)
        at = np.nonzero(keep[:-1] & keep[1:])[0]
        both = codes[at].astype(np.uint64) << np.uint64(32) | codes[at + 1]
        found, n = np.unique(both, return_counts=True)
        return [of[found >> np.uint64(32)], of[found & np.uint64(0xFFFFFFFF)]], n

    return cut_lineage(_count_grams(coded, find, 2).filter(F.col("n") >= least))


def count_triples(coded: DataFrame, words: Broadcast, pairs: Broadcast, wave: Broadcast, least: int) -> DataFrame:
    """`lang, w1, w2, w3, n` of triples of candidate pairs, one of them in the wave, that occur `least` times."""

    def find(lang: str, hashes: np.ndarray, packed: bytes) -> tuple[list[np.ndarray], np.ndarray]:
        codes, of, keep = _chunk(lang, hashes, packed, words.value)
        at = np.nonzero(keep[:-2] & keep[1:-1] & keep[2:])[0]
        left = pair_key(of[codes[at]], of[codes[at + 1]], lang_key(lang))
        right = pair_key(of[codes[at + 1]], of[codes[at + 2]], lang_key(lang))
        chosen = np.nonzero(sieved(left, wave.value) | sieved(right, wave.value))[0]
        chosen = chosen[sieved(left[chosen], pairs.value)]
        chosen = chosen[sieved(right[chosen], pairs.value)]
        at = at[chosen]
        both, place = np.unique(codes[at].astype(np.uint64) << np.uint64(32) | codes[at + 1], return_inverse=True)
        found, n = np.unique(place.astype(np.uint64) << np.uint64(32) | codes[at + 2], return_counts=True)
        first = both[found >> np.uint64(32)]
        return [of[first >> np.uint64(32)], of[first & np.uint64(0xFFFFFFFF)], of[found & np.uint64(0xFFFFFFFF)]], n

    return cut_lineage(_count_grams(coded, find, 3).filter(F.col("n") >= least))


# ---- scores, bounds and the search ----


def _wide(name: str) -> str:
    return f"cast({name} AS decimal(14, 0))"


def score(a: str, left: str, right: str) -> Column:
    return F.expr(f"(cast(1000000 AS decimal(7, 0)) * {_wide(a)} * {_wide(a)}) div ({_wide(left)} * {_wide(right)})")


def scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with `a, l, r, score`, the bound of all that begins with them, and coarse levels of both."""
    side = lambda i, name: words.select("lang", F.col("w").alias(f"w{i}"), F.col("n").alias(name))
    known = lookup_join(pairs.withColumnRenamed("n", "a"), side(1, "l"), ["lang", "w1"])
    known = lookup_join(known, side(2, "r"), ["lang", "w2"])
    bound = F.expr(f"(cast(1000000 AS decimal(7, 0)) * {_wide('a')}) div {_wide('l')}")
    known = known.withColumn("score", score("a", "l", "r")).withColumn("bound", bound)
    level = lambda c: F.struct(F.floor(F.log2(F.col(c) + 1) * 16).alias("x"), F.floor(F.log2("a") * 8).alias("y"))
    return cut_lineage(known.withColumn("level", level("score")).withColumn("reach", level("bound")))


def scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples with `a, l, r, score` of their lowest cut."""
    first = pairs.select("lang", "w1", "w2", F.col("a").alias("a12"), F.col("l").alias("f1"))
    second = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"), F.col("r").alias("f3"))
    known = lookup_join(triples.withColumnRenamed("n", "a"), first, ["lang", "w1", "w2"])
    known = lookup_join(known, second, ["lang", "w2", "w3"])
    cut = lambda k, l, r: F.struct(score("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
    known = known.withColumn("cut", F.least(cut(1, "f1", "a23"), cut(2, "a12", "f3")))
    return known.select("lang", "w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")


def surviving(pairs: DataFrame, triples: DataFrame, half_percent: int) -> DataFrame:
    """Pairs that no candidate triple around them replaces."""
    sides = [triples.select("lang", F.col(x).alias("w1"), F.col(y).alias("w2"), F.col("n").alias("longer")) for x, y in (("w1", "w2"), ("w2", "w3"))]
    longest = sides[0].unionByName(sides[1]).groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    kept = pairs.join(longest, ["lang", "w1", "w2"], "left")
    return kept.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * half_percent)).drop("longer")


def wave_levels(pairs: DataFrame, target: int) -> DataFrame:
    """`lang, level`: the coarse level of scores that about `target` pairs reach; null where fewer pairs are there."""
    steps = pairs.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("lang").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("above", F.sum("n").over(above))
    return steps.groupBy("lang").agg(F.max(F.when(F.col("above") >= target, F.col("level"))).alias("level"))


def best_rows(rows: DataFrame, top: int, *order: Column) -> DataFrame:
    """Each language's first `top` rows and their `rank`; first within parts of a language, then among those."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS)))
    for keys in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= top)
    return rows.drop("part")


def top_value(known: DataFrame, top: int) -> DataFrame:
    """`lang, least`: the `top`-th best (score, a); null where fewer are known."""
    first = best_rows(known.select("lang", "w1", "w2", "w3", "score", "a"), top, F.desc("score"), F.desc("a"))
    return first.groupBy("lang").agg(F.max(F.when(F.col("rank") == top, F.struct("score", "a"))).alias("least"))


def search(coded: DataFrame, words: DataFrame, least: int, top: int, half_percent: int, first_wave: int) -> DataFrame:
    """`lang, w1, w2, w3, a, l, r, score` of all survivors that reach their language's `top`-th best."""
    word_sieve = sieve_of(words, ["w"], word_key)
    pairs = scored_pairs(count_pairs(coded, word_sieve, least), words)
    pair_sieve = sieve_of(pairs, ["w1", "w2"], pair_key)
    langs = cut_lineage(pairs.select("lang").distinct())
    reach = F.struct(F.col("bound").alias("score"), "a")
    waves: list[DataFrame] = []
    triples: list[DataFrame] = []
    best = langs.withColumn("least", F.lit(None).cast("struct<score:bigint,a:bigint>"))
    frontier, target = pairs, first_wave
    while True:
        limits = cut_lineage(best.join(wave_levels(pairs, target).withColumnRenamed("level", "from"), "lang"))
        in_reach = F.when(F.col("least").isNotNull(), reach >= F.col("least"))
        in_reach = in_reach.otherwise(F.coalesce(F.col("reach") >= F.col("from"), F.lit(True)))
        marked = frontier.join(limits, "lang").withColumn("taken", in_reach).drop("least", "from")
        marked = cut_lineage(marked)
        wave, frontier = marked.filter("taken").drop("taken"), marked.filter("NOT taken").drop("taken")
        waves.append(wave)
        wave_sieve = sieve_of(wave, ["w1", "w2"], pair_key)
        triples.append(count_triples(coded, word_sieve, pair_sieve, wave_sieve, least))
        wave_sieve.unpersist()
        every = reduce(DataFrame.unionByName, triples)
        every = cut_lineage(every.distinct()) if len(triples) > 1 else every
        expanded = reduce(DataFrame.unionByName, waves).select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "l", "r", "score")
        known = cut_lineage(surviving(expanded, every, half_percent).unionByName(scored_triples(every, pairs)))
        best = cut_lineage(langs.join(top_value(known, top), "lang", "left"))
        pending = frontier.join(best, "lang").filter(F.col("least").isNull() | (reach >= F.col("least")))
        if pending.isEmpty():
            reached = F.col("least").isNull() | (F.struct("score", "a") >= F.col("least"))
            return known.join(best, "lang").filter(reached).drop("least")
        target *= GROWTH


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    half_percent: int = HALF_PERCENT,
    first_wave: int | None = None,
    chunk_codes: int = CHUNK_CODES,
) -> DataFrame:
    """Each language's best phrases of two or three words: `lang, rank, phrase, a, l, r, n, score`."""
    for seed in range(SEEDS):
        coded = coded_chunks(docs, lang_column, text_column, seed, chunk_codes)
        words = frequent_words(coded, least)
        if words.filter("clash").isEmpty():
            break
    else:
        raise ValueError(f"hashes of frequent words clash with {SEEDS} seeds")
    found = cut_lineage(search(coded, words.drop("clash"), least, top, half_percent, first_wave or GROWTH * top))
    asked = reduce(DataFrame.union, [found.select("lang", f"w{i}") for i in (1, 2, 3)]).toDF("lang", "w").dropna().distinct()
    entry = F.explode(F.arrays_zip("words", "hashes")).alias("x")
    names = coded.select("lang", entry).select("lang", F.col("x.hashes").alias("w"), F.col("x.words").alias("name"))
    names = cut_lineage(names.join(asked, ["lang", "w"], "left_semi").distinct())
    for i in (1, 2, 3):
        own = names.select("lang", F.col("w").alias(f"w{i}"), F.col("name").alias(f"name{i}"))
        found = lookup_join(found, own, ["lang", f"w{i}"]) if i > 1 else found.join(own, ["lang", "w1"])
    sizes = coded.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n)).alias("n"))
    phrase = F.concat_ws(" ", "name1", "name2", "name3")
    ranked = best_rows(found.withColumn("phrase", phrase), top, F.desc("score"), F.desc("a"), F.asc("phrase"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
