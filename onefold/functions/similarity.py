"""Title similarity on a 0-100 scale, from the longest common subsequence (LCS) of two strings.

`ratio = round(100 * 2 * LCS / (|a| + |b|))`: a substitution costs two edits, so the distance behind
the ratio is `d = |a| + |b| - 2 * LCS`. Rounding is half to even.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 62  # a sum of two such words and a carry fits a bigint
PROFILE_WORDS, PROFILE_LANES, LANE_BITS = 4, 8, 8  # of a profile: longs, buckets of characters in each, bits of a bucket


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _masks(chars: Column) -> Column:
    """Character -> for each word of `WORD_BITS` places, the bits where the character stands."""
    size = F.size(chars)
    starts = F.sequence(F.lit(0), F.floor((size - 1) / WORD_BITS).cast("int"))

    def mask(c: Column, word: Column) -> Column:
        part = F.slice(chars, word * WORD_BITS + 1, F.lit(WORD_BITS))
        bits = F.transform(part, lambda x, i: F.when(x == c, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
        return F.aggregate(F.array_compact(bits), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))

    entries = F.transform(F.array_distinct(chars), lambda c: F.struct(c, F.transform(starts, lambda w: mask(c, w))))
    return F.map_from_entries(entries)


def _lcs_of(shorter: Column, longer: Column) -> Column:
    """Bit-parallel LCS of two arrays of characters (Hyyro 2004): zeros of the state mark the subsequence.

    A further character adds its matches to the state, word by word with a carry, so the work is the length
    of the longer array times the words of the shorter one.
    """
    full = F.lit((1 << WORD_BITS) - 1)
    words = F.floor((F.size(shorter) - 1) / WORD_BITS).cast("int") + 1

    def step(state: Column, masks: Column) -> Column:
        def word(total: Column, pair: Column) -> Column:
            v, hit = pair["v"], pair["v"].bitwiseAND(pair["m"])
            grown = v + hit + total["carry"]
            new = grown.bitwiseOR(v.bitwiseAND(F.bitwise_not(hit))).bitwiseAND(full)
            return F.struct(
                F.shiftright(grown, WORD_BITS).alias("carry"), F.concat(total["words"], F.array(new)).alias("words")
            )

        pairs = F.zip_with(state, masks, lambda v, m: F.struct(v.alias("v"), m.alias("m")))
        none = F.struct(F.lit(0).cast("bigint").alias("carry"), F.expr("cast(array() AS array<bigint>)").alias("words"))
        return F.aggregate(pairs, none, word, lambda total: total["words"])

    def zeros(v: Column, i: Column) -> Column:
        used = F.least(F.size(shorter) - i * WORD_BITS, F.lit(WORD_BITS))
        return used - F.bit_count(v.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), used) - 1))

    def folded(masks: Column) -> Column:
        known = F.filter(longer, lambda c: F.map_contains_key(masks, c))
        one = F.aggregate(
            known,
            full,
            lambda v, c: _let(
                v.bitwiseAND(F.element_at(F.element_at(masks, c), 1)),
                lambda hit: (v + hit).bitwiseOR(v.bitwiseAND(F.bitwise_not(hit))).bitwiseAND(full),
            ),
        )
        many = F.aggregate(known, F.array_repeat(full, words), lambda state, c: step(state, F.element_at(masks, c)))
        state = F.when(words == 1, F.array(one)).otherwise(many)
        return F.aggregate(F.transform(state, zeros), F.lit(0), lambda a, n: a + n)

    return _let(_masks(shorter), folded)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, in built-in expressions."""
    swap = F.length(a) > F.length(b)
    both = F.struct(
        _chars(F.when(swap, b).otherwise(a)).alias("shorter"), _chars(F.when(swap, a).otherwise(b)).alias("longer")
    )
    found = _let(both, lambda x: _lcs_of(x["shorter"], x["longer"]))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(found)


def ratio(a: Column, b: Column, total: Column | None = None) -> Column:
    """Similarity 0-100; equal strings, empty ones included, score 100. `total` is the sum of their lengths, if known."""
    total = F.length(a) + F.length(b) if total is None else total
    share = F.lit(2.0) * lcs_length(a, b) / total
    return F.when(a == b, F.lit(100)).otherwise(F.bround(F.lit(100.0) * share, 0).cast("int"))


def distance_bound(total: Column, threshold: int) -> Column:
    """Largest distance two strings of `total` characters may have at a rounded ratio >= `threshold`.

    `100 * (total - d) / total >= threshold - 0.5` in whole numbers.
    """
    return F.floor(total * F.lit(201 - 2 * threshold) / F.lit(200)).cast("int")


def profile(text: Column) -> Column:
    """How often a text has the characters of each bucket, as an array of longs for `profile_distance`.

    A count is kept modulo 16 as a Johnson code of eight bits: neighbouring counts differ in one bit, the last one
    and zero too, so two codes differ in no more bits than their counts do.
    """
    cycle = 2 * LANE_BITS
    codes = [(1 << n) - 1 if n <= LANE_BITS else ((1 << LANE_BITS) - 1) ^ ((1 << (n - LANE_BITS)) - 1) for n in range(cycle)]
    johnson = F.lit(codes).cast("array<bigint>")
    buckets = F.transform(F.split(text, ""), lambda c: F.pmod(F.hash(c), F.lit(PROFILE_WORDS * PROFILE_LANES)))

    def word(of: Column, number: int) -> Column:
        lanes = F.lit(list(range(PROFILE_LANES)))

        def put(total: Column, lane: Column) -> Column:
            count = F.size(of) - F.size(F.array_remove(of, lane + number * PROFILE_LANES))
            code = F.element_at(johnson, F.pmod(count, F.lit(cycle)) + 1)
            return total.bitwiseOR(F.call_function("shiftleft", code, lane * LANE_BITS))

        return F.aggregate(lanes, F.lit(0).cast("bigint"), put)

    return _let(buckets, lambda of: F.array(*[word(of, n) for n in range(PROFILE_WORDS)]))


def profile_distance(a: list[Column], b: list[Column]) -> Column:
    """A lower bound of the distance `|a| + |b| - 2 * LCS` from the words of two profiles: a character that is lost or
    added changes one count by one."""
    bits = [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)]
    return sum(bits[1:], bits[0])


def edits_within(a: Column, b: Column, bound: Column) -> Column:
    """Whether the unit-cost edit distance is at most `bound`: Spark's own tells -1 beyond it.

    The distance is named once. Spark takes what a condition names twice out of it, and then computes it for every pair,
    whatever the cheap parts of the condition say before.
    """
    return F.call_function("levenshtein", a, b, bound) >= 0


def within_bound(a: Column, b: Column, threshold: int) -> Column:
    """Cheap necessary condition for `ratio(a, b) >= threshold`.

    Neither the length difference nor the unit-cost edit distance exceeds the distance behind the ratio.
    """
    bound = distance_bound(F.length(a) + F.length(b), threshold)
    return (F.abs(F.length(a) - F.length(b)) <= bound) & edits_within(a, b, bound)
