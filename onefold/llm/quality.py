"""Quality classification by importance resampling with hashed n-gram models.

Two generative models count hashed n-grams: one over target texts (documents labelled as good), one over
the raw text of all documents. A document's log weight is the sum over its n-grams of the log ratio of
the two. Adding Gumbel noise to the log weights and keeping the k largest draws k documents without
replacement in proportion to their weights. k is the number of documents above the cut that separates
the labelled documents best, so the sample is as large as the part of the table that looks like the target.

An n-gram is one word or two neighbouring ones: words in lower case, runs of signs as words of their own. Runs
of one to three word shapes (letter case, length class, digits, the signs at its end, and whether the word
repeats the one before) are additional features. Hashing puts each kind into its own `BUCKETS` buckets, and
each kind has its own pair of models.

The target is fitted on a bounded hash sample of at most about `max_labels` labels; the raw model, the
weights and the draw cover every document and whole texts. The noise is a hash of id and text, so reruns
agree and repeated rows share their fate; rows that tie with the k-th are all kept.

Null texts count as empty and have weight zero. Without labels of both kinds nothing is rejected. Of several rows
with a labelled id the least weight judges the cut; a null id has no label. A text is never cut, however long; empty
tables give empty results. Passed columns keep their names; an output column whose name is taken gets underscores in
front.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onefold.llm.shared import fresh, hash_share, in_small_batches, text_of, with_field
from onefold.session import cut_lineage

BUCKETS = 1 << 14
ORDERS, WORD_ORDERS = 3, 2
MAX_LABELS = 20_000
MEMO_WORDS, MEMO_SHAPES, SHAPE_BITS = 300_000, 5_000, 32
FLUSH_GRAMS = 1_000_000
BINS, SMALL = 2_000, 5_000
END_SIGNS = re.compile(r"[^\w\s]+$")
# Fixed value: a run of word characters, or of signs.
TOKEN = re.compile(r"\w+|[^\w\s]+")


def shape(word: str) -> tuple:
    """The coarse look of a word: letter case, length class, digits, and the signs at its end."""
    if word.isalpha():
        tail, core = "", word
    else:
        signs = END_SIGNS.search(word)
        tail, core = (signs.group()[:3], word[: signs.start()]) if signs else ("", word)
    case = 0 if not core else 1 if core.islower() else 2 if core.isupper() and len(core) > 1 else 3 if core[:1].isupper() else 4
    digits = not core.isalpha() and any(c.isdigit() for c in core)
    return case, min(len(core).bit_length(), 6), digits, tail


def _shape_hash(look: tuple) -> int:
    """A fixed even number below 2^64; Python's own hash differs between processes."""
    value = 1469598103934665603
    for b in repr(look).encode():
        value = (value ^ b) * 1099511628211 % (1 << 64)
    return (value >> 1) << 1


class Memo(dict):
    """Word -> (its number << SHAPE_BITS) + the place of its shape in `hashes`; bounded in both.

    The lower-case words and signs that a word holds have their hashes in `tokens`, from `starts` of its number on.
    """

    def __init__(self):
        super().__init__()
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.places, self.hashes, self.tokens, self.starts = {}, array("Q"), array("Q"), array("q", [0])

    def __missing__(self, word: str) -> int:
        look = shape(word)
        place = self.places.get(look)
        if place is None:
            place = self.places[look] = len(self.hashes)
            self.hashes.append(_shape_hash(look))
        for token in TOKEN.findall(word.lower()):
            self.tokens.append(xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")))
        self.starts.append(len(self.tokens))
        self[word] = value = (len(self) << SHAPE_BITS) + place
        return value

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers that are equal for equal words, the shape hashes, and the hashes of the words and signs in them."""
        if len(self) > MEMO_WORDS or len(self.hashes) > MEMO_SHAPES:
            self._empty()
        found = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        at, starts = found >> SHAPE_BITS, np.frombuffer(self.starts, dtype=np.int64)
        first, held = starts[at], starts[at + 1] - starts[at]
        if (held != 1).any():
            first = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held - first, held)
        looks = np.frombuffer(self.hashes, dtype=np.uint64)[found & ((1 << SHAPE_BITS) - 1)]
        return found, looks, np.frombuffer(self.tokens, dtype=np.uint64)[first]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _run_buckets(tokens: np.ndarray, orders: int) -> np.ndarray:
    """The bucket of every run of up to `orders` tokens, given by their hashes."""
    run, found = _mixed(tokens), []
    for order in range(1, orders + 1):
        found.append(run >> np.uint64(50))
        if order < orders and len(run) > 1:
            run = _mixed(run[:-1] * np.uint64(3) + tokens[order:])
        elif order < orders:
            break
    return np.concatenate(found).astype(np.int64)


def buckets_of(text: str | None, memo: Memo) -> np.ndarray:
    """The bucket of every n-gram of a text, repeats included: first of shapes, then of words."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    ids, looks, tokens = memo.of(words)
    looks[1:] |= (ids[1:] == ids[:-1]).astype(np.uint64)
    return np.concatenate([_run_buckets(looks, ORDERS), _run_buckets(tokens, WORD_ORDERS) + BUCKETS])


def _bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts per bucket over a one-column table of texts; each batch sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = Memo(), [], 0
        total = np.zeros(2 * BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(buckets_of(text, memo))
                size += len(held[-1])
                if size >= FLUSH_GRAMS:
                    total += np.bincount(np.concatenate(held), minlength=2 * BUCKETS)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=2 * BUCKETS)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counts = in_small_batches(texts).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(2 * BUCKETS)
    for row in counts.collect():  # at most 2 * BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, the log of the smoothed target frequency over the smoothed raw frequency, within its kind."""
    if not target.sum() or not raw.sum():
        return np.zeros(len(target))
    target, raw = target.reshape(-1, BUCKETS), raw.reshape(-1, BUCKETS)
    share = [np.log((x + 0.5) / (x.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)) for x in (target, raw)]
    return (share[0] - share[1]).ravel()


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight at and above which a document counts as good, with the best balanced accuracy.

    It lies in the gap between the two values that it parts, nearer to the good one.
    """
    if not len(good) or not len(bad):
        return -np.inf
    values = np.concatenate([good, bad])
    order = np.argsort(values, kind="stable")
    is_good = np.concatenate([np.ones(len(good)), np.zeros(len(bad))])[order]
    values = values[order]
    # Cutting below position i: good ones from i on, and bad ones before i, are right.
    right = (is_good.sum() - np.concatenate([[0], np.cumsum(is_good)])) / len(good)
    right += np.concatenate([[0], np.cumsum(1 - is_good)]) / len(bad)
    i = int(np.argmax(right))
    if i == 0:
        return -np.inf
    return float(values[-1] + 1.0) if i == len(values) else float(values[i] - (values[i] - values[i - 1]) / 4)


def kth_largest(table: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by narrowing a range of equal bins; the driver sees bin counts only."""
    if k <= 0:
        return np.inf
    low, high = table.agg(F.min(column), F.max(column)).first()
    rest = k
    while True:
        inside = table.filter(F.col(column).between(low, high))
        width = (high - low) / BINS
        if not width or low + width == low:
            return low
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)).cast("int")
        bins = inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column), F.max(column)).collect()
        for row in sorted(bins, key=lambda r: -r["bin"]):
            if row["n"] >= rest:
                break
            rest -= row["n"]
        low, high = row[2], row[3]
        if row["n"] <= SMALL:
            values = table.filter(F.col(column).between(low, high)).select(column).collect()
            return sorted((v[0] for v in values), reverse=True)[rest - 1]


def resample(
    docs: DataFrame,
    labels: DataFrame,
    teaches: Column,
    columns: list[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """`columns` of every document with `log_weight`, `sample_key`, `score` and `kept`.

    `labels` has one row per labelled id; those for which `teaches` holds teach, with 1 for good.
    """
    known = labels.filter(teaches & F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(id_column).agg(F.max(label_column).alias("_label"))
    sample = known.filter(hash_share(max_labels, known.count(), id_column)).orderBy(id_column).limit(2 * max_labels)
    sample = F.broadcast(cut_lineage(sample))  # at most twice `max_labels` narrow rows
    texts = docs.select(id_column, text_of(text_column).alias("_t"))
    target = texts.join(sample, id_column).filter("_label = 1").select("_t")
    ratios = log_ratios(_bucket_counts(target), _bucket_counts(texts.select("_t")))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    weight, key, score, kept = (fresh(n, columns) for n in ("log_weight", "sample_key", "score", "kept"))
    text = text_column if text_column in columns else fresh("_text", columns)
    noise = fresh("_noise", [*columns, text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        logs = shared.value
        for batch in batches:
            found = [float(logs[buckets_of(t, memo)].sum()) for t in batch.column(text).to_pylist()]
            kept_columns = [c for c in batch.schema.names if c in columns or c == noise]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept_columns), pa.array(found, pa.float64())], names=[*kept_columns, weight]
            )

    uniform = (F.pmod(F.xxhash64(F.lit(31), id_column, text_column), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    picked = docs.select(*columns, (-F.log(-F.log(uniform))).alias(noise))
    schema = with_field(picked.schema, weight, T.DoubleType())
    if text not in columns:
        picked = docs.select(*columns, (-F.log(-F.log(uniform))).alias(noise), F.col(text_column).alias(text))
    scored = in_small_batches(picked).mapInArrow(run, schema)
    scored = cut_lineage(scored.withColumn(key, F.col(weight) + F.col(noise)))
    judged = scored.select(F.col(id_column).alias("id"), F.col(weight).alias("weight")).join(sample, F.col("id") == F.col(id_column))
    # One row for each labelled id, however many rows have it: the least weight.
    judged = judged.groupBy("id", "_label").agg(F.min("weight").alias("weight")).toPandas()
    good, bad = (judged.loc[judged["_label"] == x, "weight"].to_numpy() for x in (1, 0))
    cut = best_cut(good, bad)
    above = scored.filter(F.col(weight) >= F.lit(cut)).count()
    least = kth_largest(scored, key, above) if np.isfinite(cut) else -np.inf
    offset = F.col(weight) - F.lit(cut if np.isfinite(cut) else 0.0)
    return scored.select(
        *columns,
        weight,
        key,
        (1 / (1 + F.exp(-offset))).alias(score),
        (F.col(key) >= F.lit(float(least))).alias(kept),
    )


def sampled(docs: DataFrame, labels: DataFrame, teaches: Column, **names) -> DataFrame:
    """The documents that the draw keeps, with all their columns."""
    found = resample(docs, labels, teaches, docs.columns, **names)
    return found.filter(F.col(fresh("kept", docs.columns))).select(*docs.columns)
