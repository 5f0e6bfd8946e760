"""Toxicity scoring by weak supervision.

Many voters look at a text: groups of words and word beginnings that a bounded labelled sample shows to be
telling, a public lexicon of several languages, and patterns. A voter says "toxic" or keeps quiet; one says "clean" where
no telling item occurs. A generative label model estimates, by expectation maximisation over the votes
alone, how often each voter speaks on toxic and on clean texts, that is its accuracy and its coverage. It
also estimates how voters correlate beyond what the class explains, and counts correlated voters for less.
A linear classifier over words and word beginnings is then trained on the posterior labels of the model and
scores every document.

Words become telling by the rule of `telling_items`: precision of at least `PRECISION`, and so many toxic
texts that chance, over all items tried, would hardly give them. The sample holds about `max_labels` labelled
rows, chosen by a hash; it is the only input of the fit, its size is bounded, and so are voters and features.
Spark counts the items of the sample; the driver sees votes, the chosen features, and their places in rows.
Scoring reads every whole text. Null and empty texts get the score of a text without features. Repeated rows
get equal scores. Without labels of both kinds only the public lexicon and the patterns vote; without any labelled
row they vote over a hash sample of the documents, of the same size. The lexicon has no weights of its own.
Of several rows with a labelled id one text teaches; a null id has no label. A text is never cut, however long; empty
tables give empty results. Passed columns keep their names; an output column whose name is taken gets underscores in
front.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.llm.shared import fresh, hash_share, in_small_batches, output_names, text_of
from onefold.session import cut_lineage

MAX_LABELS = 8_000
PRECISION, CHANCE = 0.9, 0.05
VOTERS = 16
BEGINNINGS = (4, 5, 6)
MAX_FEATURES = 4_000
BELIEF_UNITS, MEMO_WORDS = 1 << 30, 200_000
THRESHOLD, PRIOR = 0.3, 0.05
# Fixed value: common insults of several languages, from general usage; everyday words with a plain sense are left out.
PUBLIC_WORDS = """
    idiot idiots idiotic moron morons moronic imbecile imbeciles stupid dumbass dumb fool fools dimwit halfwit jerk
    jackass asshole assholes bastard bastards bitch bitches scum scumbag coward liar
    trottel vollidiot idioten dummkopf schwachkopf blödmann arschloch arschlöcher mistkerl drecksau schlampe hurensohn
    wichser abschaum depp deppen versager
    imbécile imbéciles crétin crétine crétins abruti abrutis débile connard connards connasse salaud salope
    idiota idiotas imbécil imbéciles estúpido estúpida estúpidos cabrón cabrones gilipollas pendejo pendejos escoria
    stupido stupida cretino cretina cretini stronzo stronza bastardo bastardi coglione
    otário otária babaca babacas canalha idioot sukkel klootzak debil kretyn idiotka
    идиот идиоты дурак дура придурок мразь урод kretén debilní aptal salak gerizekalı
""".split()
# Patterns: an insult aimed at someone, and a wish for harm.
PATTERNS = [
    re.compile(r"\byou(?:'re| are)?\s+(?:\w+\s+){0,2}(?:" + "|".join(PUBLIC_WORDS) + r")\b"),
    re.compile(r"\b(?:go|just)\s+(?:die|kill yourself)\b"),
]
LETTERS = re.compile(r"[^\W\d_]+")


def items_of(text: str | None) -> set[str]:
    """The distinct words of a text, and their beginnings with a star."""
    words = set(LETTERS.findall((text or "").lower()))
    return words | {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}


def count_items(rows: DataFrame) -> DataFrame:
    """`item, seen, toxic` of the items that several rows have: how many have it, and how many of those are toxic."""
    each = rows.select(F.explode("items").alias("item"), F.when(F.col("label") == 1, 1).otherwise(0).alias("one"))
    counts = each.groupBy("item").agg(F.count(F.lit(1)).alias("seen"), F.sum("one").alias("toxic"))
    return cut_lineage(counts.filter("seen > 1"))


def telling_items(counts: DataFrame, tried: int, base: float) -> list[str]:
    """Items that speak for toxic texts, the most frequent first; `base` is the share of toxic rows."""
    if not 0 < base < 1:
        return []
    least = max(2, math.ceil(math.log(tried / CHANCE) / -math.log(base)))
    found = counts.filter((F.col("toxic") >= least) & (F.col("toxic") >= PRECISION * F.col("seen")))
    return [r["item"] for r in found.orderBy(F.desc("toxic"), "item").limit(MAX_FEATURES).collect()]


class Voters:
    """Groups of telling items by kind and rank, the public lexicon, the patterns, and one voter for clean."""

    def __init__(self, telling: list[str]):
        self.group = {x: i % VOTERS for i, x in enumerate(telling)}
        self.public = set(PUBLIC_WORDS)

    def votes(self, items: list[str], hits: list[bool]) -> np.ndarray:
        """1 where a voter speaks; `hits` tells which patterns match."""
        out = np.zeros(VOTERS + 1 + len(PATTERNS) + 1)
        for x in items:
            if x in self.group:
                out[self.group[x]] = 1
        out[VOTERS] = not self.public.isdisjoint(items)
        out[VOTERS + 1 : -1] = hits
        out[-1] = not out[:-1].any()
        return out


class LabelModel:
    """Accuracies and correlations of voters, from their votes alone."""

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 50):
        count = votes.shape[1]
        # Start: whoever hears any voter for "toxic" is likely toxic.
        belief = np.where(votes[:, :-1].any(axis=1), 0.9, 0.02)
        self.weight = np.ones(count)
        for _ in range(rounds):
            self.prior = (belief.sum() + prior * 10) / (len(votes) + 10)
            self.on_toxic = (votes.T @ belief + 1) / (belief.sum() + 2)
            self.on_clean = (votes.T @ (1 - belief) + 1) / ((1 - belief).sum() + 2)
            self.weight = 1 / (1 + self._correlated(votes, belief))
            new = self.posterior(votes)
            done = np.abs(new - belief).max(initial=0.0) < 1e-6
            belief = new
            if done:
                break

    def _correlated(self, votes: np.ndarray, belief: np.ndarray) -> np.ndarray:
        """How much of each voter the others repeat, within the classes: the sum of squared correlations."""
        expected = np.outer(belief, self.on_toxic) + np.outer(1 - belief, self.on_clean)
        rest = votes - expected
        size = np.sqrt((rest**2).sum(axis=0)) + 1e-9
        correlation = (rest.T @ rest) / np.outer(size, size)
        beyond = np.clip(correlation - np.eye(len(correlation)), 0, None)
        return (beyond**2).sum(axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        spoken = np.log(self.on_toxic) - np.log(self.on_clean)
        quiet = np.log1p(-self.on_toxic) - np.log1p(-self.on_clean)
        odds = np.log(self.prior / (1 - self.prior)) + (votes * spoken + (1 - votes) * quiet) @ self.weight
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def choose_features(rows: DataFrame, counts: DataFrame, tried: int, numbers: list[int], belief: np.ndarray) -> list[str]:
    """Items whose share of toxic texts, under the posterior labels of the rows `numbers`, chance would hardly give."""
    base = min(max(float(belief.mean()), 1e-6), 1 - 1e-6)
    # Whole units, so that sums do not depend on the order of rows.
    units = np.rint(belief * BELIEF_UNITS).astype(np.int64)
    believed = rows.sparkSession.createDataFrame(list(zip(numbers, units.tolist(), strict=True)), "row long, units long")
    each = rows.join(F.broadcast(believed), "row").select(F.explode("items").alias("item"), "units")
    mass = each.groupBy("item").agg(F.sum("units").alias("units"))
    share = F.col("units") / F.lit(float(BELIEF_UNITS)) / F.col("seen")
    share = F.greatest(F.least(share, F.lit(1 - 1e-9)), F.lit(1e-9))
    surprise = F.col("seen") * (share * F.log(share / base) + (1 - share) * F.log((1 - share) / (1 - base)))
    scored = counts.join(mass, "item").select("item", surprise.alias("surprise"))
    scored = scored.filter(F.col("surprise") >= math.log(tried / CHANCE))
    return [r["item"] for r in scored.orderBy(F.desc("surprise"), "item").limit(MAX_FEATURES).collect()]


def fit_linear(places: pa.ListArray, belief: np.ndarray, features: list[str], rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps, with ridge.

    `places` names the features of every row.
    """
    sizes = np.diff(places.offsets.to_numpy())
    rows, cols = np.repeat(np.arange(len(places)), sizes), places.flatten().to_numpy()
    weights, bias = np.zeros(len(features)), 0.0
    momentum, bias_momentum = np.zeros(len(features)), 0.0
    count, most = max(1, len(belief)), max(1, int(sizes.max(initial=1)))
    rate, ridge = 4.0 * 16 / min(64, most), 1e-5
    speed = np.zeros(len(features))
    for _ in range(rounds):
        z = np.bincount(rows, weights=(weights + 0.9 * momentum)[cols], minlength=len(belief)) + bias + 0.9 * bias_momentum
        off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - belief
        slope = np.bincount(cols, weights=off[rows], minlength=len(features)) / count + ridge * weights
        speed += slope**2
        momentum = 0.9 * momentum - rate * 0.05 * slope / (np.sqrt(speed) + 1e-8)
        bias_momentum = 0.9 * bias_momentum - rate * 0.1 * float(off.mean())
        weights, bias = weights + momentum, bias + bias_momentum
    return weights, bias


def train(
    docs: DataFrame,
    labels: DataFrame,
    teaches: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_labels: int = MAX_LABELS,
) -> tuple[dict[str, float], float]:
    """Weights of features and the bias of the classifier."""
    known = labels.filter(teaches & F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(id_column).agg(F.max(label_column).alias("_label"))
    sample = known.filter(hash_share(max_labels, known.count(), id_column)).orderBy(id_column).limit(2 * max_labels)
    sample = F.broadcast(cut_lineage(sample))  # at most twice `max_labels` narrow rows

    def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Label, items and matches of the patterns: all that the fit needs of a text."""
        for batch in batches:
            texts = batch.column(1).to_pylist()
            items = [sorted(items_of(t)) for t in texts]
            hits = [[bool(p.search((t or "").lower())) for p in PATTERNS] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(items, pa.list_(pa.string())), pa.array(hits, pa.list_(pa.bool_()))],
                names=["label", "items", "hits"],
            )

    def looked_over(rows: DataFrame) -> tuple[DataFrame, int, int]:
        """The rows as the fit sees them, their number, and how many are toxic."""
        found = in_small_batches(rows).mapInArrow(looked_at, "label int, items array<string>, hits array<boolean>")
        found = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))
        return found, *found.agg(F.count(F.lit(1)), F.count(F.when(F.col("label") == 1, 1))).first()

    # One text for each labelled id, however many rows have it: the least in byte order.
    joined = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(sample, F.col("id") == F.col(id_column))
    joined = joined.groupBy("id", "_label").agg(F.min("text").alias("text")).select(F.col("_label").cast("int"), "text")
    seen, size, toxic_rows = looked_over(joined)
    if not size:
        some = docs.filter(hash_share(max_labels, docs.count(), id_column, text_column))
        some = some.select(F.lit(None).cast("int").alias("_label"), F.col(text_column)).distinct()
        seen, size, toxic_rows = looked_over(some)
    if not size:
        return {}, math.log(PRIOR / (1 - PRIOR))

    def told(of_row: Callable[[list[str], list[bool]], np.ndarray]) -> pa.Table:
        """`row, label, found` in the order of rows: a few numbers for each row of the bounded sample."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                found = pa.array([of_row(*pair).astype(np.int32) for pair in pairs], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["row", "label", "found"])

        picked = seen.select("row", "label", "items", "hits").mapInArrow(run, "row long, label int, found array<int>")
        return picked.orderBy("row").toArrow().combine_chunks()

    base = toxic_rows / size
    counts = count_items(seen)
    tried = max(1, counts.count())
    voters = Voters(telling_items(counts, tried, base))
    table = told(voters.votes)
    votes = table["found"].combine_chunks().flatten().to_numpy().reshape(size, -1).astype(float)
    belief = LabelModel(votes, base or PRIOR).posterior(votes)
    features = choose_features(seen, counts, tried, table["row"].to_pylist(), belief)
    at = {x: i for i, x in enumerate(features)}
    places = told(lambda items, hits: np.array([at[x] for x in items if x in at], dtype=np.int32))
    weights, bias = fit_linear(places["found"].combine_chunks(), belief, features)
    return {x: float(w) for x, w in zip(features, weights, strict=True) if w}, float(bias)


class Hits(dict):
    """Word -> the features that it and its beginnings name; bounded."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found = tuple(x for x in items_of(word) if x in self.weights)
        return found

    def total(self, text: str | None) -> float:
        """The weights of a text's distinct features, summed without regard to their order."""
        words = set(LETTERS.findall((text or "").lower()))
        return math.fsum(self.weights[x] for x in set().union(*map(self.__getitem__, words)))


def toxicity(
    docs: DataFrame, weights: dict[str, float], bias: float, columns: list[str], text_column: str = "text"
) -> DataFrame:
    """`columns` of every document with `score` and `predicted`."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    text = fresh("_text", columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(shared.value)
        for batch in batches:
            found = [bias + hits.total(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(np.array(found, dtype=float), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=schema.names,
            )

    picked = docs.select(*columns, text_of(text_column).alias(text))
    schema, names = picked.drop(text).schema, output_names(("score", "predicted"), columns)
    schema = schema.add(names[0], "double").add(names[1], "integer")
    return in_small_batches(picked).mapInArrow(run, schema)
