"""Language identification by known words first, then by ever shorter character n-grams.

A word that training has seen adds its log frequency in every language. An unseen word falls back to the
longest n-grams of it, marked at both ends, of which any is known: their mean log frequency counts.
The language with the largest sum, prior included, wins; its posterior is the score.

The model is fitted on a bounded sample: about `sample_rows` labelled documents of each of the
`max_languages` most frequent languages, chosen by a hash of language and text. It holds at most `max_words` words
and `max_grams` n-grams, shared out evenly among the languages, so a small language keeps its own; frequencies
are relative to all that a language has in the sample. So its size has a bound and it is broadcast.

Null texts and texts without letters are `und` with score zero. Rows without a language never teach; without any
labelled row every text is `und`. Equal sums go to the first language by name. Repeated rows get equal results.
Whole texts are read, however long, with a bounded memo; empty tables give empty results. Passed columns keep their
names; an output column whose name is taken gets underscores in front.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onefold.llm.shared import fresh, in_small_batches, output_names, text_of
from onefold.session import cut_lineage

SAMPLE_ROWS, MAX_LANGUAGES = 2_000, 1_000
MAX_WORDS, MAX_GRAMS = 50_000, 50_000
LONGEST_GRAM = 5
UNKNOWN = "und"
MEMO_WORDS, MEMO_CELLS = 250_000, 8_000_000
# Fixed value: a run of word characters that are neither digits nor underscores.
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    found = LETTERS.findall((text or "").lower())
    return found if any(c.isalpha() for w in found for c in w) else []


def grams_of(word: str, order: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text))
        rows = [(lang, w, n) for lang, own in counts.items() for w, n in own.items()]
        yield _table(rows)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for order in range(1, LONGEST_GRAM + 1):
                for gram in grams_of(word, order):
                    counts[lang, gram] += n
        yield _table([(lang, g, n) for (lang, g), n in counts.items()])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    langs, items, counts = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(items, pa.string()), pa.array(counts, pa.int64())],
        names=["lang", "item", "n"],
    )


class Logs:
    """Item -> its log frequency in every language; what training has not kept for a language is a floor."""

    def __init__(self, told: dict[str, tuple], floors: dict[int, np.ndarray], by_length: bool):
        self.told, self.floors, self.by_length = told, floors, by_length

    def __contains__(self, item: str) -> bool:
        return item in self.told

    def __iter__(self) -> Iterator[str]:
        return iter(self.told)

    def __len__(self) -> int:
        return len(self.told)

    def __getitem__(self, item: str) -> np.ndarray:
        out = self.floors[len(item) if self.by_length else 0].copy()
        at, logs = self.told[item]
        out[list(at)] = logs
        return out


class Model:
    """Log frequencies of words and n-grams by language.

    What is held grows with the rows (language, item, count) that training keeps, not with items times languages.
    """

    def __init__(self, docs_by_lang: dict[str, int], words: list[tuple], grams: list[tuple], totals: dict[tuple, int]):
        """`totals`: (language, 0 for words or the length of n-grams) -> how many training has of them."""
        self.langs = sorted(docs_by_lang)
        total = sum(docs_by_lang.values())
        self.prior = np.log([docs_by_lang[lang] / total for lang in self.langs])
        self.word_logs, self.word_floors = self._logs(words, totals, lambda w: 0)
        self.gram_logs, self.gram_floors = self._logs(grams, totals, len)

    @classmethod
    def of(cls, parts: dict) -> Model:
        """A model from its parts, in which form it is broadcast."""
        model = cls.__new__(cls)
        vars(model).update(parts)
        return model

    def _logs(self, rows: list[tuple], totals: dict[tuple, int], kind) -> tuple[dict, dict]:
        """rows: (lang, item, n). Frequencies are relative to all that the language has of a kind."""
        at = {lang: i for i, lang in enumerate(self.langs)}
        sizes = Counter(kind(item) for item in {item for _, item, _ in rows})
        room = {k: np.array([totals.get((lang, k), 0) + 0.5 * n for lang in self.langs]) for k, n in sizes.items()}
        told: dict[str, tuple] = {}
        for lang, item, n in rows:
            places, logs = told.setdefault(item, ([], []))
            places.append(at[lang])
            logs.append(float(np.log((n + 0.5) / room[kind(item)][at[lang]])))
        return told, {k: np.log(0.5 / r) for k, r in room.items()}

    @property
    def words(self) -> Logs:
        return Logs(self.word_logs, self.word_floors, False)

    @property
    def grams(self) -> Logs:
        return Logs(self.gram_logs, self.gram_floors, True)

    def unseen(self, word: str, grams: Logs | dict | None = None) -> np.ndarray:
        """Score of a word that is not in the model."""
        grams = self.grams if grams is None else grams
        for order in range(LONGEST_GRAM, 0, -1):
            known = [grams[g] for g in grams_of(word, order) if g in grams]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.langs))


class Scorer:
    """A model with a bounded memo of the scores of words that texts have, for one task."""

    def __init__(self, model: Model):
        self.model, self.words, self.grams = model, model.words, model.grams
        if len(self.grams) * len(model.langs) <= MEMO_CELLS:
            self.grams = {g: self.grams[g] for g in self.grams}
        self.rows = max(1_000, min(MEMO_WORDS, MEMO_CELLS // max(1, len(model.langs))))
        self.matrix = np.zeros((self.rows, len(model.langs)))
        self.at: dict[str, int] = {}

    def _position(self, word: str) -> int:
        i = self.at[word] = len(self.at)
        self.matrix[i] = self.words[word] if word in self.words else self.model.unseen(word, self.grams)
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text))
        if not counts or not self.model.langs:
            return UNKNOWN, 0.0
        total, items = self.model.prior.copy(), list(counts.items())
        for start in range(0, len(items), self.rows // 2):
            part = items[start : start + self.rows // 2]
            if len(self.at) + len(part) > self.rows:
                self.at.clear()
            at = [self.at[w] if w in self.at else self._position(w) for w, _ in part]
            total += np.array([n for _, n in part], dtype=float) @ self.matrix[at]
        best = int(np.argmax(total))
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def train(
    docs: DataFrame,
    teaches: Column,
    text_column: str = "text",
    lang_column: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    max_languages: int = MAX_LANGUAGES,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> Model:
    """The model learned from the rows for which `teaches` is true."""
    labelled = docs.filter(teaches & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    labelled = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    per_lang = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    docs_by_lang = {r["lang"]: r["count"] for r in per_lang}
    if not docs_by_lang:
        return Model({}, [], [], {})
    steps = 1 << 30
    limits = {lang: min(steps, int(steps * sample_rows / n)) for lang, n in docs_by_lang.items()}
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]
    sample = labelled.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(steps)) < limit)
    words = sample.mapInArrow(_count_words, "lang string, item string, n bigint")
    words = cut_lineage(words.groupBy("lang", "item").agg(F.sum("n").alias("n")))
    grams = words.mapInArrow(_count_grams, "lang string, item string, n bigint")
    grams = cut_lineage(grams.groupBy("lang", "item").agg(F.sum("n").alias("n")))
    totals = words.groupBy("lang", F.lit(0).alias("kind")).agg(F.sum("n").alias("n"))
    totals = totals.union(grams.groupBy("lang", F.length("item").alias("kind")).agg(F.sum("n").alias("n")))
    counted = {(r["lang"], r["kind"]): r["n"] for r in totals.collect()}  # a few for each of `max_languages`

    def most_frequent(table: DataFrame, bound: int) -> list[tuple]:
        """Each language's most frequent items, as many for one as for another."""
        first = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
        quota = max(1, bound // len(docs_by_lang))
        rows = table.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= quota)
        return [tuple(r) for r in rows.select("lang", "item", "n").orderBy("lang", "nth").collect()]

    return Model(docs_by_lang, most_frequent(words, max_words), most_frequent(grams, max_grams), counted)


def identify(docs: DataFrame, model: Model, columns: list[str], text_column: str = "text") -> DataFrame:
    """`columns` with `lang_pred` and `score` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    text = fresh("_text", columns)
    picked = docs.select(*columns, text_of(text_column).alias(text))
    schema, names = picked.drop(text).schema, output_names(("lang_pred", "score"), columns)
    schema = schema.add(names[0], "string").add(names[1], "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model.of(shared.value))
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column(len(columns)).to_pylist()]
            langs, scores = ([x[i] for x in found] for i in (0, 1))
            arrays = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *arrays], names=schema.names)

    return in_small_batches(picked).mapInArrow(run, schema)
