"""Secret scanning with a trigram inverted index, in DataFrame operations only.

Each rule's regular expression gives a Boolean trigram query: an OR over its literal alternatives of the
AND over the trigrams any match must contain, letters folded. Indexing lists, for each trigram that some
rule asks for, the documents that hold it. Postings are intersected per document by combining bit masks,
the documents that satisfy a rule are its candidates, and only they are searched with the expression.
A rule without mandatory trigrams searches every document.

A document is known by two hashes of its id and text, so the index needs no row numbers, repeated rows
share one posting, and a collision could only add a candidate. Spans are counted in code points, end
exclusive. Null texts count as empty; documents without secrets have empty span lists. Equal starts are listed in the
order of the kinds. Work grows in proportion to a text's length and matches; a text is held whole by its task. Empty
tables give empty results. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onefold.llm.shared import fresh, text_of
from onefold.session import cut_lineage

MAX_ALTERNATIVES = 64
MASK_BITS = 62
BLOCK = 256  # matches of a text whose places are summed together


@dataclass(frozen=True)
class Rule:
    """`least`: characters that group `group` of a match must have, or the match is dropped."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False
    base: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# The three base kinds, in the order in which equal starts are listed. Where a match is one
# run of a class, later starts in a run are shorter still, so its least length may stand in the pattern.
BASE = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12, 2, any_case=True, base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", 16, base=True),
]
# Further public token formats.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{15,}", 20),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 27),
]
RULES = [*BASE, *MORE]


def trigram_query(rule: Rule) -> list[frozenset[str]] | None:
    """Alternatives, each the trigrams of which all must occur; None where a match may have none."""
    parser = re._parser
    alternatives = [("",)]  # each a tuple of literal runs; the last is still open

    def close(found: list[tuple]) -> list[tuple]:
        return [a if a[-1] == "" else (*a, "") for a in found]

    def walk(nodes, found: list[tuple]) -> list[tuple]:
        for op, value in nodes:
            name = str(op)
            if name == "LITERAL":
                found = [(*a[:-1], a[-1] + chr(value).lower()) for a in found]
            elif name == "SUBPATTERN":
                found = walk(value[3], found)
            elif name == "BRANCH":
                found = [x for branch in value[1] for x in walk(branch, found)]
            elif name == "MAX_REPEAT" and value[:2] == (0, 1):
                found = [*found, *walk(value[2], found)]
            elif name == "MAX_REPEAT" and value[0] >= 1:
                found = close(walk(value[2], found))
            else:
                found = close(found)
            found = list(dict.fromkeys(found))
            if len(found) > MAX_ALTERNATIVES:
                return close([("",)])
        return found

    alternatives = walk(parser.parse(rule.pattern), alternatives)
    sets = {frozenset(run[i : i + 3] for run in a for i in range(len(run) - 2)) for a in alternatives}
    if frozenset() in sets:
        return None
    return sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)


def _key(id_column: str, text: Column) -> list[Column]:
    return [F.xxhash64(F.col(id_column), text).alias("k1"), F.hash(text, F.col(id_column)).alias("k2")]


def postings(docs: DataFrame, trigrams: list[str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The inverted index: `trigram` (its number) and the two hashes of each document that holds it."""
    low = F.lower(text_of(text_column))
    held = [F.when(F.contains(low, F.lit(g)), F.lit(i)) for i, g in enumerate(trigrams)]
    found = docs.select(
        *_key(id_column, text_of(text_column)), F.explode(F.array_compact(F.array(*held))).alias("trigram")
    )
    return cut_lineage(found)


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """`k1, k2` and one boolean column per rule for documents that satisfy some rule's query."""
    at = {g: i for i, g in enumerate(trigrams)}
    words = range(0, len(trigrams), MASK_BITS)
    masks = [
        F.bit_or(
            F.expr(f"if(trigram BETWEEN {w} AND {w + MASK_BITS - 1}, shiftleft(1L, trigram - {w}), 0L)")
        ).alias(f"mask{w}")
        for w in words
    ]

    def holds(need: frozenset[str]) -> Column:
        true = F.lit(True)
        for w in words:
            bits = sum(1 << (at[g] - w) for g in need if w <= at[g] < w + MASK_BITS)
            true = true & (F.col(f"mask{w}").bitwiseAND(F.lit(bits)) == bits)
        return true

    flags = []
    for kind, alternatives in queries.items():
        any_of = F.lit(False)
        for need in alternatives:
            any_of = any_of | holds(need)
        flags.append(any_of.alias(kind))
    found = index.groupBy("k1", "k2").agg(*masks).select("k1", "k2", *flags)
    some = F.lit(False)
    for kind in queries:
        some = some | F.col(kind)
    return found.filter(some)


SPAN = "struct<start:int,rank:int,stop:int,kind:string,base:boolean>"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def starts_of(sizes: Column) -> Column:
    """For every place of an array of numbers, the sum of those before it.

    Sums run within blocks, then over the blocks, so an array is not copied at each of its places.
    """
    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(sizes) - 1, F.lit(0)) / BLOCK).cast("int"))
    part = lambda b: F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))
    running = lambda xs: F.aggregate(
        xs, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )
    totals = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0), lambda a, x: a + x))
    own = lambda b, before: F.transform(F.slice(running(part(b)), F.lit(1), F.size(part(b))), lambda x: x + before)
    return _let(running(totals), lambda before: F.flatten(F.transform(blocks, lambda b: own(b, F.element_at(before, b + 1)))))


def _spans(rule: Rule, rank: int, text: Column) -> Column:
    """Spans of all matches that are long enough, in order, of a text that is not null.

    The pieces between matches and the matches themselves, in turn, give every start.
    """
    all_of = lambda group: F.regexp_extract_all(text, F.lit(rule.java), F.lit(group))
    hits = all_of(0)
    turns = F.zip_with(
        F.slice(F.split(text, rule.java, -1), F.lit(1), F.size(hits)),
        F.zip_with(
            hits, all_of(rule.group) if rule.group else hits, lambda h, v: F.struct(F.length(h).alias("hit"), F.length(v).alias("value"))
        ),
        lambda p, x: F.struct(F.length(p).alias("piece"), x["hit"].alias("hit"), x["value"].alias("value")),
    )

    def span(turn: Column, at: Column) -> Column:
        start = at + turn["piece"]
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + turn["hit"]).alias("stop"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.base).alias("base"),
            turn["value"].alias("held"),
        )

    def found(turns: Column) -> Column:
        sizes = F.transform(turns, lambda t: t["piece"] + t["hit"])
        every = F.zip_with(turns, _let(sizes, starts_of), span)
        return F.transform(F.filter(every, lambda s: s["held"] >= rule.least), lambda s: s.dropFields("held"))

    return F.when(text.rlike(rule.java), _let(turns, found).cast(f"array<{SPAN}>")).otherwise(_no_spans())


def _no_spans() -> Column:
    return F.expr(f"cast(array() AS array<{SPAN}>)")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Every document's id and `spans`: structs of start, rank of the kind, stop, kind and base, in order."""
    rules = RULES if rules is None else rules
    queries = {r.kind: q for r in rules if (q := trigram_query(r)) is not None}
    trigrams = sorted({g for q in queries.values() for need in q for g in need})
    name = fresh("_text", docs.columns)
    texts = docs.select(id_column, text_of(text_column).alias(name)).select(
        id_column, name, *_key(id_column, F.col(name))
    )
    ranks = {r.kind: i for i, r in enumerate(rules)}
    scanned = [_spans(r, ranks[r.kind], F.col(name)) for r in rules if r.kind not in queries]
    everywhere = texts.select(id_column, "k1", "k2", F.concat(_no_spans(), *scanned).alias("found"))
    if not queries:
        return everywhere.select(id_column, F.array_sort("found").alias("spans"))
    chosen = candidates(postings(docs, trigrams, id_column, text_column), queries, trigrams)
    verified = texts.join(chosen, ["k1", "k2"]).select(
        "k1",
        "k2",
        F.concat(
            *[F.when(F.col(r.kind), _spans(r, ranks[r.kind], F.col(name))).otherwise(_no_spans()) for r in rules if r.kind in queries]
        ).alias("checked"),
    )
    verified = verified.filter(F.size("checked") > 0).groupBy("k1", "k2").agg(F.first("checked").alias("checked"))
    return everywhere.join(verified, ["k1", "k2"], "left").select(
        id_column, F.array_sort(F.concat("found", F.coalesce("checked", _no_spans()))).alias("spans")
    )


def listed(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def secret_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, a count for each base kind, the digest of its base spans, and all spans."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return scan(docs, id_column, text_column).select(
        id_column,
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )
