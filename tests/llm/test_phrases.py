import random
import re
from collections import Counter

import pytest
from fixtures import documents, empty

from onefold.llm import phrases


def brute(rows, least=10, top=2000, half=50):
    """All phrases of every language, counted and ranked plainly."""
    counts = {}
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            around = [c for q, c in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * c >= half * a for c in around):
                continue
            value, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-value, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (value, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -value))
    return sorted(out)


def texts(seed, docs, vocabulary, length, repeat):
    rng, rows = random.Random(seed), []
    words = [f"{'Wort' if i % 3 else 'é'}{i}" for i in range(vocabulary)]
    fixed = [" ".join(rng.choices(words, k=rng.randint(2, 6))) for _ in range(12)]
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, length)):
            parts.append(rng.choice(fixed) if rng.random() < repeat else words[min(int(rng.expovariate(6) * vocabulary), vocabulary - 1)])
            parts.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "\x85", " x! "]))
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(parts)))
    return [*rows, *rows[:5], ("en", None), (None, ""), ("xx", "a b c")]


@pytest.mark.parametrize(("least", "top", "half", "first", "chunk"), [(10, 2000, 50, None, 2_000_000), (3, 15, 50, 1, 700), (2, 40, 90, 5, 200)])
def test_equals_brute_force(spark, least, top, half, first, chunk):
    rows = texts(least, 120, 60, 40, 0.2)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(docs, least=least, top=top, half_percent=half, first_wave=first, chunk_codes=chunk)
    want = brute(rows, least, top, half)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 30


def test_ties_at_the_last_rank_and_full_sieves(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SIEVE_BITS", 1 << 11)  # lets nearly everything through
    rows = [("en", f"p{i} q{i}, r{i} s{i} t{i}") for i in range(60) for _ in range(4)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, least=4, top=25, first_wave=3).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, 25)


def test_products_past_64_bits(spark):
    triple = spark.createDataFrame([(3 * 10**12, 4 * 10**12, 5 * 10**12)], "a long, l long, r long")
    got = triple.select(phrases.score("a", "l", "r").alias("s")).first().s
    assert got == 1_000_000 * (3 * 10**12) ** 2 // (20 * 10**24)


def test_clashing_hashes_are_coded_anew(spark, monkeypatch):
    real = phrases.xxhash.xxh3_64_intdigest
    hashed = lambda w, seed=0: real(w, seed) if seed or w not in (b"a", b"b") else 7
    monkeypatch.setattr(phrases.xxhash, "xxh3_64_intdigest", hashed)
    chunks = [phrases.Coder() for _ in range(2)]
    for c in chunks:
        c.add(b"a b c")
    assert len(set(chunks[0].row("en", 0)[2][0].as_py())) == 2
    assert len(set(chunks[1].row("en", 1)[2][0].as_py())) == 3


def test_clash_is_seen(spark):
    coded = spark.createDataFrame([("en", ["a", "b", "c"], [7, 7, 8], [6, 6, 9], b"")], phrases.CODED)
    assert [(r.w, r.n, r.clash) for r in phrases.frequent_words(coded, 10).collect()] == [(7, 12, True)]


def test_odd_rows_extra_columns_and_empty_tables(spark):
    docs = documents(spark)
    got = phrases.collocations(docs, least=2, top=50).collect()
    assert sorted(tuple(r) for r in got) == brute([(r.lang, r.text) for r in docs.collect()], 2, 50)
    assert phrases.collocations(empty(spark)).count() == 0
