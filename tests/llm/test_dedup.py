import random
from collections import Counter, defaultdict

import pytest
import xxhash
from fixtures import documents, empty, multiset, sha
from pyspark.sql import functions as F

from onefold.llm import exact_dedup, golay, simhash


def exact_brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        stays = False
        for i in ids:
            kept, stays = (True, True) if i == best and not stays else (False, stays)
            out[(i, best, len(ids), kept, sha(text))] += 1
    return out


@pytest.mark.parametrize("fan_in", [2, 3, 16])
def test_exact_equals_brute_force_at_every_fan_in(spark, fan_in):
    docs = documents(spark).repartition(7)
    rows = exact_dedup.digest_rows(docs, "doc_id", "text")
    got = exact_dedup.decisions(rows, fan_in).select("id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    assert multiset(got) == exact_brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_exact_query_and_rows_that_stay(spark):
    docs = documents(spark)
    want = exact_brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert multiset(exact_dedup.exact_duplicates(docs)) == want
    kept = exact_dedup.keep_distinct(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({k[0]: n for k, n in want.items() if k[3]})
    assert exact_dedup.exact_duplicates(empty(spark)).count() == exact_dedup.keep_distinct(empty(spark)).count() == 0


def fingerprint_brute(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(fps):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("hot", [20_000, 2])
def test_near_duplicates_equal_brute_force(spark, hot):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    fps = [fingerprint_brute(t) for _, t in rows]
    label = components_brute(fps)
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    want = Counter((i, f"{f:016x}", least.get(x)) for (i, _), f, x in zip(rows, fps, label, strict=True))
    assert multiset(simhash.near_duplicates(docs, hot=hot)) == want
    kept = simhash.keep_one_each(docs, hot=hot)
    assert kept.columns == docs.columns and kept.count() == len(set(label))
    assert simhash.near_duplicates(empty(spark)).count() == simhash.keep_one_each(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [20_000, 3])
def test_links_lose_no_pair_within_four_bits(spark, hot):
    random.seed(5)
    fps = [random.getrandbits(64) for _ in range(150)]
    for f in list(fps):
        for bits in range(1, 7):
            fps.append(f ^ sum(1 << b for b in random.sample(range(64), bits)))
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {tuple(sorted(r)) for r in simhash.links(classes, hot).collect()}
    near = {
        (a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4
    }
    assert found <= near
    if hot == 20_000:
        assert found == near
    assert components_brute_pairs(signed, found) == components_brute_pairs(signed, near)


def components_brute_pairs(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_the_code_is_perfect():
    import numpy as np

    counts = np.bincount(golay.keys(np.arange(1 << 23)), minlength=4096)
    assert set(counts.tolist()) == {2048}
