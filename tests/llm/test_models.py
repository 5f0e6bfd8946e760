import math
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import documents, empty, fold
from pyspark.sql import functions as F

from onefold.llm import bloom_lm, mixing, neighbours, quality, toxicity
from onefold.llm.queries import QUERIES
from onefold.llm.shared import in_fold

FOLDER = "/root/testdata/sf0.01"


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


@pytest.mark.parametrize("block", [2_048, 5])
def test_neighbours_are_exact_on_small_tables(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype("f4")], 1) for i in range(60)]
    rows += [(100 + i, rows[20][1], 1) for i in range(40)] + [(61, None, 1), (62, [0.0] * 6, 1), (63, [1.0, None] * 3, 1)]
    rows += [(64, [float("nan")] * 6, 1), (65, [1.0, 2.0], 1), (None, [1.0] * 6, 1), rows[3]]
    got = neighbours.nearest(vectors(spark, rows), F.col("id") % 20 == 0, leaves=10_000).collect()
    good = {i: np.array(v, dtype=float) for i, v, _ in rows[:100]}
    want = {}
    for q in (i for i in good if i % 20 == 0):
        ranked = sorted((-(good[i] * good[q]).sum(), i) for i in good if i != q)[:20]
        for place, (score, i) in enumerate(ranked, 1):
            want[q, place] = (i, -score)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert neighbours.nearest(vectors(spark, []), F.col("id") % 20 == 0).count() == 0


def test_neighbour_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(table, F.col("id") % 20 == 0).toPandas()
    pdf = table.toPandas()
    x, ids = np.stack(pdf["embedding"].map(lambda v: np.asarray(v, dtype=float))), pdf["vec_id"].to_numpy()
    hits = []
    for q, own in got.groupby("query_id"):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hits.append(len(set(ids[np.lexsort((ids, -score))[:20]]) & set(own["vec_id"])) / 20)
    assert np.mean(hits) >= 0.9


def test_quality_separates_held_out_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op7_quality"](spark, FOLDER).join(labels, "doc_id").filter("held_out").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(r.kept for r in rows if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in rows)


def test_quality_sees_words_beyond_their_look(spark):
    wanted, salad = "river stone north light under seven".split(), "klopf zarbs wunty grimp trofa belix".split()
    rows = [(i, " ".join((wanted if i % 2 else salad)[(i + k * k) % 6][:5] for k in range(40))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    got = {r.doc_id: r.log_weight for r in quality.resample(docs, labels, F.lit(True), ["doc_id"]).collect()}
    assert min(got[i] for i in range(21, 60, 2)) > max(got[i] for i in range(20, 60, 2)) + 1


def test_quality_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(4, 1), (9, 1), (None, 0), (11, None)], "doc_id long, quality int")
    assert quality.sampled(docs, labels, F.lit(True)).count() == docs.count()  # one kind of label rejects nothing
    both = labels.union(spark.createDataFrame([(13, 0), (13, 0)], labels.schema))
    kept = quality.sampled(docs, both, F.lit(True))
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    assert quality.sampled(empty(spark), both, F.lit(True)).count() == 0


def quality_brute(rows, labels):
    """log_weight, kept and score of every row by plain counting of n-grams."""
    memo = quality.Memo()
    grams = [quality.buckets_of(t, memo).tolist() for _, t in rows]
    raw, target = Counter(), Counter()
    for (i, _), own in zip(rows, grams, strict=True):
        raw.update(own)
        if labels.get(i) == 1:
            target.update(own)
    size, kind = quality.BUCKETS, lambda b: b >= quality.BUCKETS
    total = lambda c, k: sum(n for b, n in c.items() if kind(b) == k)
    totals = [[total(c, k) for k in (False, True)] for c in (raw, target)]
    ratio = lambda b: math.log((target[b] + 0.5) / (totals[1][kind(b)] + 0.5 * size)) - math.log((raw[b] + 0.5) / (totals[0][kind(b)] + 0.5 * size))
    weights = [sum(map(ratio, own)) for own in grams]
    least = {}
    for (i, _), w in zip(rows, weights, strict=True):
        if i in labels:
            least[i] = min(w, least.get(i, math.inf))
    good, bad = (sorted(w for i, w in least.items() if labels[i] == x) for x in (1, 0))
    values = sorted(good + bad)
    right = [sum(g >= v for g in good) / len(good) + sum(b < v for b in bad) / len(bad) for v in [*values, math.inf]]
    at = right.index(max(right))
    cut = -math.inf if at == 0 else values[-1] + 1 if at == len(values) else values[at] - (values[at] - values[at - 1]) / 4
    return weights, cut


def test_quality_equals_brute_force(spark):
    docs = documents(spark).filter("doc_id IS NULL OR doc_id NOT IN (11, 13)")
    known = {8: 1, 12: 1, 15: 1, 4: 0, 5: 0, 9: 0, 100: 0, 102: 0}
    labels = spark.createDataFrame([*known.items(), (None, 1), (7, None)], "doc_id long, quality int")
    got = quality.resample(docs, labels, F.lit(True), ["doc_id", "text"]).collect()
    rows = [(r.doc_id, r.text) for r in got]
    assert Counter(rows) == Counter(tuple(r) for r in docs.select("doc_id", "text").collect())
    weights, cut = quality_brute(rows, known)
    assert math.isfinite(cut)
    assert [round(r.log_weight, 5) for r in got] == [round(w, 5) for w in weights]
    above = sum(r.log_weight >= cut for r in got)
    least = sorted((r.sample_key for r in got), reverse=True)[above - 1]
    assert [r.kept for r in got] == [r.sample_key >= least for r in got]
    assert all(r.score == pytest.approx(1 / (1 + math.exp(min(700.0, cut - r.log_weight))), abs=1e-6) for r in got)


def test_one_id_on_many_rows_sends_one_row_to_the_driver(spark, monkeypatch):
    rows = [(1, f"w{i % 50} good text here") for i in range(30_000)] + [(2, "### $$$"), (3, "plain words here"), (4, "zorp idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    sizes, real = [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda df: sizes.append(len(x := real(df))) or x)
    assert quality.resample(docs, labels, F.lit(True), ["doc_id"]).count() == len(rows)
    assert max(sizes) <= 4
    real_arrow = type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: sizes.append((x := real_arrow(df)).num_rows) or x)
    weights, bias = toxicity.train(docs, labels, F.lit(True))
    assert max(sizes) <= 4


def test_toxicity_scores_equal_brute_force(spark):
    folder = FOLDER
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = in_fold("doc_id", 4, 2)
    weights, bias = toxicity.train(docs, labels, ~held)
    ask = docs.limit(200).unionByName(documents(spark).select(docs.columns))
    got = toxicity.toxicity(ask.withColumn("held_out", held), weights, bias, ["doc_id", "text", "held_out"]).collect()
    assert len(got) == ask.count() and any(r.predicted for r in got)
    for r in got:
        words = set(toxicity.LETTERS.findall((r.text or "").lower()))
        features = words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n}
        score = 1 / (1 + math.exp(-(bias + sum(weights.get(x, 0.0) for x in features))))
        assert r.score == pytest.approx(score, abs=1e-9) and r.predicted == (score >= 0.3) and r.held_out == fold(r.doc_id, 4, 2)


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(1).normal(size=3000)] + [7.0] * 50
    table = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 30, 51, 1500, len(values)):
        assert quality.kth_largest(table, "x", k) == sorted(values, reverse=True)[k - 1]


def mix_brute_target(sizes):
    weights, caps = [(5, 2, 1)[i % 3] for i in range(len(sizes))], [2 * s for s in sizes]
    full, fixed = sum(sizes) * 1.5, {}
    while True:
        left, open_ones = full - sum(fixed.values()), [i for i in range(len(sizes)) if i not in fixed]
        share = {i: left * weights[i] / sum(weights[j] for j in open_ones) for i in open_ones}
        over = {i: caps[i] for i in open_ones if share[i] > caps[i]}
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= over


def test_targets():
    for sizes in ([10, 10, 10], [1000, 1, 50, 3], [5, 0, 7], [0, 0], [7]):
        assert mixing.targets_of(sizes) == pytest.approx([t or 0 for t in mix_brute_target(sizes)])


def test_permutation():
    for size in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, 5).tolist()) == list(range(size))


def test_mix_report_and_documents(spark):
    docs = documents(spark)
    report = mixing.mix_report(docs, block_words=16).collect()
    again = mixing.mix_report(docs.repartition(5), block_words=16).collect()
    assert Counter(map(tuple, report)) == Counter(map(tuple, again))
    texts = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    size = lambda t: len((t or "").encode().split())
    totals = Counter()
    for _, t, s in texts:
        totals[s] += size(t)
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mix_brute_target([totals[n] for n in names]), strict=True))
    want = Counter((i, size(t), totals[s], round(targets[s], 6)) for i, t, s in texts)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in report) == want
    assert all(r.taken <= 2 * r.size for r in report)
    assert abs(sum(r.taken for r in report) - 1.5 * sum(totals.values())) <= 16 * len(names)
    by_source = dict(docs.select("doc_id", "source").collect())
    taken = Counter()
    for r in report:
        taken[by_source[r.doc_id]] += r.taken
    assert all(abs(taken[n] - targets[n]) <= max(1, 0.02 * targets[n]) for n in names)
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert sum(size(r.text) for r in rows) == sum(r.taken for r in report)
    whole = {t for _, t, _ in texts if t}
    assert all(any(r.text in t for t in whole) and r.n_chars == len(r.text) for r in rows)
    assert mixing.mix_report(empty(spark)).count() == mixing.mixed_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("sizes", [[100] * 12, [1, 2, 3, 50, 7], [5_000, 40, 3, 900, 100_000, 1_300], [4, 0, 9]])
def test_every_source_gets_near_its_target(spark, sizes):
    rows, names = [], [f"s{i:02}" for i in range(len(sizes))]
    for name, size in zip(names, sizes, strict=True):
        texts = [" ".join(f"{name}w{k}" for k in range(at, min(size, at + 37))) for at in range(0, size, 37)] or [""]
        rows += [(len(rows) + i, t, name) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    report = mixing.mix_report(docs.repartition(3)).collect()
    source, taken, target = {i: n for i, _, n in rows}, Counter(), {}
    for r in report:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[n] - target[n]) <= max(1, 0.02 * target[n]) for n in names)
    mixed = Counter(w for r in mixing.mixed_documents(docs).collect() for w in r.text.split())
    per_source = Counter()
    for w, n in mixed.items():
        assert n <= 2
        per_source[w[:3]] += n
    assert per_source == +taken


def _planned(mixing, docs):
    sized = mixing._sized(docs, [F.monotonically_increasing_id().alias("row")], "doc_id", "source", "text")
    return mixing._with_plan(sized, mixing.BLOCK_WORDS)[:2]


def test_slots_are_made_in_many_tasks_and_not_broadcast(spark, monkeypatch, capsys):
    monkeypatch.setattr(mixing, "TASK_SLOTS", 5)
    docs = spark.createDataFrame([(i, "a b c d e f " * 20, f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    sized, plan = _planned(mixing, docs)
    draws = mixing.shard_draws(spark, plan, 8)
    assert mixing.filled_slots(draws.withColumn("first", F.lit(0).cast("long")), plan).rdd.getNumPartitions() == 1 + plan.total_slots // 5
    mixing._taken_pieces(sized, plan).explain()
    top = capsys.readouterr().out.split("Join")[0:2]
    assert "SortMerge" in top[0] and "Broadcast" not in top[0].rsplit("\n", 1)[-1]


def lm_brute(rows):
    tokens = {k: [*(t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split(), b""] for k, (_, t) in enumerate(rows)}
    counts = Counter()
    for k, (i, _) in enumerate(rows):
        if not fold(i, 5, 1):
            counts.update(tokens[k])
    total, room = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    out = Counter()
    for k, (i, _) in enumerate(rows):
        base = sum(math.log10((counts[t] + 0.5) / room) for t in tokens[k])
        out[(i, fold(i, 5, 1), len(tokens[k]), sum(counts[t] > 0 for t in tokens[k]), total, round(base, 6))] += 1
    return out


@pytest.mark.parametrize("bounds", [{}, {"head_words": 12, "pair_words": 4}])
def test_lm_base_equals_brute_force(spark, bounds):
    docs, held = documents(spark), in_fold("doc_id", 5, 1)
    got = bloom_lm.lm_scores(docs.withColumn("held_out", held), ~held, ["doc_id", "held_out"], **bounds).collect()
    found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert found == lm_brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert all(r.score <= 1e-9 and math.isfinite(r.score) for r in got)
    if not bounds:  # repeated phrases make pairs far likelier than single words
        assert sum(r.score for r in got) > sum(r.base_score for r in got)


def lm_brute_score(rows):
    """The log probability of every text from exact counts, rounded as the levels of the filter round them."""
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    tokens = [[*(t or "").encode().translate(low).split(), b""] for _, t in rows]
    one, two = Counter(), Counter()
    for (i, _), own in zip(rows, tokens, strict=True):
        if not fold(i, 5, 1):
            one.update(own)
            two.update(zip(own, own[1:]))
    room, out = sum(one.values()) + 0.5 * (len(one) + 1), Counter()
    for (i, _), own in zip(rows, tokens, strict=True):
        total = 0.0
        for before, t in zip([None, *own], own, strict=False):
            n, pair = one[before] if before is not None else 0, two[before, t]
            level = 1 + int(math.log2(pair)) if pair else 0
            about = 2.0 ** (level - 1) * math.sqrt(2) if level > 1 else level
            weight = n / (n + bloom_lm.TRUST)
            total += math.log10(weight * min(1.0, about / max(n, 1)) + (1 - weight) * (one[t] + 0.5) / room)
        out[i, len(own), round(total, 5)] += 1
    return out


@pytest.mark.parametrize(("chunk", "broadcast", "segment"), [(1_000_000, 8 << 20, 1 << 20), (60, 8 << 20, 64), (60, 0, 64), (5_000, 0, 4_096)])
def test_lm_score_equals_brute_force(spark, monkeypatch, chunk, broadcast, segment):
    for name, value in (("CHUNK_TOKENS", chunk), ("BROADCAST_BYTES", broadcast), ("SEGMENT_BYTES", segment), ("BITS_PER_ITEM", 64)):
        monkeypatch.setattr(bloom_lm, name, value)
    docs, held = documents(spark), in_fold("doc_id", 5, 1)
    got = bloom_lm.lm_scores(docs.repartition(3), ~held, ["doc_id"], head_words=9).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 5)) for r in got) == lm_brute_score(rows)


def test_lm_pairs_of_rare_tokens_and_single_pairs_count(spark, monkeypatch):
    rows = [(i, f"only{i} once{i} here{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(bloom_lm, "TRUST", 1.0)
    for bound in (bloom_lm.BROADCAST_BYTES, 0):  # by broadcast, and by a join with the segments
        monkeypatch.setattr(bloom_lm, "BROADCAST_BYTES", bound)
        monkeypatch.setattr(bloom_lm, "SEGMENT_BYTES", 256)
        for r in bloom_lm.lm_scores(docs, F.lit(True), ["doc_id"], head_words=2).collect():
            share, first = 1.5 / (1200 + 0.5 * 902), math.log10(1.5 / (1200 + 0.5 * 902))
            end = 0.5 * 1 + 0.5 * 300.5 / (1200 + 0.5 * 902)
            assert r.n_known == 4 and r.score == pytest.approx(first + 2 * math.log10(0.5 + 0.5 * share) + math.log10(end))


@pytest.mark.parametrize("items", [2_000, 200_000])
def test_filter_keeps_its_rate_of_false_positives(items):
    seen = np.sort(bloom_lm.mixed(np.arange(items, dtype=np.uint64)))
    data = bloom_lm.build_segment(seen, np.ones(items, dtype=np.int64))
    other = bloom_lm.mixed(np.arange(items, items + 100_000, dtype=np.uint64))
    level = bloom_lm.probe(other, np.frombuffer(data, np.uint8), np.zeros(1, dtype=np.int64), np.array([len(data)]))
    assert (level > 0).mean() < 0.01


def test_lm_without_training_rows(spark):
    got = bloom_lm.lm_scores(documents(spark), F.lit(False), ["doc_id"]).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.base_score == 0 for r in got)
    assert bloom_lm.lm_scores(empty(spark), F.lit(True), ["doc_id"]).count() == 0


def test_filter_gives_every_count_back_within_a_factor_of_two():
    rng = np.random.default_rng(2)
    hashes = np.sort(bloom_lm.mixed(np.arange(1, 5001, dtype=np.uint64)) >> np.uint64(12))  # all in segment 0
    counts = rng.integers(2, 5000, size=5000)
    data = bloom_lm.build_segment(hashes, counts)
    flat, sizes = np.frombuffer(data, np.uint8), np.zeros(bloom_lm.SEGMENTS, dtype=np.int64)
    sizes[0] = len(data)
    level = bloom_lm.probe(hashes, flat, np.zeros(bloom_lm.SEGMENTS, dtype=np.int64), sizes)
    assert (level >= bloom_lm.levels_of(counts)).all()
    assert len(data) <= bloom_lm.SEGMENT_BYTES


def test_toxicity_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op10_toxicity"](spark, FOLDER).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.02 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic == 1) >= 0.6 * sum(r.toxic for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(4, 0), (None, 1), (9, None), (13, 1)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        weights, bias = toxicity.train(docs, known, F.lit(True))
        rows = toxicity.toxicity(docs, weights, bias, ["doc_id"]).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(empty(spark), weights, bias, ["doc_id"]).count() == 0


def test_lexicon_votes_and_has_no_weights_of_its_own(spark):
    said = ["what an idiot he is", "so ein trottel er ist", "quel connard celui là"]
    rows = [(i, f"{said[i % 3]} zorp w{i}" if i % 4 == 0 else f"the clown took trash out w{i} v{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    weights, bias = toxicity.train(docs, none, F.lit(True))  # no labels: the lexicon votes over the documents
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, weights, bias, ["doc_id"]).collect()}
    assert weights["zorp"] > 0 and all(got[i] == (i % 4 == 0) for i in got)
    clean = spark.createDataFrame([(i, 0) for i in range(1, 200, 4)], none.schema)
    weights, _ = toxicity.train(docs, clean, F.lit(True))
    assert not {"clown", "trash", *toxicity.PUBLIC_WORDS} & set(weights)


def test_correlated_voters_count_for_less():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    heard = lambda right, wrong: np.where(truth, rng.random(4000) < right, rng.random(4000) < wrong)
    one = heard(0.7, 0.05)
    votes = np.column_stack([one, one, heard(0.7, 0.05), heard(0.6, 0.1), np.zeros(4000)]).astype(float)
    votes[:, -1] = ~votes[:, :-1].any(axis=1)
    model = toxicity.LabelModel(votes, 0.3)
    assert model.weight[0] < 0.8 * model.weight[2]
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.85
    assert zlib.crc32(b"") == 0
