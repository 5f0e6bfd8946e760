"""Language-model scoring from a log-frequency Bloom filter.

Texts are read once: documents go in chunks of about `CHUNK_TOKENS` tokens, written as codes by each chunk's own
dictionary, so all later passes read numbers and no text is shuffled. Counting runs over all training documents and
all their tokens: tokens by name, and pairs of neighbouring tokens by a hash of both. A pair with count c has the
level 1 + floor(log2(c)); it is put into a Bloom filter once for each level up to its own. A reader probes level 1,
2, ... until a probe fails, which gives the count back to within a factor of two (a count of one exactly). The filter
grows with what it holds: every segment gets `BITS_PER_ITEM` bits an item, and there is a power of two of segments,
each of about `SEGMENT_BYTES` at most. So the rate of false positives does not depend on the size of the input.

Distinct pair hashes, as long as the number of tokens needs, go to their segments once for each chunk, as packed
differences with their counts. A filter that
cannot exceed `BROADCAST_BYTES` is broadcast; a larger one stays where its segments are built, which answer the
chunks at once with a byte for each hash. Hot pairs are sent once a chunk.

The probability of a token is lambda * c(previous, token) / c(previous) + (1 - lambda) * p(token), with lambda =
c(previous) / (c(previous) + `TRUST`). p is the smoothed share (c + 0.5) / (N + 0.5 (V + 1)). A count that comes back
from the filter is rounded, so the first share is held to at most one and probabilities do not add up to exactly one.

Counts of at most `HEAD_WORDS` most frequent tokens are broadcast exactly; the distinct other tokens of a
chunk, which are rare by definition, meet their exact counts in a join by token, and the counts go back to the
chunk. Every token of every whole text is scored.

Null texts count as empty: one end token. Without training rows every count is zero. Repeated rows are
scored each; a null id counts as the empty text when folds are dealt. A text is never cut: one that is longer than a
chunk makes a chunk of its own, which one task holds. Empty tables give empty results. Passed columns keep their
names; an output column whose name is taken gets underscores in front.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onefold.llm.shared import ASCII_LOWER, fresh, from_planes, in_small_batches, numbered, output_names, planes
from onefold.session import cut_lineage

END = b""  # no word is empty
HEAD_WORDS = 1 << 18
SEGMENTS, SEGMENT_BYTES, BITS_PER_ITEM, PROBES = 4_096, 1 << 20, 12, 4
BROADCAST_BYTES = 8 << 20
CHUNK_TOKENS, SPARE_BITS = 1_500_000, 12
TRUST = 50.0
OUTPUT = (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double"))


def token_list(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, then one end."""
    return [*(text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split(), END]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hash(token: bytes) -> int:
    return xxhash.xxh3_64_intdigest(token)


def segments_for(pairs: int) -> int:
    """The number of segments, a power of two, that gives a segment of that many pairs about `SEGMENT_BYTES`."""
    return 1 << max(0, (pairs * BITS_PER_ITEM // 8 // SEGMENT_BYTES)).bit_length()


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each hash, by its first bits; rises with the hash."""
    if segments == 1:
        return np.zeros(len(hashes), dtype=np.int64)
    return (hashes >> np.uint64(65 - segments.bit_length())).astype(np.int64)


def positions(hashes: np.ndarray, level: int, bits: np.ndarray) -> list[np.ndarray]:
    """The bits, within a segment of `bits` bits, that level `level` of each hash sets."""
    x = mixed(hashes + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    step = (x >> np.uint64(32)) | np.uint64(1)
    return [((x & np.uint64(0xFFFFFFFF)) + np.uint64(i) * step) % bits for i in range(PROBES)]


def levels_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def build_segment(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter part that holds these pairs."""
    levels = levels_of(counts)
    size = max(8, -(-int(levels.sum()) * BITS_PER_ITEM // 8))
    bits = np.zeros(size * 8, dtype=bool)
    for level in range(1, int(levels.max()) + 1):
        own = hashes[levels >= level]
        for at in positions(own, level, np.full(len(own), size * 8, dtype=np.uint64)):
            bits[at.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def probe(hashes: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The level that the filter gives each hash; 0 for none."""
    segment = segment_of(hashes, len(sizes))
    bits, level = sizes[segment].astype(np.uint64) * np.uint64(8), np.zeros(len(hashes), dtype=np.int64)
    alive = np.nonzero(bits)[0]
    while len(alive):
        nth = int(level[alive[0]]) + 1
        base, inside = starts[segment[alive]], np.ones(len(alive), dtype=bool)
        for at in positions(hashes[alive], nth, bits[alive]):
            at = at.astype(np.int64)
            inside &= (flat[base + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive = alive[inside]
        level[alive] = nth
    return level


def _runs(found: np.ndarray, segments: int) -> list[tuple[int, int, int]]:
    """`segment, start, stop` of the runs of equal segments in ascending hashes."""
    if not len(found):
        return []
    own = segment_of(found, segments)
    starts = np.nonzero(np.diff(own, prepend=-1))[0]
    return list(zip(own[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(own)], strict=True))


def _side_by_side(parts: dict[int, bytes], segments: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All segments in one piece, with their starts and sizes in bytes."""
    sizes = np.zeros(segments, dtype=np.int64)
    for segment, data in parts.items():
        sizes[segment] = len(data)
    flat = b"".join(parts[s] for s in sorted(parts)) or b"\0"
    return flat, np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes


# ---- chunks of coded documents ----


def packed_bytes(data: bytes) -> bytes:
    """Data with its length, compressed."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked_bytes(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def tokens_in(words: bytes) -> list[bytes]:
    """The dictionary of a chunk: no token has a blank, and the empty one is the end."""
    return unpacked_bytes(words).split(b" ")


class Coder(dict):
    """Token -> its code in the chunk; the codes and the flags of the documents so far."""

    def __init__(self):
        super().__init__()
        self.codes, self.flags, self.rows = array("I"), [], []

    def __missing__(self, token: bytes) -> int:
        self[token] = code = len(self)
        return code

    def row(self) -> list[pa.Array]:
        """`words, seen, codes, docs` of the chunk, the first three packed; codes by falling count."""
        codes = np.frombuffer(self.codes, dtype=np.uint32)
        order = np.argsort(-np.bincount(codes, minlength=len(self)), kind="stable")
        place = np.zeros(len(self), dtype="<u4")
        place[order] = np.arange(len(self))
        names = list(self)
        names = [names[i] for i in order.tolist()]
        codes = place[codes]
        ends = np.nonzero(codes == names.index(END))[0]
        teaches = np.repeat(np.array(self.flags, dtype=bool), np.diff(ends, prepend=-1))
        seen = np.bincount(codes[teaches], minlength=len(names))
        docs = pa.concat_arrays(self.rows)
        packed = [packed_bytes(x) for x in (b" ".join(names), planes(seen.astype("<u8")), planes(codes))]
        return [*(pa.array([x], pa.binary()) for x in packed), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)]


def coded_chunks(docs: DataFrame, teaches: Column, columns: list[str], text_column: str) -> tuple[DataFrame, str]:
    """The documents as written chunks, numbered, and the name of the number's column.

    `docs` holds the passed columns of each document and, last, whether it teaches.
    """
    flag, text = fresh("_teaches", columns), fresh("_text", columns)
    picked = docs.select(*columns, F.coalesce(teaches, F.lit(False)).alias(flag), F.col(text_column).alias(text))
    one = picked.drop(text).schema
    schema = T.StructType().add("words", "binary").add("seen", "binary").add("codes", "binary").add("docs", T.ArrayType(one))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            kept = pa.StructArray.from_arrays(batch.columns[:-1], fields=list(batch.schema)[:-1])
            flags, begun = batch.column(batch.num_columns - 2).to_pylist(), 0
            for at, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                coder.codes.extend(map(coder.__getitem__, token_list(text)))
                if len(coder.codes) >= CHUNK_TOKENS:
                    coder.rows.append(kept[begun : at + 1])
                    coder.flags.extend(flags[begun : at + 1])
                    yield pa.RecordBatch.from_arrays(coder.row(), names=schema.names)
                    coder, begun = Coder(), at + 1
            if begun < len(kept):
                coder.rows.append(kept[begun:])
                coder.flags.extend(flags[begun:])
        if coder.flags:
            yield pa.RecordBatch.from_arrays(coder.row(), names=schema.names)

    return numbered(in_small_batches(picked).mapInArrow(run, schema))


class Chunk:
    """Codes and distinct pairs of one chunk."""

    def __init__(self, words: bytes, codes: bytes, hash_bits: int, allowed: np.ndarray | None):
        self.words, self.codes = tokens_in(words), from_planes(unpacked_bytes(codes), "<u4")
        self.ends = np.nonzero(self.codes == self.words.index(END))[0]
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])
        inside = np.ones(len(self.codes), dtype=bool)
        inside[self.starts] = False
        hashes = np.fromiter(map(token_hash, self.words), dtype=np.uint64, count=len(self.words))
        if allowed is not None:
            known = np.isin(hashes, allowed)[self.codes]
            inside &= known
            inside[1:] &= known[:-1]
        self.at = np.nonzero(inside)[0]  # tokens that have a predecessor
        both = self.codes[self.at - 1].astype(np.uint64) << np.uint64(32) | self.codes[self.at]
        found, self.place = np.unique(both, return_inverse=True)
        first, second = hashes[found >> np.uint64(32)], hashes[found & np.uint64(0xFFFFFFFF)]
        self.pairs = mixed(mixed(first + np.uint64(0x9E3779B97F4A7C15)) + second)
        self.pairs &= ~np.uint64((1 << (64 - hash_bits)) - 1)
        self.order = np.argsort(self.pairs, kind="stable")

    def per_token(self, per_document: np.ndarray) -> np.ndarray:
        return np.repeat(per_document, np.diff(self.ends, prepend=-1))


def _chunk_of(table: pa.Table | pa.RecordBatch, row: int, hash_bits: int, allowed: np.ndarray | None) -> Chunk:
    return Chunk(table.column("words")[row].as_py(), table.column("codes")[row].as_py(), hash_bits, allowed)


def hash_bits_for(tokens: int) -> int:
    """Bits of a pair hash: two of `tokens` pairs share one with a chance of 2^-12 at most, whatever their number."""
    return min(64, tokens.bit_length() + SPARE_BITS)


def token_counts(chunks: DataFrame) -> DataFrame:
    """`token, n`: how often training has each token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = from_planes(unpacked_bytes(seen), "<i8")
                at = np.nonzero(n)[0]
                names = pa.array(tokens_in(words), pa.binary()).take(pa.array(at)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(n[at])], names=["token", "n"])

    counts = in_small_batches(chunks.select("words", "seen")).mapInArrow(run, "token string, n long")
    return cut_lineage(counts.groupBy("token").agg(F.sum("n").alias("n")))


def pair_counts(chunks: DataFrame, number: str, segments: int, hash_bits: int, allowed: np.ndarray | None) -> DataFrame:
    """`segment, chunk, pairs, seen`: ascending distinct pair hashes of a chunk, packed, and how often training has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = _chunk_of(batch, row, hash_bits, allowed)
                teaches = batch.column("docs")[row].values
                teaches = teaches.field(teaches.type.num_fields - 1).to_numpy(zero_copy_only=False)
                counted = chunk.place[chunk.per_token(teaches)[chunk.at]]
                seen = np.bincount(counted, minlength=len(chunk.pairs))[chunk.order].astype("<u4")
                found = chunk.pairs[chunk.order]
                parts = _runs(found, segments)
                found >>= np.uint64(64 - hash_bits)
                steps = np.diff(found, prepend=np.uint64(0))
                steps[[i for _, i, _ in parts]] = found[[i for _, i, _ in parts]]
                arrays = [
                    pa.array([s for s, _, _ in parts], pa.int32()),
                    pa.array([batch.column(number)[row].as_py()] * len(parts), pa.int64()),
                    pa.array([planes(steps[i:j].astype("<u8")) for _, i, j in parts], pa.binary()),
                    pa.array([planes(seen[i:j]) for _, i, j in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["segment", "chunk", "pairs", "seen"])

    picked = chunks.select(number, "words", "codes", "docs")
    return in_small_batches(picked).mapInArrow(run, "segment int, chunk long, pairs binary, seen binary")


def _segment(table: pa.Table, hash_bits: int) -> tuple[list[np.ndarray], bytes]:
    """The pair hashes of each chunk that asks, and the filter part that holds those which training has."""
    shift = np.uint64(64 - hash_bits)
    asked = [np.cumsum(from_planes(x, "<u8"), dtype=np.uint64) << shift for x in table.column("pairs").to_pylist()]
    hashes = np.concatenate(asked)
    counts = np.concatenate([from_planes(x, "<u4") for x in table.column("seen").to_pylist()]).astype(np.int64)
    hashes, counts = hashes[counts > 0], counts[counts > 0]
    if not len(hashes):
        return asked, b""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.nonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))[0]
    return asked, build_segment(hashes[first], np.add.reduceat(counts[order], first))


def build_filter(pairs: DataFrame, hash_bits: int) -> DataFrame:
    """`segment, data`: the parts of the filter."""

    def build(table: pa.Table) -> pa.Table:
        return pa.table({"segment": table.column("segment").slice(0, 1), "data": pa.array([_segment(table, hash_bits)[1]], pa.binary())})

    return pairs.groupBy("segment").applyInArrow(build, "segment int, data binary")


def answered(pairs: DataFrame, segments: int, hash_bits: int) -> DataFrame:
    """`chunk, segment, levels`: a byte for each pair hash that a chunk sent to a segment, in its order."""

    def answer(table: pa.Table) -> pa.Table:
        asked, data = _segment(table, hash_bits)
        own = table.column("segment")[0].as_py()
        sizes = np.zeros(segments, dtype=np.int64)
        sizes[own] = len(data)
        flat, starts = np.frombuffer(data or b"\0", dtype=np.uint8), np.zeros(segments, dtype=np.int64)
        levels = probe(np.concatenate(asked), flat, starts, sizes).astype(np.uint8)
        parts = np.split(levels, np.cumsum([len(x) for x in asked])[:-1])
        made = pa.array([x.tobytes() for x in parts], pa.binary())
        return pa.table({"chunk": table.column("chunk"), "segment": table.column("segment"), "levels": made})

    return pairs.groupBy("segment").applyInArrow(answer, "chunk long, segment int, levels binary")


# ---- scores ----


def _frequent(counts: DataFrame, bound: int) -> tuple[dict[bytes, int], int]:
    """Tokens of the highest counts, at most `bound`, and the count from which on they are all in."""
    step = F.floor(F.log2("n") * 64)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("tokens"), F.min("n").alias("least"))
    least, total = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # at most 64 rows per doubling of the counts
        if total + row["tokens"] > bound:
            break
        total, least = total + row["tokens"], row["least"]
    if least is None:
        return {}, 1 << 62
    rows = counts.filter(F.col("n") >= least).collect()
    return {r["token"].encode("utf-8", "surrogatepass"): r["n"] for r in rows}, least


def lm_scores(
    docs: DataFrame,
    teaches: Column,
    columns: list[str],
    text_column: str = "text",
    head_words: int = HEAD_WORDS,
    pair_words: int | None = None,
) -> DataFrame:
    """`columns` of every document with `n_tokens, n_known, train_tokens, base_score, score`.

    With `pair_words`, only pairs among so many most frequent tokens count; otherwise all pairs do.
    """
    sc = docs.sparkSession.sparkContext
    chunks, number = coded_chunks(docs, teaches, columns, text_column)
    counts = token_counts(chunks)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    room = total + 0.5 * (distinct + 1)
    head, least = _frequent(counts, head_words)
    known, allowed = sc.broadcast(head), None
    if pair_words is not None:
        best = sorted(head, key=lambda t: (-head[t], t))[:pair_words]
        allowed = np.array([token_hash(t) for t in best], dtype=np.uint64)

    def rare_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """`chunk, place, token`: the tokens of each chunk whose counts are not broadcast, and their codes."""
        frequent = known.value
        for batch in batches:
            for row in range(batch.num_rows):
                rare = [(i, w) for i, w in enumerate(tokens_in(batch.column(1)[row].as_py())) if w not in frequent]
                owner = pa.array(np.full(len(rare), batch.column(0)[row].as_py()))
                tokens = pa.array([w for _, w in rare], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([owner, pa.array([i for i, _ in rare], pa.int32()), tokens], names=["chunk", "place", "token"])

    asked = in_small_batches(chunks.select(number, "words")).mapInArrow(rare_tokens, "chunk long, place int, token string")
    told = asked.join(counts.filter(F.col("n") < least), "token").groupBy("chunk")
    told = told.agg(F.collect_list(F.struct("place", "n")).alias("rare"))  # at most the dictionary of one chunk
    told = told.select("chunk", "rare", F.lit(None).cast("int").alias("segment"), F.lit(None).cast("binary").alias("levels"))
    segments, hash_bits, filter_parts = segments_for(total), hash_bits_for(total), None
    pairs = pair_counts(chunks, number, segments, hash_bits, allowed)
    # A pair has no more levels than occurrences, which bounds the filter before it is built.
    if (total + 8 * segments) * BITS_PER_ITEM // 8 <= BROADCAST_BYTES and segments <= SEGMENTS:
        held = {r["segment"]: bytes(r["data"]) for r in build_filter(pairs, hash_bits).collect()}  # at most BROADCAST_BYTES
        filter_parts = sc.broadcast(_side_by_side(held, segments))
    else:
        told = told.unionByName(answered(pairs, segments, hash_bits), allowMissingColumns=True)
    schema = docs.select(*columns).schema
    for name, (_, kind) in zip(output_names([n for n, _ in OUTPUT], columns), OUTPUT, strict=True):
        schema = schema.add(name, kind)

    def levels_of_pairs(chunk: Chunk, answers: pa.Table) -> np.ndarray:
        found = chunk.pairs[chunk.order]
        if filter_parts is not None:
            flat, begins, sizes = filter_parts.value
            in_order = probe(found, np.frombuffer(flat, dtype=np.uint8), begins, sizes)
        else:
            parts = zip(answers.column("segment").to_pylist(), answers.column("levels").to_pylist(), strict=True)
            in_order = np.frombuffer(b"".join(x for _, x in sorted(x for x in parts if x[0] is not None)), dtype=np.uint8)
        level = np.zeros(len(found))
        level[chunk.order] = in_order
        return level

    def score(own: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _chunk_of(own, 0, hash_bits, allowed)
        frequent = known.value
        n = np.fromiter((frequent.get(w, 0) for w in chunk.words), dtype=np.float64, count=len(chunk.words))
        for rare in answers.column("rare").to_pylist():
            for entry in rare or ():
                n[entry["place"]] = entry["n"]
        n = n[chunk.codes]
        share = (n + 0.5) / room
        before = np.append(0.0, n[:-1])
        before[chunk.starts] = 0.0
        weight = before / (before + TRUST)
        p = (1.0 - weight) * share
        level = levels_of_pairs(chunk, answers)[chunk.place]
        about = np.where(level > 1, 2.0 ** (level - 1) * math.sqrt(2.0), level)
        p[chunk.at] += weight[chunk.at] * np.minimum(1.0, about / np.maximum(before[chunk.at], 1.0))
        starts = chunk.starts
        made = [np.diff(chunk.ends, prepend=-1), np.add.reduceat((n > 0).astype(np.int64), starts), np.full(len(starts), total, dtype=np.int64)]
        made += [np.add.reduceat(np.log10(share), starts), np.add.reduceat(np.log10(p), starts)]
        docs = own.column("docs")[0].values
        return pa.table([*docs.flatten()[:-1], *map(pa.array, made)], names=schema.names)

    return chunks.select(number, "words", "codes", "docs").groupBy(number).cogroup(told.groupBy("chunk")).applyInArrow(score, schema)
