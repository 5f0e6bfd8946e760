"""SentencePiece encoding and decoding by one forward pass over a trie of distinct marked words.

A text gets a mark in front, spaces become marks, and it is cut before every run of marks. No piece of
a model crosses such a cut (this is checked when a model is loaded), so words are encoded one by one.
The distinct words of a batch are sorted, which is a depth-first walk of their trie: the forward states
of the prefix that a word shares with the word before it are kept, and only the rest is computed.

The state of a prefix is the last piece of its best segmentation:

* unigram models: the piece that ends the path with the largest sum of scores (Viterbi);
* BPE models: the one piece that may follow the best segmentation of what is before it. A sequence of
  pieces is what merging gives exactly if each two neighbours stay two when their joined text is
  merged alone, so a prefix has a single such last piece and the walk back from the end reads the
  encoding. A largest sum of scores would not give BPE's own segmentation.

A character outside the model becomes byte pieces where the model has them, else the unknown piece.
Only bounded memos of words and pair tests live on between batches. Null and empty texts encode to nothing;
repeated rows get equal results; every column that is asked for is kept.

Decoding joins the pieces, turns bytes and marks back and takes off the first mark. Text comes back
exactly, save that a mark character itself, U+2581, comes back as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from onefold.llm.shared import fresh, in_small_batches, with_field

# Fixed value: SentencePiece's mark for a space.
MARK = "▁"
# Where the public tokenizer files lie; a parameter, the driver alone reads it.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
MEMO_PAIRS, MEMO_WORDS = 200_000, 150_000
PART_CHARS, DECODE_ROWS = 1_000_000, 256
NONE: dict = {}


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: normal pieces with score, byte pieces, and how words are segmented.

    `usable` are the pieces that a segmentation can hold: for BPE those that merging can reach.
    """

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: dict[int, int]
    unknown: int
    unigram: bool
    usable: list[str]


def load_pieces(path: str = MODEL_PATH) -> Pieces:
    """The pieces of a model file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, byte_ids = {}, {}, {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            ids[piece], scores[piece] = i, model.get_score(i)
    crossing = [p for p in ids if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces with a mark after other characters: {crossing[:5]}")
    # A BPE model scores its pieces by their rank, a whole number; a unigram model by log probability.
    return piece_set(ids, scores, byte_ids, model.unk_id(), any(s != int(s) for s in scores.values()))


def piece_set(ids: dict, scores: dict, byte_ids: dict, unknown: int, unigram: bool) -> Pieces:
    usable = [p for p in ids if len(p) > 1 and (unigram or merged(p, scores) == [p])]
    return Pieces(ids, scores, byte_ids, unknown, unigram, usable)


def merged(word: str, scores: dict[str, float]) -> list[str]:
    """BPE by its definition: join the best-scored neighbours, leftmost first, until none is a piece."""
    parts = list(word)
    while len(parts) > 1:
        best = max(
            ((scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in scores),
            default=None,
        )
        if best is None:
            break
        i = -best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def marked_words(text: str) -> list[str]:
    """The text's marked words; together they are the marked text."""
    words = text.split(" ")
    if MARK in text or not all(words):
        return UNITS.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in words]


class Walker:
    """Encodes sorted words, keeping the states of the prefix shared with the word before."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.pairs: dict[str, dict[str, bool]] = {}
        self.pair_count = 0
        self.memo: dict[str, bytes] = {}
        self.coded: dict[str, bytes] = {}
        self.worst = min(pieces.scores.values(), default=0.0) - 10.0
        # Pieces of two characters and more from their last character to their first; "" holds a piece.
        self.backward: dict = {}
        for piece in pieces.usable:
            node = self.backward
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = piece

    def _may_follow(self, left: str, right: str) -> bool:
        if self.pair_count >= MEMO_PAIRS:
            self.pairs, self.pair_count = {}, 0
        found = merged(left + right, self.pieces.scores) == [left, right]
        self.pairs.setdefault(right, {})[left] = found
        self.pair_count += 1
        return found

    def _merge_state(self, word: str, end: int, last: list[str]) -> str:
        node, start = self.backward, end
        while start and (node := node.get(word[start - 1])):
            start -= 1
            piece = node.get("")
            if piece is not None:
                if not start:
                    return piece
                fits = self.pairs.get(piece, NONE).get(last[start])
                if self._may_follow(last[start], piece) if fits is None else fits:
                    return piece
        return word[end - 1]

    def _viterbi_state(self, word: str, end: int, best: list[float]) -> tuple[str, float]:
        one, scores = word[end - 1], self.pieces.scores
        top = (one, best[end - 1] + scores.get(one, self.worst))
        node, start = self.backward, end
        while start and (node := node.get(word[start - 1])):
            start -= 1
            if "" in node and best[start] + scores[node[""]] > top[1]:
                top = (node[""], best[start] + scores[node[""]])
        return top

    def _ids(self, piece: str) -> list[int]:
        if piece in self.pieces.ids:
            return [self.pieces.ids[piece]]
        if self.pieces.byte_ids:
            return [self.pieces.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.pieces.unknown]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of every distinct word, as the bytes of an int32 array; `words` must be sorted."""
        last, best, before, found, coded = [""], [0.0], "", {}, self.coded
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                if self.pieces.unigram:
                    piece, score = self._viterbi_state(word, end, best)
                    best.append(score)
                else:
                    piece = self._merge_state(word, end, last)
                last.append(piece)
            path, end = [], len(word)
            while end:
                piece = last[end]
                if piece not in coded:
                    coded[piece] = np.array(self._ids(piece), dtype=np.int32).tobytes()
                path.append(coded[piece])
                end -= len(piece)
            found[word] = b"".join(reversed(path))
            before = word
        return found

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts. Words are made distinct over parts of about `PART_CHARS` characters."""
        out: list[np.ndarray] = []
        part: list[list[str]] = []
        size = 0
        for text in texts:
            part.append(marked_words(text) if text else [])
            size += len(text or "")
            if size >= PART_CHARS:
                out.extend(self._encode_part(part))
                part, size = [], 0
        return out + self._encode_part(part)

    def _encode_part(self, part: list[list[str]]) -> list[np.ndarray]:
        distinct = set().union(*part)
        fresh_words = [w for w in distinct if w not in self.memo]
        if len(self.memo) + len(fresh_words) > MEMO_WORDS:
            self.memo, fresh_words = {}, list(distinct)
        known = self.memo
        known.update(self.encode_words(sorted(fresh_words)))
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=np.int32) for words in part]


def decoding_table(pieces: Pieces) -> dict[int, bytes]:
    """The bytes that each id stands for; the unknown piece has a sign of its own."""
    table = {i: piece.replace(MARK, " ").encode("utf-8", "surrogatepass") for piece, i in pieces.ids.items()}
    table |= {i: bytes([b]) for b, i in pieces.byte_ids.items()}
    table[pieces.unknown] = " ⁇ ".encode()
    return table


def decode_ids(ids: list[int], table: dict[int, bytes]) -> str:
    """The text of one sequence of ids."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def byte_strings(table: dict[int, bytes]) -> pa.Array:
    """The bytes of every id, in the order of ids; ids that stand for nothing have none."""
    return pa.array([table.get(i, b"") for i in range(max(table, default=-1) + 1)], pa.large_binary())


def decode_lists(lists: pa.ListArray, strings: pa.Array) -> list[str | None]:
    """The text of each sequence of ids. The strings of all ids lie side by side, and a text is cut out of them."""
    found: list[str | None] = []
    for start in range(0, len(lists), DECODE_ROWS):
        part = lists.slice(start, DECODE_ROWS)
        joined = strings.take(part.flatten())
        places = np.frombuffer(joined.buffers()[1], dtype=np.int64)[: len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2] or b"")
        sizes = [0 if n is None else n for n in part.value_lengths().to_pylist()]
        ends = places[np.cumsum([0, *sizes])].tolist()
        texts = (bytes(data[a:b]).decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends, ends[1:], strict=False))
        found.extend(t if known else None for t, known in zip(texts, part.is_valid().to_pylist(), strict=True))
    return found


def row_parts(batch: pa.RecordBatch, sizes: pa.Array, bound: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, in parts of at most `bound` by their sizes, or of one row."""
    ends, start = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + bound, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, pieces: Pieces, columns: list[str], text_column: str = "text", name: str = "ids") -> DataFrame:
    """`columns` and the ids of every row's whole text, as an array of ints."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(pieces))
    text = fresh("_text", columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = Walker(Pieces(**shared.value))
        for whole in batches:
            for batch in row_parts(whole, pc.binary_length(whole.column(len(columns))), PART_CHARS):
                found = walker.encode_texts(batch.column(len(columns)).to_pylist())
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], ids], names=[*columns, name])

    picked = docs.select(*columns, F.col(text_column).alias(text))
    return in_small_batches(picked).mapInArrow(run, with_field(docs.select(*columns).schema, name, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, pieces: Pieces, ids_column: str = "ids", name: str = "decoded") -> DataFrame:
    """`encoded` with the text of its ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(pieces))
    columns = encoded.columns
    at = columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = byte_strings(decoding_table(Pieces(**shared.value)))
        for whole in batches:
            for batch in row_parts(whole, pc.list_value_length(whole.column(at)), PART_CHARS):
                texts = decode_lists(batch.column(at), strings)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*columns, name])

    return in_small_batches(encoded).mapInArrow(run, with_field(encoded.schema, name, T.StringType()))
