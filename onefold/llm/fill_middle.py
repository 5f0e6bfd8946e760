"""Fill-in-the-middle by piece tables.

A document is not copied while it is rearranged. It becomes a row of descriptors `(buffer, start, stop)` over
immutable buffers: its own text in UTF-8, and one short buffer that holds the three sentinels. Cutting splits a
descriptor in two, an arrangement permutes descriptors and puts sentinel descriptors between them, digests are
fed by the slices that the descriptors name, one after the other, and a text is only joined where it is asked for.

`transformed` cuts a text into n lines (runs up to and with a line feed, the last one perhaps without) and places
two cuts between lines by a digest of the row's id. Reading an output back, `restored` finds the sentinels of its
form from left to right, drops their descriptors and applies the inverse permutation. A text that holds a sentinel
is left plain, so the first sentinel found is always the one that was put there: a sentinel begins with `<`, which
no sentinel has again, so none can arise where a piece and a sentinel meet.

Null texts count as empty. Empty texts and those with a sentinel are plain, with null lengths. A null id counts as
the empty text in the digest; rows of one id and text are cut alike, each is kept. Very long texts are held once
as bytes per row and never split up into lines; empty tables give empty results. Passed columns keep their names;
an output column whose name is taken gets underscores in front.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onefold.llm.shared import fresh, in_small_batches, output_names

# The sentinels of prefix, suffix and middle.
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
# The order in which each form puts its parts.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PARTS = ("prefix", "middle", "suffix")  # as they stand in the text
SEED, PLAIN_PERCENT, SPM_PERCENT = 7, 0, 50
TEXT, MARKS = 0, 1  # buffers
MARK_BUFFER = b"".join(SENTINELS.values())
MARK_AT = {name: MARK_BUFFER.index(mark) for name, mark in SENTINELS.items()}
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256")


@dataclass(frozen=True)
class Descriptor:
    buffer: int
    start: int
    stop: int

    def split(self, at: int) -> tuple[Descriptor, Descriptor]:
        """The part before offset `at` of the buffer, and the part from there on."""
        return Descriptor(self.buffer, self.start, at), Descriptor(self.buffer, at, self.stop)


def mark(name: str) -> Descriptor:
    return Descriptor(MARKS, MARK_AT[name], MARK_AT[name] + len(SENTINELS[name]))


class PieceTable:
    """Descriptors over one text and the sentinels."""

    def __init__(self, text: bytes, pieces: Iterable[Descriptor] | None = None):
        self.buffers = (memoryview(text), memoryview(MARK_BUFFER))
        self.pieces = [Descriptor(TEXT, 0, len(text))] if pieces is None else list(pieces)

    def cut(self, offsets: Iterable[int]) -> PieceTable:
        """The same text with cuts at ascending offsets; a table of one descriptor becomes one of several."""
        pieces = list(self.pieces)
        for at in offsets:
            pieces[-1:] = pieces[-1].split(at)
        return PieceTable(self.buffers[TEXT].obj, pieces)

    def arranged(self, form: str) -> PieceTable:
        """The three pieces in the order of `form`, each after its sentinel."""
        own = dict(zip(PARTS, self.pieces, strict=True))
        return PieceTable(self.buffers[TEXT].obj, [d for name in FORMS[form] for d in (mark(name), own[name])])

    def slices(self) -> Iterator[memoryview]:
        for d in self.pieces:
            yield self.buffers[d.buffer][d.start : d.stop]

    def digest(self) -> str:
        total = hashlib.sha256()
        for part in self.slices():
            total.update(part)
        return total.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.slices())


def line_count(text: bytes) -> int:
    return text.count(b"\n") + (not text.endswith(b"\n") if text else 0)


def line_offsets(text: bytes, first: int, second: int) -> tuple[int, int]:
    """Where line number `first` and line number `second` begin; `first` is not the larger."""
    at, seen, found = 0, 0, []
    for wanted in (first, second):
        while seen < wanted and at < len(text):
            stop = text.find(b"\n", at)
            at, seen = (len(text) if stop < 0 else stop + 1), seen + 1
        found.append(at)
    return found[0], found[1]


def draws(key: str, seed: int = SEED) -> list[int]:
    """Four pseudorandom unsigned 32-bit numbers of a row."""
    found = hashlib.sha256(f"{seed}:{key}".encode("utf-8", "surrogatepass")).digest()
    return [int.from_bytes(found[i : i + 4], "big") for i in (0, 4, 8, 12)]


def rearranged(text: bytes, key: str, seed: int, plain_percent: int, spm_percent: int) -> tuple[int, str, PieceTable, PieceTable]:
    """Number of lines, form, the cut text and its arrangement."""
    n, whole = line_count(text), PieceTable(text)
    a, b, how, which = draws(key, seed)
    if not text or how % 100 >= 100 - plain_percent or any(m in text for m in SENTINELS.values()):
        return n, "plain", whole, whole
    a, b = sorted((a % (n + 1), b % (n + 1)))
    parts = whole.cut(line_offsets(text, a, b))
    form = "spm" if which % 100 < spm_percent else "psm"
    return n, form, parts, parts.arranged(form)


def restored_table(output: bytes, form: str) -> PieceTable:
    """The original text, as descriptors over the output."""
    whole = PieceTable(output)
    if form == "plain":
        return whole
    own, rest = {}, whole.pieces[0]
    names = FORMS[form]
    for name, following in zip(names, (*names[1:], None), strict=True):
        rest = rest.split(rest.start + len(SENTINELS[name]))[1]
        if following is None:
            own[name] = rest
        else:
            own[name], rest = rest.split(output.index(SENTINELS[following], rest.start))
    return PieceTable(output, [own[name] for name in PARTS])


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def transformed(
    docs: DataFrame,
    columns: list[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = SEED,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """`columns` of every row with `n, form, prefix_chars, middle_chars, output, output_sha256`.

    `plain_percent` of the rows stay plain; of the others `spm_percent` put the suffix first.
    """
    key, text = fresh("_key", columns), fresh("_text", columns)
    picked = docs.select(*columns, F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias(key), F.col(text_column).alias(text))
    schema = docs.select(*columns).schema
    for name, kind in zip(output_names(COLUMNS, columns), ("long", "string", "long", "long", "string", "string"), strict=True):
        schema = schema.add(name, kind)
    names, width = schema.names, len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for text, key in zip(_utf8(batch.column(width + 1)), batch.column(width).to_pylist(), strict=True):
                n, form, parts, table = rearranged(text, key, seed, plain_percent, spm_percent)
                sizes = (None, None)
                if form != "plain":
                    sizes = tuple(len(str(x, "utf-8")) for x in list(parts.slices())[:2])
                made.append((n, form, *sizes, table.joined(), table.digest()))
            out = list(zip(*made, strict=True)) if made else [()] * len(COLUMNS)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())]
            arrays += [pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary()).cast(pa.string()), pa.array(out[5], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *arrays], names=names)

    return in_small_batches(picked).mapInArrow(run, schema)


def restored(outputs: DataFrame, columns: list[str], output_column: str = "output", form_column: str = "form") -> DataFrame:
    """`columns` of every row with `restored`, the text before the transformation, and `restored_sha256`.

    Only the output and its form are read. A null output counts as an empty plain one.
    """
    output, form = fresh("_output", columns), fresh("_form", columns)
    picked = outputs.select(*columns, F.col(output_column).alias(output), F.coalesce(form_column, F.lit("plain")).alias(form))
    schema = outputs.select(*columns).schema
    for name in output_names(("restored", "restored_sha256"), columns):
        schema = schema.add(name, "string")
    names, width = schema.names, len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, digests = [], []
            for data, kind in zip(_utf8(batch.column(width)), batch.column(width + 1).to_pylist(), strict=True):
                table = restored_table(data, kind)
                texts.append(table.joined())
                digests.append(table.digest())
            arrays = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *arrays], names=names)

    return in_small_batches(picked).mapInArrow(run, schema)
