"""Fill-in-the-middle transformation over seekable compressed texts.

1. ``store`` writes every text as a row of independent zstandard frames of about
   ``FRAME_BYTES``, cut between units, each with the number of units and code
   points up to its end.  A unit is a word with the white space before it, or
   the white space that ends a text.
2. ``transformed`` picks two cuts per document from a hash of its id.  Only the
   frames that hold a cut are split into units; the counts say where they are.
   The output is streamed, frame after frame, into frames of its own.
3. ``plain_texts`` turns frames into text, ``restored`` puts the original back
   together from an output and its form, seeking for its three parts, and
   ``fim_report`` streams both into digests.

A task holds one text as it comes, its compressed frames, and one open frame.
Nothing is shuffled; each row depends on itself alone, so copies and hot sources
do not matter.  A very long text is one row, hence one task's work.

Null and empty texts have no units and are plain with an empty output.  A null
id counts as an empty one.  Repeated rows come out each, alike.  The input's
columns stay in the struct ``doc``, so no name can clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.tables import SLICE_BYTES, column, map_arrow, map_texts, staged

SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80
FRAME_BYTES = 64 << 10
PLAIN, PSM, SPM = "plain", "psm", "spm"
# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_FRAMES = ArrayType(
    StructType(
        [
            StructField("data", BinaryType()),
            StructField("units", LongType()),
            StructField("chars", LongType()),
        ]
    )
)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(data: bytes) -> np.ndarray:
    """The byte after each unit of a text."""
    if not data:
        return np.zeros(0, np.int64)
    space = _SPACE[np.frombuffer(data, np.uint8)]
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(data))


def _chars(data: bytes) -> int:
    """Code points: bytes that do not continue one."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


@dataclass
class Frames:
    """Compressed pieces with the units and code points up to the end of each."""

    data: list[bytes]
    units: list[int]
    chars: list[int]

    @classmethod
    def empty(cls) -> Frames:
        return cls([], [], [])

    @classmethod
    def of_rows(cls, rows: Sequence[dict]) -> Frames:
        return cls(*([r[k] for r in rows] for k in ("data", "units", "chars")))

    def rows(self) -> list[tuple]:
        return list(zip(self.data, self.units, self.chars, strict=True))

    def stored(self) -> int:
        return sum(map(len, self.data))

    def add(self, packer, piece: bytes, units: int) -> None:
        self.units.append(units + (self.units[-1] if self.units else 0))
        self.chars.append(_chars(piece) + (self.chars[-1] if self.chars else 0))
        self.data.append(packer.compress(piece))

    def frame_of(self, unit: int) -> int:
        """The frame that holds the end of the unit (counted from 1)."""
        return bisect_left(self.units, unit)


def framed(packer, text: bytes) -> Frames:
    """A text cut between units into frames."""
    frames, ends = Frames.empty(), unit_ends(text)
    if len(ends):
        last = np.append(np.flatnonzero(np.diff((ends - 1) // FRAME_BYTES)), len(ends) - 1)
        begin, before = 0, 0
        for at in last.tolist():
            frames.add(packer, text[begin : ends[at]], at + 1 - before)
            begin, before = int(ends[at]), at + 1
    return frames


class _Writer:
    """Streams bytes into frames whose units are bytes."""

    def __init__(self, packer):
        self.packer, self.frames, self.open, self.size = packer, Frames.empty(), [], 0

    def write(self, piece: bytes) -> None:
        self.open.append(piece)
        self.size += len(piece)
        if self.size >= FRAME_BYTES:
            self.close()

    def close(self) -> Frames:
        if self.size:
            self.frames.add(self.packer, b"".join(self.open), self.size)
            self.open, self.size = [], 0
        return self.frames


@dataclass
class _Cut:
    """A place between two units: a frame and a byte in it, and the code points before."""

    frame: int
    byte: int
    chars: int


def _cut(unpacker, frames: Frames, units: int) -> _Cut:
    """The end of so many units; decompresses the one frame that holds it."""
    if units == 0:
        return _Cut(0, 0, 0)
    at = frames.frame_of(units)
    if frames.units[at] == units:
        return _Cut(at + 1, 0, frames.chars[at])
    before = (frames.units[at - 1], frames.chars[at - 1]) if at else (0, 0)
    piece = unpacker.decompress(frames.data[at])
    byte = int(unit_ends(piece)[units - before[0] - 1])
    return _Cut(at, byte, before[1] + _chars(piece[:byte]))


def _between(unpacker, frames: Frames, begin: _Cut, end: _Cut) -> Iterator[bytes]:
    """The bytes between two cuts, a frame at a time."""
    for at in range(begin.frame, end.frame + (end.byte > 0)):
        piece = unpacker.decompress(frames.data[at])
        yield piece[begin.byte if at == begin.frame else 0 : end.byte if at == end.frame else None]


def _choice(key: str, n: int, seed: int) -> tuple[int, int, int, int]:
    """First cut, second cut, and the two percentages of a document with n units."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    return (*sorted((h1 % (n + 1), h2 % (n + 1))), h3 % 100, h4 % 100)


def _transform(packer, unpacker, frames: Frames, key: str, marked: bool, options) -> tuple:
    """Form, code points of prefix and middle, and the output's frames."""
    seed, fim_percent, spm_percent = options
    n = frames.units[-1] if frames.units else 0
    first, second, fim, spm = _choice(key, n, seed)
    begin, end = _Cut(0, 0, 0), _Cut(len(frames.data), 0, frames.chars[-1] if n else 0)
    out = _Writer(packer)
    if not n or marked or fim >= fim_percent:
        for piece in _between(unpacker, frames, begin, end):
            out.write(piece)
        return PLAIN, None, None, out.close()
    a, b = _cut(unpacker, frames, first), _cut(unpacker, frames, second)
    parts = {PREFIX: (begin, a), SUFFIX: (b, end), MIDDLE: (a, b)}
    form = SPM if spm < spm_percent else PSM
    for mark in (SUFFIX, PREFIX, MIDDLE) if form == SPM else (PREFIX, SUFFIX, MIDDLE):
        out.write(mark)
        for piece in _between(unpacker, frames, *parts[mark]):
            out.write(piece)
    return form, a.chars, b.chars - a.chars, out.close()


def _bytes(unpacker, frames: Frames, begin: int, end: int) -> Iterator[bytes]:
    """A range of an output's bytes; decompresses the frames that overlap it."""
    at = frames.frame_of(begin + 1)
    while begin < end:
        before = frames.units[at - 1] if at else 0
        piece = unpacker.decompress(frames.data[at])[begin - before : end - before]
        yield piece
        begin, at = begin + len(piece), at + 1


def _find(unpacker, frames: Frames, marks: Sequence[bytes]) -> list[int]:
    """Where the marks first stand, each after the one before; found frame by frame."""
    found, tail, offset = [], b"", 0
    for data in frames.data:
        piece = tail + unpacker.decompress(data)
        begin = 0
        while len(found) < len(marks):
            at = piece.find(marks[len(found)], begin)
            if at < 0:
                break
            found.append(offset + at)
            begin = at + len(PREFIX)
        # A mark may lie across the border; one that is found is not looked at again.
        keep = max(begin, len(piece) - len(PREFIX) + 1)
        tail, offset = piece[keep:], offset + keep
    return found


def _restore(unpacker, frames: Frames, form: str) -> Iterator[bytes]:
    """The original's bytes from an output and its form alone."""
    total = frames.units[-1] if frames.units else 0
    if form == PLAIN:
        yield from _bytes(unpacker, frames, 0, total)
        return
    marks = (SUFFIX, PREFIX, MIDDLE) if form == SPM else (PREFIX, SUFFIX, MIDDLE)
    places = _find(unpacker, frames, marks)
    spans = {
        mark: (begin + len(mark), end)
        for mark, begin, end in zip(marks, places, [*places[1:], total], strict=True)
    }
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from _bytes(unpacker, frames, *spans[mark])


# -- as frames of rows -----------------------------------------------------


def store(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep=None) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``key``, ``n`` units, ``marked`` and ``frames``, written."""

    def make():
        packer = zstandard.ZstdCompressor()

        def work(texts):
            n, marked, rows, sizes = [], [], [], []
            for raw in texts:
                raw = raw or b""
                frames = framed(packer, raw)
                n.append(frames.units[-1] if frames.units else 0)
                marked.append(any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)))
                rows.append(frames.rows())
                sizes.append(frames.stored())
            return n, marked, rows, sizes

        return work

    fields = [
        StructField("n", LongType()),
        StructField("marked", BooleanType()),
        StructField("frames", _FRAMES),
        StructField("stored", LongType()),
    ]
    names = docs.columns if keep is None else list(keep)
    if doc_id not in names:
        raise ValueError(f"the kept columns hold the id {doc_id}")
    rows = map_texts(docs, text, fields, make, names)
    key = F.coalesce(F.col("doc").getField(doc_id).cast("string"), F.lit(""))
    return staged(rows.select("doc", key.alias("key"), "n", "marked", "frames", "stored"), "fim-store")


def transformed(
    stored: DataFrame,
    *,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``doc``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the output's ``frames``."""
    options = (seed, fim_percent, spm_percent)
    fields = [
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("frames", _FRAMES),
        StructField("stored", LongType()),
    ]

    def make():
        packer, unpacker = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()

        def work(frames, row):
            done = _transform(packer, unpacker, frames, row["key"], row["marked"], options)
            return row["n"], *done[:3], done[3].rows(), done[3].stored()

        return work

    return _map_frames(stored, ["key", "n", "marked"], fields, make)


def plain_texts(outputs: DataFrame, name: str = "output") -> DataFrame:
    """The frames of each row as one text column in their place."""
    others = [c for c in outputs.columns if c not in ("doc", "frames", "stored")]
    fields = [*(outputs.schema[c] for c in others), StructField(name, StringType())]

    def make():
        unpacker = zstandard.ZstdDecompressor()

        def work(frames, row):
            text = b"".join(unpacker.decompress(d) for d in frames.data).decode()
            return *(row[c] for c in others), text

        return work

    return _map_frames(outputs, others, fields, make)


def restored(outputs: DataFrame, name: str = "text") -> DataFrame:
    """``doc`` and the original text, rebuilt from the frames and form of each output."""

    def make():
        unpacker = zstandard.ZstdDecompressor()
        return lambda frames, row: (b"".join(_restore(unpacker, frames, row["form"])).decode(),)

    return _map_frames(outputs, ["form"], [StructField(name, StringType())], make)


def fill_middle(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and the text ``output``."""
    return plain_texts(transformed(store(docs, doc_id=doc_id, text=text), **options))


def fim_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Each document's form and cuts, with digests of its output and of the restored text."""
    outputs = transformed(store(docs, doc_id=doc_id, text=text, keep=[doc_id]), **options)
    kept = ["n", "form", "prefix_chars", "middle_chars"]
    digests = [StructField(c, StringType()) for c in ("output_sha256", "restored_sha256")]

    def make():
        unpacker = zstandard.ZstdDecompressor()

        def digest(pieces):
            total = hashlib.sha256()
            for piece in pieces:
                total.update(piece)
            return total.hexdigest()

        def work(frames, row):
            whole = frames.units[-1] if frames.units else 0
            return (
                *(row[c] for c in kept),
                digest(_bytes(unpacker, frames, 0, whole)),
                digest(_restore(unpacker, frames, row["form"])),
            )

        return work

    fields = [*(outputs.schema[c] for c in kept), *digests]
    done = _map_frames(outputs, kept, fields, make)
    return done.select(F.col("doc").getField(doc_id).alias("doc_id"), *kept, *(f.name for f in digests))


def _map_frames(frame: DataFrame, others: Sequence[str], fields: Sequence[StructField], make) -> DataFrame:
    """``doc`` and ``fields``, worked out from the ``frames`` and ``others`` of each row.

    Rows come out whenever about ``SLICE_BYTES`` of text or frames are together.
    """
    narrowed = frame.select("doc", "frames", *(column(c) for c in others))
    schema = StructType([narrowed.schema["doc"], *fields])
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        work = make()
        for batch in batches:
            begin, size, made = 0, 0, []
            for i in range(batch.num_rows):
                rows = batch.column(1)[i].as_py()
                row = {c: batch.column(2 + k)[i].as_py() for k, c in enumerate(others)}
                values = work(Frames.of_rows(rows), row)
                made.append(values)
                size += sum(len(r["data"]) for r in rows) + 256
                size += sum(len(v) for v in values if isinstance(v, str))
                if size >= SLICE_BYTES or i + 1 == batch.num_rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*made), types, strict=True)]
                    docs = batch.column(0).slice(begin, len(made))
                    yield pa.RecordBatch.from_arrays([docs, *columns], schema.names)
                    begin, size, made = i + 1, 0, []

    return map_arrow(narrowed, run, schema)
