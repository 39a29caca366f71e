"""Fill-in-middle transformation (13): prefix, suffix and middle of a text from seekable compressed frames.

A text is stored as zstandard frames that are compressed apart from each other,
each with the number of units (a run of letters, or any other code point) that
begin before it. A cut at a unit is found by searching these numbers and
decompressing one frame. Outputs and digests stream the frames in order, so no
step behind the store holds a whole text.

A row is worked on by itself; there is no shuffle. The store is a written table
that further draws of cuts, orders or checks can read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from smogline.llm.common import texts
from smogline.session import stage

#: Code points per frame.
FRAME = 1 << 15
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

STORE = "doc_id long, n long, n_chars long, has_marker boolean, units array<long>, joined array<boolean>, data array<binary>"


@lru_cache(1)
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


@lru_cache(1)
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _begins(text: str, joined: bool) -> np.ndarray:
    """Flags of the code points that begin a unit; ``joined`` if the text follows a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (points | np.uint32(32)) - np.uint32(97) < 26  # wraps around below "a"
    before = np.concatenate([[joined], letter[:-1]])
    return ~(letter & before)


@dataclass
class Frames:
    """A text as compressed frames of ``size`` code points (the last may be shorter).

    units: units that begin before each frame. joined: whether a frame follows a
    letter, so that letters at its start belong to a unit before it.
    """

    size: int = FRAME
    units: list[int] = field(default_factory=list)
    joined: list[bool] = field(default_factory=list)
    data: list[bytes] = field(default_factory=list)
    n: int = 0
    n_chars: int = 0
    ends_in_letter: bool = False

    @classmethod
    def of(cls, pieces: Iterable[str], size: int = FRAME) -> Frames:
        """Frames of a text that comes in pieces of any lengths."""
        frames, rest, held = cls(size), [], 0
        for piece in pieces:
            rest.append(piece)
            held += len(piece)
            if held >= size:
                whole = "".join(rest)
                behind = held - held % size
                for at in range(0, behind, size):
                    frames._add(whole[at : at + size])
                rest, held = [whole[behind:]], held - behind
        if held:
            frames._add("".join(rest))
        return frames

    def _add(self, text: str) -> None:
        self.units.append(self.n)
        self.joined.append(self.ends_in_letter)
        self.data.append(_compressor().compress(text.encode("utf-8", "surrogatepass")))
        self.n += int(np.count_nonzero(_begins(text, self.ends_in_letter)))
        self.n_chars += len(text)
        self.ends_in_letter = text[-1].isascii() and text[-1].isalpha()

    def frame(self, k: int) -> str:
        return _decompressor().decompress(self.data[k]).decode("utf-8", "surrogatepass")

    def place(self, unit: int) -> int:
        """Code point at which a unit begins, from its one frame; the length for the number of units."""
        if unit >= self.n:
            return self.n_chars
        k = bisect_right(self.units, unit) - 1
        begins = np.flatnonzero(_begins(self.frame(k), self.joined[k]))
        return k * self.size + int(begins[unit - self.units[k]])

    def read(self, first: int = 0, behind: int | None = None) -> Iterator[str]:
        """The code points of a range, frame by frame."""
        behind = self.n_chars if behind is None else behind
        for k in range(first // self.size, -(-behind // self.size)):
            at = k * self.size
            piece = self.frame(k)[max(0, first - at) : behind - at]
            if piece:
                yield piece

    def find(self, marker: str, first: int = 0) -> int:
        """First code point of a marker from a place on, or -1; frames may part it."""
        tail, at = "", first
        for piece in self.read(first):
            found = (tail + piece).find(marker)
            if found >= 0:
                return at - len(tail) + found
            at += len(piece)
            tail = (tail + piece)[1 - len(marker) :]
        return -1


def draw(doc_id: int | None, n: int, keep_plain: bool) -> tuple[str, int, int]:
    """Form and the units of both cuts; a row without id draws from an empty number."""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    if keep_plain or h3 % 100 >= 90:
        return "plain", *cuts
    return "spm" if h4 % 100 < 20 else "psm", *cuts


def arranged(frames: Frames, form: str, a: int, b: int) -> Iterator[str]:
    """The output in pieces; a, b: code points at which middle and suffix begin."""
    if form == "plain":
        yield from frames.read()
        return
    prefix, middle, suffix = (0, a), (a, b), (b, frames.n_chars)
    order = {
        "psm": ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)),
        "spm": ((SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)),
    }[form]
    for marker, part in order:
        yield marker
        yield from frames.read(*part)


def restored(output: Frames, form: str) -> Iterator[str]:
    """The text in pieces, from nothing but an output and its form.

    Texts with markers are plain, and a marker has its first character nowhere
    else, so the first place of each marker is the one that was put there.
    """
    if form == "plain":
        yield from output.read()
        return
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    x = output.find(second, len(first))
    y = output.find(MIDDLE, x + len(second))
    parts = {first: (len(first), x), second: (x + len(second), y), MIDDLE: (y + len(MIDDLE), output.n_chars)}
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from output.read(*parts[marker])


def _sha(pieces: Iterable[str]) -> str:
    found = hashlib.sha256()
    for piece in pieces:
        found.update(piece.encode("utf-8", "surrogatepass"))
    return found.hexdigest()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_STORE = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("n_chars", pa.int64()), ("has_marker", pa.bool_()),
        ("units", pa.list_(pa.int64())), ("joined", pa.list_(pa.bool_())), ("data", pa.list_(pa.binary())),
    ]
)


def frame_store(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """Frames of every text with their cumulative counts, a row per document.

    A missing or empty text has no frame and no unit; repeated rows are stored
    each; other columns are not read; an empty table gives an empty table.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows = []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1)):
                    text = text.as_py()
                    f = Frames.of([text], size)
                    rows.append((doc_id, f.n, f.n_chars, any(m in text for m in MARKERS), f.units, f.joined, f.data))
                yield _batch(rows, _STORE)

    return texts(docs).mapInArrow(store, STORE)


def _stored(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int | None, str, int, int, Frames]]:
    """(id, form, code points of both cuts, frames) of each row of the store."""
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k].as_py() for name in _STORE.names}
        frames = Frames(size, row["units"], row["joined"], row["data"], row["n"], row["n_chars"])
        form, low, high = draw(row["doc_id"], frames.n, not frames.n_chars or row["has_marker"])
        yield row["doc_id"], form, *((0, 0) if form == "plain" else (frames.place(low), frames.place(high))), frames


def fill_in_middle(store: DataFrame, size: int = FRAME) -> DataFrame:
    """``doc_id``, ``form``, ``output`` of every stored text.

    ``size`` is that of the store. Empty texts and texts with markers are plain.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())])

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = _stored(batch.slice(at, 256), size)
                yield _batch([(i, form, "".join(arranged(f, form, a, b))) for i, form, a, b, f in found], schema)

    return store.mapInArrow(arrange, "doc_id long, form string, output string")


def restore_texts(outputs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` again from ``doc_id``, ``form``, ``output``; a missing output is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "form", "output")))
            yield _batch([(i, "".join(restored(Frames.of([out or ""]), form))) for i, form, out in rows], schema)

    return outputs.select("doc_id", "form", "output").mapInArrow(restore, "doc_id long, text string")


_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
    ]
)


def fim_digest(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """Form, lengths and checksums of every document's output, and of the text restored from it.

    A missing or empty text is plain with no units; a row without id draws from
    an empty number; repeated rows appear each; an empty table gives none.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, form, a, b, frames in _stored(batch.slice(at, 256), size):
                    output = Frames.of(arranged(frames, form, a, b), size)
                    lengths = (None, None) if form == "plain" else (a, b - a)
                    rows.append((doc_id, frames.n, form, *lengths, _sha(output.read()), _sha(restored(output, form))))
                yield _batch(rows, _DIGEST)

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return stage(frame_store(docs, size), "frames").mapInArrow(digest, schema)
