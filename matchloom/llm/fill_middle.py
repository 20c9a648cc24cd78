"""Fill-in-middle transformation on seekable compressed texts.

A text is stored as independent zstandard frames of about ``FRAME`` bytes with the number of units (code
points) before each. A place in the text is found by those counts, so only the frames that a cut falls
into are decompressed; all others move into the result as they are. The result is again a list of frames,
and digests are taken from frames as they stream by, so no second copy of a text is put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import BATCH_BYTES, byte_slices

FRAME = 1 << 16
LEVEL = 1
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}  # before the prefix, the suffix and the middle
ORDER = {"psm": "PSM", "spm": "SPM"}
PLAIN = "plain"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
FRAMES_SCHEMA = "frames array<binary>, starts array<bigint>, marked boolean"
RESULT_SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint"


def _unit_starts(data: bytes) -> np.ndarray:
    """Where each code point of UTF-8 bytes begins."""
    return np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)


def to_frames(data: bytes, compress, size: int = FRAME) -> tuple[list[bytes], list[int]]:
    """Frames of whole code points, and the units before each, with the total at the end. No bytes, no frame."""
    frames, starts, at, units = [], [0], 0, 0
    while at < len(data):
        end = min(at + size, len(data))
        while at < end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if end == at:  # a frame holds one code point at least
            end = next((i for i in range(at + 1, len(data)) if data[i] & 0xC0 != 0x80), len(data))
        part = data[at:end]
        units += int((np.frombuffer(part, np.uint8) & 0xC0 != 0x80).sum())
        frames.append(compress(part))
        starts.append(units)
        at = end
    return frames, starts


def select_units(frames: list[bytes], starts: list[int], first: int, last: int, compress, decompress) -> list[bytes]:
    """Frames of the units from ``first`` up to ``last``; whole frames are taken as they are."""
    result = []
    begin = int(np.searchsorted(starts, first, "right")) - 1
    for i in range(begin, len(frames)):
        if starts[i] >= last:
            break
        a, b = max(first, starts[i]) - starts[i], min(last, starts[i + 1]) - starts[i]
        if (a, b) == (0, starts[i + 1] - starts[i]):
            result.append(frames[i])
        elif a < b:
            data = decompress(frames[i])
            places = np.append(_unit_starts(data), len(data))
            result.append(compress(data[places[a] : places[b]]))
    return result


def choose(doc_id, n: int, marked: bool) -> tuple[str, int, int]:
    """Form and both cuts of a document, from the digest of its id; a null id is spelled as nothing."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = PLAIN if n == 0 or marked or h3 % 100 >= PLAIN_FROM else "spm" if h4 % 100 < SPM_BELOW else "psm"
    return form, *cuts


class Codec:
    """Compressor and decompressor of a task; they are reused from frame to frame."""

    def __init__(self):
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self.decompress = zstandard.ZstdDecompressor().decompress
        self.marks = {part: self.compress(mark) for part, mark in MARKS.items()}

    def rearrange(self, frames: list[bytes], starts: list[int], form: str, low: int, high: int) -> list[bytes]:
        """Frames of the result: the text as it is, or its three parts behind their marks in the form's order."""
        if form == PLAIN:
            return frames
        edges = {"P": (0, low), "M": (low, high), "S": (high, starts[-1])}
        result = []
        for part in ORDER[form]:
            result.append(self.marks[part])
            result += select_units(frames, starts, *edges[part], self.compress, self.decompress)
        return result

    def digests(self, frames: list[bytes], form: str) -> tuple[str, str]:
        """SHA-256 of what the frames hold, and of the text restored from them; one frame is held at a time."""
        output, back = hashlib.sha256(), hashlib.sha256()
        for frame in frames:
            output.update(self.decompress(frame))
        if form == PLAIN:
            return output.hexdigest(), output.hexdigest()
        for piece in self.restored(frames, form):
            back.update(piece)
        return output.hexdigest(), back.hexdigest()

    def restored(self, frames: list[bytes], form: str) -> Iterator[bytes]:
        """The text again, piece by piece, from the frames of a result and its form alone.

        Texts that hold a mark are plain, so each mark is found once; one may lie across frames.
        """
        if form == PLAIN:
            yield from map(self.decompress, frames)
            return
        marks = [MARKS[p] for p in ORDER[form]]
        found, offsets, at, tail = {}, [0], 0, b""
        for frame in frames:
            data = self.decompress(frame)
            window = tail + data
            for mark in marks:
                if mark not in found and (place := window.find(mark)) >= 0:
                    found[mark] = at - len(tail) + place
            at += len(data)
            offsets.append(at)
            tail = window[-2:]
        begins = [found[m] for m in marks]
        parts = {p: (b + len(MARKS[p]), e) for p, b, e in zip(ORDER[form], begins, [*begins[1:], at])}
        for part in "PMS":
            first, last = parts[part]
            for i in range(int(np.searchsorted(offsets, first, "right")) - 1, len(frames)):
                if offsets[i] >= last:
                    break
                if offsets[i + 1] > first:
                    yield self.decompress(frames[i])[max(0, first - offsets[i]) : last - offsets[i]]


def _columns(docs: DataFrame, names: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)


def text_frames(docs: DataFrame, frame_bytes: int = FRAME, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``frames``, ``starts`` (units before each frame, and in all) and ``marked`` (a mark is in the text).

    A null or empty text has no frames. Nothing is shuffled; other columns do not come along, repeated rows do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = Codec().compress
        for batch in batches:
            column = batch.column("text")
            for start, stop in byte_slices(column):
                texts = column.slice(start, stop - start).cast(pa.binary()).to_pylist()
                made = [to_frames(t or b"", compress, frame_bytes) for t in texts]
                marked = [any(m in t for m in MARKS.values()) if t else False for t in texts]
                columns = [batch.column(c).slice(start, stop - start) for c in keep]
                columns.append(pa.array([f for f, _ in made], pa.list_(pa.binary())))
                columns.append(pa.array([s for _, s in made], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(marked)], [*keep, "frames", "starts", "marked"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], "text")
    return rows.mapInArrow(run, f"{_columns(docs, keep)}, {FRAMES_SCHEMA}")


def fill_in_middle(framed: DataFrame, keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """Results of the transformation for texts as ``text_frames`` gives them; ``frames`` hold the new text.

    ``n`` units are cut in three by the digest of ``doc_id``; the lengths of prefix and middle are null for
    plain texts, which are the empty ones, those with a mark in them and a tenth of the others. Rows that share
    a ``doc_id`` share the draw, not the cuts. With ``digests``, ``output_sha256`` and ``restored_sha256`` (of the
    new text, and of the old one rebuilt from it) take the place of the frames.
    """
    given = ["n", "form", "prefix_chars", "middle_chars", *(["output_sha256", "restored_sha256"] if digests else ["frames"])]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *([pa.string()] * 2 if digests else [pa.list_(pa.binary())])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec()
        for batch in batches:
            rows: list[tuple] = []
            first = held = 0

            def emit(last: int) -> pa.RecordBatch:
                columns = [batch.column(c).slice(first, last - first) for c in keep]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                return pa.RecordBatch.from_arrays(columns, [*keep, *given])

            for row in range(batch.num_rows):
                frames, starts, marked, name = (batch.column(c)[row].as_py() for c in ("frames", "starts", "marked", "doc_id"))
                form, low, high = choose(name, starts[-1], marked)
                made = codec.rearrange(frames, starts, form, low, high)
                last = codec.digests(made, form) if digests else (made,)
                rows.append((starts[-1], form, *((None, None) if form == PLAIN else (low, high - low)), *last))
                held += 256 if digests else sum(map(len, made))
                if held > BATCH_BYTES:
                    yield emit(row + 1)
                    rows, first, held = [], row + 1, 0
            if rows:
                yield emit(batch.num_rows)

    last = "output_sha256 string, restored_sha256 string" if digests else "frames array<binary>"
    return framed.mapInArrow(run, f"{_columns(framed, keep)}, {RESULT_SCHEMA}, {last}")


def texts(framed: DataFrame, into: str = "text") -> DataFrame:
    """Frames back to strings."""
    rest = [c for c in framed.columns if c not in ("frames", "starts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            whole = [b"".join(map(decompress, frames.as_py())).decode() for frames in batch.column("frames")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(whole, pa.string())], [*rest, into])

    return framed.mapInArrow(run, f"{_columns(framed, tuple(rest))}, {into} string")
