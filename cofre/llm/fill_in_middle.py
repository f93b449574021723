"""Fill-in-the-middle over seekable compressed frames.

A text is stored as zstandard frames of at most :data:`FRAME_BYTES` bytes that are decompressed apart. Beside each frame
stands how many units and code points precede it and whether a unit begins at its first byte, so the place of any
unit is found by a binary search and by decompressing the one frame it lies in. The rearranged text is a list
of frames too: whole frames are taken over as they are, only the (at most two) cut ones are compressed anew. Digests and the
restored text come from streaming frames in order; nothing but a text's own row is ever held whole, and that compressed.

A unit is white space and the word after it; white space at the end is a unit of its own. White space is ASCII, so units
begin at the text's first byte and wherever white space follows something else, and may run over frames.

Two cuts, drawn from SHA-256 of seed and key, part the units into prefix, middle and suffix. The form says how
they are put together; a text that is empty or holds a marker stays plain. :func:`restore` finds the markers in the output
and rebuilds the text from output and form alone.

All steps are maps over rows without a shuffle; the frame table lies in the shared folder, so a lost executor costs its own tasks.

Defined results: a null text counts as empty. Any row of the table gives one row, also repeated ones, which come out
alike; a null key counts as an empty number. A text of any length is cut in frames, also one without white space,
which is one unit. An empty table gives no rows. Only key and text are read, so other columns, whatever their names, neither matter
nor clash. There are no ties: equal cuts give an empty middle.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch

#: Most bytes of text in a frame.
FRAME_BYTES = 65536
SEED = 42
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
#: The order of the parts in a form, each behind its marker.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

STORED = "n long, n_chars long, marked boolean, units_before array<long>, chars_before array<long>, begins array<boolean>, frames array<binary>"
MOVED = "n long, form string, prefix_chars long, middle_chars long, frames array<binary>"
DIGESTS = "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _compress(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def decompress(frame: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame)


def _chars(data: bytes) -> int:
    """Code points in UTF-8."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


def _white(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, np.uint8)
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def unit_starts(data: bytes, begins: bool) -> np.ndarray:
    """Where units begin in the bytes of a frame; ``begins``: one does at the first byte."""
    white = _white(data)
    inside = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    return np.concatenate([[0], inside]) if begins else inside


@dataclass
class Frames:
    """The frames of one text with what precedes each."""

    n: int
    n_chars: int
    units_before: Sequence[int]
    chars_before: Sequence[int]
    begins: Sequence[bool]
    frames: Sequence[bytes]

    @classmethod
    def of(cls, text: bytes, size: int) -> Frames:
        """Cut ``text`` (UTF-8) into frames of at most ``size`` bytes and whole code points."""
        units, chars, before, char_before, begins, frames = 0, 0, [], [], [], []
        start, after_white = 0, True
        while start < len(text):
            end = min(start + size, len(text))
            while end < len(text) and text[end] & 0xC0 == 0x80:
                end -= 1
            piece = text[start:end]
            first = start == 0 or (not after_white and bool(_white(piece[:1])[0]))
            before.append(units)
            char_before.append(chars)
            begins.append(first)
            frames.append(_compress(piece))
            units += len(unit_starts(piece, first))
            chars += _chars(piece)
            start, after_white = end, bool(_white(piece[-1:])[0])
        return cls(units, chars, before, char_before, begins, frames)

    def place(self, unit: int) -> tuple[int, int, int]:
        """Frame, byte in it and code points before the place where ``unit`` begins; the end for ``unit`` = n."""
        if unit >= self.n:
            return len(self.frames), 0, self.n_chars
        at = bisect_right(self.units_before, unit) - 1
        data = decompress(self.frames[at])
        byte = int(unit_starts(data, self.begins[at])[unit - self.units_before[at]])
        return at, byte, self.chars_before[at] + _chars(data[:byte])

    def between(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> Iterator[bytes]:
        """Frames of the text from one place to another; whole ones as they are."""
        (first, low, _), (last, high, _) = start, end
        for at in range(first, min(last + 1, len(self.frames))):
            begin, stop = low if at == first else 0, high if at == last else None
            if begin == 0 and stop is None:
                yield self.frames[at]
            elif stop is None or stop > begin:
                yield _compress(decompress(self.frames[at])[begin:stop])


def rearrange(stored: Frames, form: str, first: int, second: int) -> tuple[list[bytes], int | None, int | None]:
    """Frames of the output, and the code points of prefix and middle."""
    if form == "plain":
        return list(stored.frames), None, None
    start, end = (0, 0, 0), (len(stored.frames), 0, stored.n_chars)
    one, two = stored.place(first), stored.place(second)
    parts = {PREFIX: (start, one), MIDDLE: (one, two), SUFFIX: (two, end)}
    output = []
    for marker in ORDER[form]:
        output.append(_compress(marker))
        output.extend(stored.between(*parts[marker]))
    return output, one[2], two[2] - one[2]


def _find_markers(frames: Sequence[bytes], order: Sequence[bytes], digest) -> tuple[list[int], list[int]]:
    """Bytes before each frame (and after the last), and where the markers stand; feeds ``digest`` on the way."""
    starts, found, carry, wanted = [0], [], b"", list(order)
    for frame in frames:
        data = decompress(frame)
        digest.update(data)
        window, origin, seen = carry + data, starts[-1] - len(carry), 0
        while wanted and (at := window.find(wanted[0], seen)) >= 0:
            found.append(origin + at)
            seen = at + len(wanted.pop(0))
        starts.append(starts[-1] + len(data))
        carry = window[max(seen, len(window) - 2) :]
    if wanted:
        raise ValueError("The output lacks a marker of its form.")
    return starts, found


def _stream(frames: Sequence[bytes], starts: Sequence[int], low: int, high: int) -> Iterator[bytes]:
    """The bytes from ``low`` to ``high``, seeking the first frame."""
    at = max(bisect_right(starts, low) - 1, 0)
    while low < high:
        data = decompress(frames[at])
        yield data[low - starts[at] : high - starts[at]]
        at += 1
        low = starts[at]


def restore(frames: Sequence[bytes], form: str, digest=None) -> Iterator[bytes]:
    """The original text, piece by piece, from output and form; ``digest`` is fed the output."""
    digest = digest or hashlib.sha256()
    starts, found = _find_markers(frames, ORDER.get(form, ()), digest)
    if form == "plain":
        yield from _stream(frames, starts, 0, starts[-1])
        return
    ends = dict(zip(ORDER[form], [*found[1:], starts[-1]], strict=True))
    places = dict(zip(ORDER[form], found, strict=True))
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from _stream(frames, starts, places[marker] + len(marker), ends[marker])


def _schema(df: DataFrame, columns: str) -> str:
    return f"key {df.schema['key'].dataType.simpleString()}, {columns}"


def _rows_of(batch: pa.RecordBatch, rows: list[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    """``rows`` beside the keys of ``batch``."""
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays([batch["key"], *columns], names=["key", *names])


def store_frames(df: DataFrame, text: str = "text", key: str = "doc_id", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """A row per row of ``df``: key, its frames, and what precedes each."""
    names = ["n", "n_chars", "marked", "units_before", "chars_before", "begins", "frames"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch["text"]:
                data = (value.as_py() or "").encode()
                f = Frames.of(data, frame_bytes)
                marked = any(marker in data for marker in MARKERS)
                rows.append((f.n, f.n_chars, marked, f.units_before, f.chars_before, f.begins, f.frames))
            if rows:
                yield _rows_of(batch, rows, names, types)

    given = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return given.mapInArrow(run, _schema(given, STORED))


def _drawn(seed: int) -> list[Column]:
    """Four numbers of 32 bits of each key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    return [F.conv(F.substring(F.sha2(name, 256), 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def draw_cuts(stored: DataFrame, seed: int = SEED, rate: int = 50, spm: int = 80) -> DataFrame:
    """Add the form and the two cuts, in units, to stored rows. ``rate`` and ``spm`` are percentages."""
    one, two, chance, kind = _drawn(seed)
    plain = (F.col("n") == 0) | F.col("marked") | (chance % 100 >= rate)
    places = [h % (F.col("n") + 1) for h in (one, two)]
    return stored.withColumns({
        "form": F.when(plain, "plain").when(kind % 100 < spm, "spm").otherwise("psm"),
        "first": F.least(*places),
        "second": F.greatest(*places),
    })


def transform(cut: DataFrame) -> DataFrame:
    """The rearranged texts of rows with cuts, as frames: key, n, form, prefix_chars, middle_chars, frames."""
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.drop_columns(["key"]).to_pylist():
                kept = Frames(row["n"], row["n_chars"], row["units_before"], row["chars_before"], row["begins"], row["frames"])
                output, prefix, middle = rearrange(kept, row["form"], row["first"], row["second"])
                rows.append((row["n"], row["form"], prefix, middle, output))
            if rows:
                yield _rows_of(batch, rows, ["n", "form", "prefix_chars", "middle_chars", "frames"], types)

    return cut.mapInArrow(run, _schema(cut, MOVED))


def digests(transformed: DataFrame) -> DataFrame:
    """SHA-256 of the output and of the text restored from it, frame by frame."""
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.drop_columns(["key"]).to_pylist():
                output, restored = hashlib.sha256(), hashlib.sha256()
                for piece in restore(row["frames"], row["form"], output):
                    restored.update(piece)
                rows.append((row["n"], row["form"], row["prefix_chars"], row["middle_chars"], output.hexdigest(), restored.hexdigest()))
            if rows:
                yield _rows_of(batch, rows, ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"], types)

    return transformed.mapInArrow(run, _schema(transformed, DIGESTS))


def texts(transformed: DataFrame) -> DataFrame:
    """The rearranged texts as such: key, form, text."""

    @F.pandas_udf("string")
    def joined(frames):
        return frames.map(lambda parts: b"".join(decompress(part) for part in parts).decode())

    return transformed.select("key", "form", joined("frames").alias("text"))


def fill_in_middle(
    df: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, rate: int = 50, spm: int = 80, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Store all texts as frames in the shared folder, and rearrange them from there; see :func:`transform`."""
    stored = Scratch(df.sparkSession, "fill-in-middle").write(store_frames(df, text, key, frame_bytes), "frames")
    return transform(draw_cuts(stored, seed, rate, spm))
