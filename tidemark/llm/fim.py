"""Fill-in-middle transformation over seekable compressed frames.

A text's *units* are `[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`: a word with the
blanks before it, and blanks at the end. Texts are stored as independent zstandard frames of
about FRAME bytes, cut between units where that is possible, with the units, characters and
bytes up to each frame's end. The cut after the k-th unit is found by the cumulative counts and
by decompressing the one frame it falls in; digests stream the frames in order, so that a task
holds one decompressed frame at a time however long the text.

Form and cuts come from the digits of sha256(`<seed>:<id>`), so reruns and lost tasks agree."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import _IS_SPACE, Words, blocks, text_buffer

FRAME = 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FRAMES_SCHEMA = "id long, n long, chars long, marked boolean, frames array<binary>, frame_units array<long>, frame_chars array<long>, frame_bytes array<long>"


# ---- frames --------------------------------------------------------------------------------

class Frames:
    """Bytes as independent frames; ``bytes``, ``units``, ``chars``: totals up to each frame's end."""

    def __init__(self, data: list[bytes], ends: list[int], units: list[int] = (), chars: list[int] = ()):
        self.data, self.ends, self.units, self.chars = data, ends, units, chars
        self._open = zstandard.ZstdDecompressor().decompress
        self._held = (-1, b"")

    @classmethod
    def pack(cls, chunks: Iterator[bytes], size: int = FRAME) -> Frames:
        """Frames of a stream of bytes."""
        press = zstandard.ZstdCompressor(level=1).compress
        data, ends, held, n = [], [], [], 0
        for chunk in chunks:
            held.append(chunk)
            n += len(chunk)
            if n >= size:
                data.append(press(b"".join(held)))
                ends.append((ends[-1] if ends else 0) + n)
                held, n = [], 0
        if n:
            data.append(press(b"".join(held)))
            ends.append((ends[-1] if ends else 0) + n)
        return cls(data, ends)

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def frame(self, i: int) -> bytes:
        if self._held[0] != i:
            self._held = (i, self._open(self.data[i]))
        return self._held[1]

    def read(self, a: int, z: int) -> Iterator[bytes]:
        """Bytes a to z, a frame's share at a time."""
        i = bisect_right(self.ends, a)
        while a < z:
            low = self.ends[i - 1] if i else 0
            yield self.frame(i)[a - low: z - low]
            a, i = self.ends[i], i + 1

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, characters) of the first ``k`` units."""
        if k == 0:
            return 0, 0
        i = bisect_left(self.units, k)
        units, chars, low = (self.units[i - 1], self.chars[i - 1], self.ends[i - 1]) if i else (0, 0, 0)
        raw = np.frombuffer(self.frame(i), np.uint8)
        blank = _IS_SPACE[raw]
        inside = np.flatnonzero(blank[1:] & ~blank[:-1])      # last bytes of units before the frame's end
        at = int(inside[k - units - 1]) + 1 if k - units <= len(inside) else len(raw)
        return low + at, chars + int(((raw[:at] & 0xC0) != 0x80).sum())

    def find(self, mark: bytes, a: int) -> int:
        """Where ``mark`` first stands from byte ``a`` on, -1 if nowhere."""
        tail, low = b"", a
        for chunk in self.read(a, len(self)):
            got = tail + chunk
            at = got.find(mark)
            if at >= 0:
                return low + at
            keep = min(len(got), len(mark) - 1)
            low, tail = low + len(got) - keep, got[len(got) - keep:]
        return -1


def _frames(size: int):
    def run(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for b in blocks(batches, "text"):
            column = b.column("text")
            data, offsets = text_buffer(column)
            words = Words(column)
            solid = ~_IS_SPACE[data]
            lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            last = offsets[1:][offsets[1:] > offsets[:-1]]
            ends = np.sort(np.concatenate([words.ends, last[~solid[last - 1]]]))   # ends of units
            before = np.searchsorted(ends, offsets, "right")
            marked = np.zeros(b.num_rows, bool)
            for m in (PREFIX, SUFFIX, MIDDLE):
                marked |= pc.fill_null(pc.match_substring(column, m.decode()), False).to_numpy(zero_copy_only=False)
            rows = [[], [], [], []]
            for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                cuts = [a]
                while z - cuts[-1] > size:
                    to = cuts[-1] + size
                    unit = ends[max(np.searchsorted(ends, to, "right") - 1, 0)]
                    if unit <= cuts[-1]:        # one unit fills the frame: cut between characters
                        unit = to
                        while data[unit] & 0xC0 == 0x80:
                            unit -= 1
                    cuts.append(int(unit))
                if z > a:
                    cuts.append(z)
                at = np.array(cuts[1:], np.int64)
                rows[0].append([press(data[x:y].tobytes()) for x, y in zip(cuts, cuts[1:])])
                rows[1].append((np.searchsorted(ends, at, "right") - before[i]).tolist())
                rows[2].append((lead[at] - lead[a]).tolist())
                rows[3].append((at - a).tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(before)), pa.array(np.diff(lead[offsets])), pa.array(marked), pa.array(rows[0], pa.list_(pa.binary())),
                 *[pa.array(r, longs) for r in rows[1:]]],
                ["id", "n", "chars", "marked", "frames", "frame_units", "frame_chars", "frame_bytes"])
    return run


def frames(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = FRAME) -> DataFrame:
    """The texts as a table of frames, one row per row of ``docs``: id, n (units), chars, marked
    (the text holds a marker), frames, and the units, characters and bytes up to the end of each.

    Null texts are empty; empty texts have no frame. Ids may be null or repeat. Other columns are
    ignored. No rows: no rows."""
    if size < 8:
        raise ValueError("a frame holds at least two characters")
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return d.mapInArrow(_frames(size), FRAMES_SCHEMA)


# ---- transformation ------------------------------------------------------------------------

def draw(row_id: int | None, n: int, marked: bool, seed: int, percent: int, spm_percent: int) -> tuple[str, int, int]:
    """(form, units of the prefix, units of prefix and middle)."""
    digits = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    h = [int(digits[i: i + 8], 16) for i in (0, 8, 16, 24)]
    if n == 0 or marked or h[2] % 100 >= percent:
        return "plain", 0, 0
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return "spm" if h[3] % 100 < spm_percent else "psm", a, z


def output(text: Frames, form: str, a: int, z: int) -> Iterator[bytes]:
    """The transformed text, part by part; ``a`` and ``z`` are the cuts in bytes."""
    if form == "plain":
        yield from text.read(0, len(text))
        return
    parts = {PREFIX: (0, a), SUFFIX: (z, len(text)), MIDDLE: (a, z)}
    for mark in (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE):
        yield mark
        yield from text.read(*parts[mark])


def restore(out: Frames, form: str) -> Iterator[bytes]:
    """The text that ``out`` was made from, part by part: the markers are sought in their order
    and prefix, middle and suffix read from between them."""
    if form == "plain":
        yield from out.read(0, len(out))
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    at = [0]
    for mark in order[1:]:
        at.append(out.find(mark, at[-1] + len(mark)))
    if -1 in at:
        raise ValueError("not an output of this form")
    parts = {m: (x + len(m), y) for m, x, y in zip(order, at, [*at[1:], len(out)])}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from out.read(*parts[mark])


def _digest(chunks: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for c in chunks:
        h.update(c)
    return h.hexdigest()


def transform(framed: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, with_output: bool = False,
              size: int = FRAME, rows: int = 256) -> DataFrame:
    """id, n, form, prefix_chars, middle_chars (null if plain), output_sha256, restored_sha256
    and, if asked, the output text, of the rows of :func:`frames`.

    Empty texts and texts that hold a marker stay plain. A null id draws as an empty one; rows
    with one id share form and draws, so equal rows agree. ``percent`` of the texts change form,
    ``spm_percent`` of them to suffix-prefix-middle."""
    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
                out = [[] for _ in range(6)]
                columns = [b.column(c) for c in ("id", "n", "marked", "frames", "frame_units", "frame_chars", "frame_bytes")]
                for row in zip(*columns):
                    row_id, n, marked, data, units, chars, ends = (x.as_py() for x in row)
                    text = Frames(data, ends, units, chars)
                    form, a, z = draw(row_id, n, marked, seed, percent, spm_percent)
                    (a, a_chars), (z, z_chars) = text.cut(a), text.cut(z)
                    packed = Frames.pack(output(text, form, a, z), size)
                    plain = form == "plain"
                    new = (form, None if plain else a_chars, None if plain else z_chars - a_chars, _digest(packed.read(0, len(packed))),
                           _digest(restore(packed, form)), b"".join(packed.read(0, len(packed))).decode() if with_output else None)
                    for column, x in zip(out, new):
                        column.append(x)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                made = [pa.array(x, k) for x, k in zip(out, kinds)][: 6 if with_output else 5]
                yield pa.RecordBatch.from_arrays([columns[0], columns[1], *made], names)
    schema = "id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    schema += ", output string" if with_output else ""
    names = [f.split()[0] for f in schema.split(", ")]
    return framed.mapInArrow(run, schema)
