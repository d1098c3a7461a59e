"""Line dedup by a segment-partition edit join.

A line of length l is cut into ``max_edits`` + 1 segments; a line within ``max_edits`` edits
of it holds one of them unchanged, and only near its place. So each distinct line indexes its
segments under (length, number, hash), and probes, for every length it may match, the few
substrings that such a segment can be (multi-match-aware positions). Lines that meet under a
key, and whose character pairs differ no more than the edits allow, are verified with a banded
bit-parallel edit distance on the whole lines. Lines shorter
than ``min_chars`` go as exact repeats only, and only where ``short_repeats`` asks for it; the
longest of them still count as earlier partners of longer lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import FINE_BLOCK, Rolling, WORD, blocks, frugal, maybe_in, mix, named_back, set_aside, signed, store

MAX_EDITS, MIN_CHARS = 2, 20
_U = np.uint64
_CHARS = Rolling(0x94D049BB133111EB)


def segments(length: np.ndarray, count: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of segment ``i`` (from 0) of lines of ``length``: even parts, longer ones last."""
    size, longer = length // count, length % count
    before = np.maximum(i - (count - longer), 0)
    return i * size + before, size + (i >= count - longer)


def _keys(hashes: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
    return mix(hashes + mix(length.astype(_U) * _U(64) + _U(i)))


class Lines:
    """Code points of a block of lines, with hashes of any of their substrings."""

    def __init__(self, column: pa.Array):
        text = [x or "" for x in column.to_pylist()]
        self.length = np.array([len(x) for x in text], np.int64)
        self.start = np.cumsum(self.length) - self.length
        points = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.values = mix(points.astype(_U) + _U(1))
        self.prefix = _CHARS.prefix(self.values)

    def sketches(self) -> np.ndarray:
        """Parity of each line's hashed pairs of neighbouring characters, 64 bits as a long.
        An edit removes two pairs and adds two at most, so it flips four bits at most."""
        line = np.repeat(np.arange(len(self.length)), self.length)
        same = line[1:] == line[:-1]
        bit = (mix(self.values[:-1] * _U(3) + self.values[1:]) & _U(63)).astype(np.int64)
        odd = np.bincount((line[1:] * 64 + bit)[same], minlength=64 * len(self.length)) & 1
        return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)

    def hashes(self, rows: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        s = self.start[rows] + at
        return _CHARS.ranges(self.prefix, s, s + size)

    def index(self, max_edits: int):
        """(row, key) of every segment."""
        rows = np.arange(len(self.length))
        for i in range(max_edits + 1):
            at, size = segments(self.length, max_edits + 1, i)
            yield rows, _keys(self.hashes(rows, at, size), self.length, i)

    def probes(self, max_edits: int, min_chars: int):
        """(row, key) of every substring that may be a segment of a line no longer than this one,
        for lines of ``min_chars`` or more; the other may be shorter than that."""
        for less in range(max_edits + 1):
            rows = np.flatnonzero((self.length >= min_chars) & (self.length > less))
            own, other = self.length[rows], self.length[rows] - less
            for i in range(max_edits + 1):
                at, size = segments(other, max_edits + 1, i)
                low = max(-i, less - (max_edits - i))
                high = min(i, less + (max_edits - i))
                for move in range(low, high + 1):
                    place = at + move
                    ok = (place >= 0) & (place + size <= own)
                    yield rows[ok], _keys(self.hashes(rows[ok], place[ok], size[ok]), other[ok], i)


def _entries(kind: str, max_edits: int, min_chars: int):
    def distinct(batches):
        for b in batches:
            ids, first = np.unique(b.column("lid").to_numpy(zero_copy_only=False), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids), b.column("line").take(pa.array(first))], ["lid", "line"])

    @frugal
    def run(batches):
        for b in blocks(distinct(batches), "line", FINE_BLOCK):
            ids, lines = b.column("lid").to_numpy(), Lines(b.column("line"))
            found = lines.index(max_edits) if kind == "index" else lines.probes(max_edits, min_chars)
            sketch = lines.sketches()
            for rows, key in found:
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(ids[rows]), pa.array(sketch[rows])], ["key", "lid", "sketch"])
    return run


def edit_distances(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Edit distance of each pair, ``most`` + 1 where it is larger. Pairs go together with those
    of up to twice their length, so that a long one does not widen the arrays of all others."""
    out = np.full(len(left), most + 1)
    m, n = (np.array([len(x) for x in texts], np.int64) for texts in (left, right))
    near = np.flatnonzero(np.abs(m - n) <= most)
    width = np.frexp(np.maximum(m, n)[near])[1]
    for w in np.unique(width):
        part = near[width == w]
        out[part] = _banded([left[i] for i in part], [right[i] for i in part], m[part], n[part], most)
    return out


def _banded(left: list[str], right: list[str], m: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """Edit distances of pairs of lengths ``m`` and ``n`` that differ by ``most`` at most. One column
    of the banded automaton of all pairs at a time: bit k of state e says that the pattern's first
    (column + k - most) characters match the text so far with e edits at most."""
    out = np.full(len(left), most + 1)
    def grid(texts, width, shift):
        g = np.zeros((len(texts), width), np.uint32)
        for r, t in enumerate(texts):
            p = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
            g[r, shift: shift + len(p)] = p + 1
        return g
    columns, band = int(n.max()), 2 * most + 1
    pattern = grid(left, max(columns, int(m.max())) + 2 * band, most)  # zeros around match nothing
    text = grid(right, columns, 0)
    bits = _U(1) << np.arange(band, dtype=_U)
    start = np.array([(bits[most: most + e + 1]).sum() for e in range(most + 1)], _U)
    offsets = np.arange(band) - most
    state = [np.where(True, s, _U(0)) & ((offsets <= m[:, None]) * bits).sum(1).astype(_U) for s in start]
    for j in range(columns):
        live = j < n
        match = ((pattern[:, j: j + band] == text[:, j, None]) * bits).sum(1).astype(_U)
        i = j + 1 + offsets
        valid = (((i >= 0) & (i <= m[:, None])) * bits).sum(1).astype(_U)
        new = []
        for e, s in enumerate(state):
            t = s & match
            if e:
                t |= state[e - 1] | (state[e - 1] >> _U(1)) | (new[e - 1] << _U(1))
            new.append(t & valid)
        state = [np.where(live, t, s) for t, s in zip(new, state)]
    end = (m - n + most).astype(_U)
    for e in range(most, -1, -1):
        hit = (state[e] >> end) & _U(1) == 1
        out[hit] = e
    return out


def _verify(most: int, min_chars: int):
    """(a, b) for each line a that may go because of b."""
    @frugal
    def run(batches):
        for b in blocks(batches, "x", FINE_BLOCK):
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            close = edit_distances(x, y, most) <= most
            for own, a, other in ((x, "a", "b"), (y, "b", "a")):
                goes = pa.array(close & np.array([len(t) >= min_chars for t in own], bool))
                yield pa.RecordBatch.from_arrays([b.column(c).filter(goes) for c in (a, other)], ["a", "b"])
    return run


def _order(id_col):
    return F.struct(id_col.isNull().alias("none"), id_col.alias("id"), F.col("at"))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = MAX_EDITS,
             min_chars: int = MIN_CHARS, short_repeats: bool = False) -> DataFrame:
    """(__row, __id, removed): numbers of the lines that go, for each row of ``docs`` that loses any.

    A line of ``min_chars`` characters or more goes if a line within ``max_edits`` edits of it
    (or equal) stands before it: in a document with a smaller id (null ids last), or earlier
    in the same one. The earlier line may be shorter than ``min_chars``. With ``short_repeats`` a
    shorter line that holds a word goes if an equal one stands before it. Judged on the input. Null and empty texts have no such line; equal rows
    are one document; rows that share an id only are ordered by line number alone. Lines of any
    length are compared whole."""
    if min_chars <= max_edits + 1:
        raise ValueError("min_chars must exceed max_edits + 1")
    d = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
    d = d.withColumn("__row", F.xxhash64("__id", "__t"))
    lines = (d.select("__id", "__row", F.posexplode(F.split("__t", "\n")).alias("at", "line"))
             .withColumn("long", F.length("line") >= min_chars).withColumn("lid", F.xxhash64("line")))
    partner = F.length("line") >= max(1, min_chars - max_edits)
    text = lines.where(partner).select("lid", "line")
    goes = F.col("long") | F.rlike("line", F.lit(WORD)) if short_repeats else F.col("long")
    places = store(lines.where(partner | goes).select("__id", "__row", "at", "lid", goes.alias("goes")), "line-places")
    # dealt by key once: repeated lines are dropped and keys joined where they are
    index, probe = (text.mapInArrow(_entries(k, max_edits, min_chars), "key long, lid long, sketch long").repartition("key").distinct()
                    for k in ("index", "probe"))
    a, b = index.toDF("key_a", "a", "sketch_a"), probe.toDF("key_b", "b", "sketch_b")
    differ = F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b")))
    may = (F.col("key_a") == F.col("key_b")) & (F.col("a") != F.col("b")) & (differ <= 4 * max_edits)
    pairs = store(a.join(b, may).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")
    named = pairs.select(F.col("a").alias("lid")).union(pairs.select(F.col("b").alias("lid")))
    texts = maybe_in(text, named, "lid").dropDuplicates(["lid"])
    x, y = (texts.select(F.col("lid").alias(p), F.col("line").alias(t)) for p, t in (("a", "x"), ("b", "y")))
    links = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(max_edits, min_chars), "a long, b long")
    links = store(links, "line-links")
    firsts = places.groupBy("lid").agg(F.min(_order(F.col("__id"))).alias("first"), F.count("*").alias("n"))
    firsts = store(firsts.join(links.select(F.explode(F.array("a", "b")).alias("lid")).distinct().withColumn("linked", F.lit(True)), "lid", "left")
                   .where("n > 1 or linked").select("lid", "first"), "line-firsts")
    near = links.join(firsts.select(F.col("lid").alias("b"), "first"), "b").select(F.col("a").alias("lid"), "first")
    before = firsts.union(near).groupBy("lid").agg(F.min("first").alias("first"))
    gone = places.where("goes").join(before, "lid").where(_order(F.col("__id")) > F.col("first"))
    return gone.groupBy("__row", "__id").agg(F.sort_array(F.collect_set("at")).alias("removed"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The id, n_lines, n_removed and removed (line numbers from 0), one row per row of ``docs``."""
    gone = removals(docs, id_col, text_col, **options).select(F.col("__row").alias("__r"), F.col("__id").alias("__i"), "removed")
    n_lines = F.when(F.coalesce(F.col(text_col), F.lit("")) == "", 0).otherwise(F.size(F.split(text_col, "\n"))).cast("long")
    d = docs.select(F.col(id_col).alias("__id"), F.xxhash64(id_col, text_col).alias("__row"), n_lines.alias("n_lines"))
    out = d.join(gone, (F.col("__row") == F.col("__r")) & F.col("__id").eqNullSafe(F.col("__i")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select(F.col("__id").alias(id_col), "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those lines; a document that had text and loses all of it goes, all
    others stay, and texts that lose nothing are unchanged. All other columns pass through,
    whatever their names. Null and empty texts stay; equal rows lose the same lines."""
    given, (docs, (id_col, text_col)) = docs, set_aside(docs, id_col, text_col)
    gone = store(removals(docs, id_col, text_col, **options), "line-removals")
    gone = gone.select(F.col("__row").alias("__r"), F.col("__id").alias("__i"), "removed")
    d = docs.withColumn("__row", F.xxhash64(id_col, text_col))
    out = d.join(gone, (F.col("__row") == F.col("__r")) & F.col(id_col).eqNullSafe(F.col("__i")), "left")
    left = F.array_join(F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    out = out.withColumn(text_col, F.when(F.col("removed").isNull(), F.col(text_col)).otherwise(left))
    return named_back(out.where(F.col("removed").isNull() | F.rlike(text_col, F.lit(r"[^\x20\x09-\x0D]"))), given)
