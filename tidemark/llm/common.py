"""Helpers shared by the operators: word splitting and hashing over Arrow text
buffers, stored intermediate tables, bounded key filters, connected components.

A *word* is a maximal run of characters outside space and U+0009..U+000D
everywhere in this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: Text bytes a Python task works on at once.
BLOCK_BYTES = 2 << 20
#: The same for the operators of the pipeline, whose workers live through all stages: numpy's arrays
#: over a text take some 100 times its bytes.
FINE_BLOCK = 1 << 18

_U = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back (lineage cut)."""
    return materialize(df, name)


def set_aside(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns named __in0, __in1, .. so that no name of an operator's own can
    clash with them, and the new names of ``columns``."""
    at = docs.columns.index
    return docs.toDF(*[f"__in{i}" for i in range(len(docs.columns))]), [f"__in{at(c)}" for c in columns]


def named_back(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their own names, of a table that :func:`set_aside` renamed."""
    return df.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(docs.columns)])


# ---- hashing -------------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (full avalanche) over uint64 arrays."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Rolling:
    """Rabin-Karp polynomial hashes mod 2**64 of any range of a sequence, from one
    prefix sum: hash(i, j) = (S[j] - S[i]) * base**-i."""

    def __init__(self, base: int):
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, _U)

    def _grow(self, n: int) -> None:
        if len(self.powers) >= n:
            return
        size = max(n, 1 << 16)
        for name, b in (("powers", self.base), ("inverses", self.inverse)):
            p = np.full(size, b, _U)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            setattr(self, name, p)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        s = np.zeros(len(values) + 1, _U)
        np.cumsum(values * self.powers[: len(values)], out=s[1:])
        return s

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self.inverses[starts]

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        """Mixed hashes of all windows of ``width`` consecutive values."""
        n = len(values) - width + 1
        if n <= 0:
            return np.empty(0, _U)
        s = self.prefix(values)
        return mix((s[width:] - s[:n]) * self.inverses[:n])


BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
_BYTES = Rolling(0x2545F4914F6CDD1D)


# ---- text buffers --------------------------------------------------------------------------

def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    if column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def blocks(batches, column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row slices of about ``size`` text bytes (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(np.asarray(lengths.to_numpy(zero_copy_only=False), np.int64))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def give_back() -> None:
    """Hand memory that Arrow and the allocator hold free back to the system (where the C library can)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def frugal(run: Callable) -> Callable:
    """A task's ``run(batches)`` that gives its freed memory back at the end: Python workers are used
    again, so what one stage's tasks have freed would count beside the next stage's."""
    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


class Words:
    """Words of a block of texts: byte ranges, 64-bit hashes, and the word range of each text."""

    def __init__(self, column: pa.Array, fold_case: bool = False):
        data, offsets = text_buffer(column)
        self.data, self.offsets = data, offsets
        solid = ~_IS_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = solid[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        before[first] = False
        self.starts = np.flatnonzero(solid & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = solid[1:]
        if len(first):
            after[first[1:] - 1] = False
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets, "left")
        self.fold_case = fold_case

    def hashes(self) -> np.ndarray:
        table = FOLDED_VALUES if self.fold_case else BYTE_VALUES
        out = np.empty(len(self.starts), _U)
        at = 0
        while at < len(out):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + (1 << 19), "right")))
            s, e = self.starts[at:to] - low, self.ends[at:to] - low
            prefix = _BYTES.prefix(table[self.data[low: low + e[-1]]])
            out[at:to] = mix(_BYTES.ranges(prefix, s, e) + (e - s).astype(_U))
            at = to
        return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(_U, copy=False).view(np.int64)


# ---- bounded key filter --------------------------------------------------------------------

def maybe_in(df: DataFrame, keys: DataFrame, column: str, words: int = 1 << 17) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``keys[column]``: a one-hash Bloom
    filter of a fixed 64 * ``words`` bits, broadcast (at most ``words`` rows whatever
    the input). Never loses a row that is in ``keys``; it only spares most others a
    shuffle. Null keys never match."""
    h = F.xxhash64(column, F.lit(77))
    slot, bit = F.pmod(h, F.lit(words)), F.shiftrightunsigned(h, 58).cast("int")
    one = F.expr("shiftleft(1L, __bit)")
    bits = (keys.where(F.col(column).isNotNull()).select(slot.alias("__slot"), bit.alias("__bit"))
            .groupBy("__slot").agg(F.bit_or(one).alias("__bits")))
    hit = F.expr("(shiftrightunsigned(__bits, __bit) & 1L) = 1L")
    return (df.where(F.col(column).isNotNull()).withColumns({"__slot": slot, "__bit": bit})
            .join(F.broadcast(bits), "__slot").where(hit).select(*[F.col(f"`{c}`") for c in df.columns]))


# ---- connected components ------------------------------------------------------------------

def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``, component = smallest node
    reachable. Alternating large-star and small-star steps: each round is two
    aggregations over the links, stored in the shared folder, until all links are
    stars; star-shaped input needs no round. Nothing comes to the driver but whether
    they are."""
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large(e):
        d = both(e)
        low = d.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return (d.join(low, "a").where(F.col("b") > F.col("a"))
                .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())

    def small(e):
        d = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = d.groupBy("a").agg(F.min("b").alias("m"))
        moved = d.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        return moved.union(low.select("a", F.col("m").alias("b"))).distinct()

    def settled(e):
        """Every link leads from a node that has no other link to one that leads nowhere."""
        ends = e.select(F.col("a").alias("v"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
            e.select(F.col("b").alias("v"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        return ends.groupBy("v").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)").isEmpty()

    e = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        if settled(e):
            break
        now = store(small(large(e)), "stars")
        discard(e)
        e = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
