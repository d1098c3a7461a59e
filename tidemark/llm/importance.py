"""Importance resampling towards a target distribution of hashed n-grams.

Words are runs of digits, a-z (A-Z lower-cased) and characters from U+0080 on; features are all
runs of 1 to 3 consecutive words joined by one space, repeats counted. A feature's bucket is its
crc32 modulo the number of buckets. All texts of the corpus and of the target are counted by
bucket; a bucket's gain is the scaled log of its smoothed share in the target over that in the
corpus, a text's weight the sum of its gains, and the texts with the highest weights plus Gumbel
noise are drawn (sampling without replacement by importance).

The crc32 of all features of a block is computed at once: it is linear, so each byte adds a value
that depends only on the byte and its distance from the feature's end. These are looked up in one
table, XORed by `bitwise_xor.reduceat` over the features' spans, and a constant of the length is
added. Spans longer than the table fold block by block: each block's sum is moved up by the
blocks behind it with tables of the powers of two."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, store, text_buffer

BUCKETS, LONGEST, LEAST_WORDS, SEED = 10_000, 3, 20, 42
#: Text bytes a task works on at once, and span bytes that are summed at once.
TEXT_BYTES, SPAN_BYTES = 1 << 18, 1 << 20
#: Rows of the sort that ranks the drawn ones, per partition.
ROWS_PER_PART = 1_000_000

_U32 = np.uint32
#: Bytes of words, A-Z folded; 0 for all others.
_WORD = np.zeros(256, np.uint8)
for _a, _z in ((48, 58), (97, 123), (128, 256)):
    _WORD[_a:_z] = np.arange(_a, _z)
_WORD[65:91] = np.arange(97, 123)


class PositionCRC:
    """crc32 (reflected polynomial 0xEDB88320, as zlib's) of many spans of a buffer at once."""

    def __init__(self, block: int = 64):
        self.block = block
        step = np.arange(256, dtype=_U32)
        for _ in range(8):
            step = np.where(step & _U32(1), (step >> _U32(1)) ^ _U32(0xEDB88320), step >> _U32(1)).astype(_U32)
        self.step = step
        rows = [step]
        for _ in range(block - 1):
            rows.append((rows[-1] >> _U32(8)) ^ step[rows[-1] & _U32(255)])
        self.table = np.concatenate(rows)               # [distance from the end * 256 + byte]
        # moves[i]: a state moved on by 2**i zero bytes, as one table per byte of the state
        one = np.array([[v << 8 * k for v in range(256)] for k in range(4)], _U32)
        self.moves = [(one >> _U32(8)) ^ step[one & _U32(255)]]
        self.constants = self._constant(np.arange(block + 1))

    def _move(self, states: np.ndarray, i: int) -> np.ndarray:
        while len(self.moves) <= i:
            last = len(self.moves) - 1
            self.moves.append(self._move(self._move(np.array([[v << 8 * k for v in range(256)] for k in range(4)], _U32), last), last))
        m = self.moves[i]
        return (m[0][states & _U32(255)] ^ m[1][(states >> _U32(8)) & _U32(255)]
                ^ m[2][(states >> _U32(16)) & _U32(255)] ^ m[3][states >> _U32(24)])

    def advance(self, states: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        """Each state moved on by its own number of zero bytes."""
        for i in range(int(zeros.max(initial=0)).bit_length()):
            hit = (zeros >> i) & 1 == 1
            states = np.where(hit, self._move(states, i), states)
        return states

    def _constant(self, lengths: np.ndarray) -> np.ndarray:
        """What a length adds: the crc32 of so many zero bytes."""
        return self.advance(np.full(len(lengths), 0xFFFFFFFF, _U32), np.asarray(lengths, np.int64)) ^ _U32(0xFFFFFFFF)

    def _short(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The linear part for spans of 1 to ``block`` bytes, SPAN_BYTES at a time."""
        out, done = np.empty(len(starts), _U32), np.cumsum(lengths)
        at = 0
        while at < len(starts):
            low = done[at] - lengths[at]
            to = max(at + 1, int(np.searchsorted(done, low + SPAN_BYTES, "right")))
            n, first = lengths[at:to], (done[at:to] - lengths[at:to] - low).astype(np.int64)
            place = np.arange(int(done[to - 1] - low))
            place += np.repeat(starts[at:to] - first, n)
            value = np.repeat((starts[at:to] + n - 1) << 8, n)
            value -= place << 8
            value += data[place]
            out[at:to] = np.bitwise_xor.reduceat(self.table[value], first)
            at = to
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """crc32 of each ``data[start:end]``; no span may be empty."""
        lengths = ends - starts
        out = np.empty(len(starts), _U32)
        short = lengths <= self.block
        out[short] = self._short(data, starts[short], lengths[short]) ^ self.constants[lengths[short]]
        if not short.all():
            s, z = starts[~short], ends[~short]
            n = -(-(z - s) // self.block)               # blocks, counted from the span's end
            span = np.repeat(np.arange(len(s)), n)
            first = np.cumsum(n) - n
            behind = np.arange(len(span)) - first[span]
            z_block = z[span] - behind * self.block
            s_block = np.maximum(s[span], z_block - self.block)
            part = self.advance(self._short(data, s_block, z_block - s_block), behind * self.block)
            out[~short] = np.bitwise_xor.reduceat(part, first) ^ self._constant(z - s)
        return out


@functools.lru_cache(1)
def crc() -> PositionCRC:
    return PositionCRC()


def features(column: pa.Array, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of a block of texts, and the words of each text."""
    data, offsets = text_buffer(column)
    folded = _WORD[data]
    solid = folded != 0
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    before[offsets[:-1][offsets[:-1] < offsets[1:]]] = False
    first = np.flatnonzero(solid & ~before)
    n_words = np.diff(np.searchsorted(first, offsets))
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.int64), n_words
    at = np.flatnonzero(solid)
    lengths = np.diff(np.append(np.searchsorted(at, first), len(at)))
    ends = np.cumsum(lengths + 1) - 1                   # in the words joined by one space
    starts = ends - lengths
    joined = np.full(int(ends[-1]), 32, np.uint8)
    joined[np.arange(len(at)) + np.repeat(np.arange(len(first)), lengths)] = folded[at]
    text = np.repeat(np.arange(len(n_words)), n_words)
    texts, found = [], []
    for n in range(1, longest + 1):
        head = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.empty(0, np.int64)
        if len(head):
            texts.append(text[head])
            found.append(crc().spans(joined, starts[head], ends[head + n - 1]) % _U32(buckets))
    return np.concatenate(texts), np.concatenate(found).astype(np.int64), n_words


def count(texts: DataFrame, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. Each task sends at most one row a bucket, and as many
    rows in all come to the driver (``buckets`` is the bound). Null texts have none."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in blocks(batches, "text", TEXT_BYTES):
            total += np.bincount(features(b.column("text"), longest, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    sums = texts.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, in doubles."""
    s, t, n = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(scale * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def score(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST,
          seed: int = SEED) -> DataFrame:
    """id, n_words, n_features, weight and score of every row; ``score`` is the weight plus
    floor(-1000 ln(-ln u)), u from the first 32 bits of sha256(`<seed>:<id>`).

    Texts without a word (null ones too) have no feature and weight 0; a null id draws as an
    empty one. Texts of any length are read whole. Other columns are ignored."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)      # one number a bucket

    def run(batches):
        values = sent.value
        for b in blocks(batches, "text", TEXT_BYTES):
            text, bucket, n_words = features(b.column("text"), longest, len(values))
            n = np.bincount(text, minlength=b.num_rows).astype(np.int64)
            order = np.argsort(text, kind="stable")
            total = np.concatenate([[0], np.cumsum(values[bucket[order]])])
            end = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(total[end] - total[end - n])],
                                             ["id", "n_words", "n_features", "weight"])

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    got = d.mapInArrow(run, "id long, n_words long, n_features long, weight long")
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digits, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return got.withColumn("score", F.col("weight") + F.floor(-1000.0 * F.log(-F.log(u))))


def draw(scored: DataFrame, percent: int = 5, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with rank: of the N rows with at least ``least_words`` words the
    floor(percent * N / 100) highest scores, from 1 on, ties to the smaller id (null ids first);
    null for all others. Equal rows take successive ranks.

    One range sort of the rows' numbers, stored with each row's place in its partition; the
    places of the partitions before it are added by a table of one row a partition."""
    spark = scored.sparkSession
    scored = store(scored, "scored")
    may = scored.where(F.col("n_words") >= least_words)
    n = may.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_PART))
    order = [F.desc("score"), F.col("id").asc_nulls_first()]
    place = F.monotonically_increasing_id()             # partition << 33 | row of the partition
    ranged = store(may.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", place), "ranged")
    part = F.shiftright("place", 33)
    sizes = {r["part"]: r["count"] for r in ranged.groupBy(part.alias("part")).count().collect()}
    before, seen = [], 0
    for p in sorted(sizes):
        before.append((p, seen))
        seen += sizes[p]
    starts = spark.createDataFrame(before, "part long, before long")
    ranked = (ranged.withColumn("part", part).join(F.broadcast(starts), "part")
              .withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1))
    columns = [F.col(c) for c in scored.columns]
    drawn = ranked.select(*columns, F.when(F.col("rank") <= percent * n // 100, F.col("rank")).alias("rank"))
    rest = scored.where(F.coalesce(F.col("n_words"), F.lit(0)) < least_words)
    return drawn.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = 5, buckets: int = BUCKETS, **options) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score, rank (null: not
    drawn). An empty target makes frequent features cheap, nothing more; no rows give no rows."""
    gain = gains(count(docs, text_col, buckets=buckets), count(target, target_col, buckets=buckets))
    return draw(score(docs, gain, id_col, text_col, **options), percent).withColumnRenamed("id", id_col)
