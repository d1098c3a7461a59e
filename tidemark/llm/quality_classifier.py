"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its hashed words, word pairs and character
n-grams, followed by a softmax over two classes; vectors and output are trained by
stochastic gradient descent in numpy on a bounded labelled sample. As the model is linear in
the average, scoring needs one number per hash bucket (a fixed-size table), looked up for all
features of a block at once."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BYTE_VALUES, FINE_BLOCK, Rolling, Words, blocks, frugal, mix

_U = np.uint64
_BYTES = Rolling(0xC2B2AE3D27D4EB4F)
#: Stands for a word equal to the one before it, so that stuttering is one feature.
_AGAIN = _U(0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Options:
    buckets: int = 1 << 18
    dim: int = 8
    char_ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    #: A small sample is gone over more often, until so many documents have been seen.
    least_steps: int = 6000
    rate: float = 0.5
    seed: int = 11
    #: Bound on the labelled sample a fit reads, and on the length of a text in it.
    max_rows: int = 4000
    max_chars: int = 1 << 20


def features(column: pa.Array, o: Options, piece: int = 1 << 19):
    """Yield (row, bucket) arrays covering all features of all texts: each word and pair of
    neighbouring words, each character n-gram of the text, and one end mark per text."""
    w = Words(column)
    n = len(column)
    yield np.arange(n), np.zeros(n, np.int64)
    h = w.hashes()
    row = np.repeat(np.arange(n), np.diff(w.bounds))
    bucket = lambda x: (mix(x) % _U(o.buckets - 1)).astype(np.int64) + 1
    if len(h):
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        g = np.where(again, _AGAIN, h)
        yield row, bucket(g)
        pair = row[1:] == row[:-1]
        yield row[1:][pair], bucket((g[:-1] * _U(0x9FB21C651E98DF25) + mix(g[1:]))[pair])
    data, offsets = w.data, w.offsets
    chars = np.flatnonzero((data & 0xC0) != 0x80)   # first byte of each character
    top = max(o.char_ngrams)
    for at in range(0, len(chars), piece):
        part = chars[at: at + piece + top]
        low = part[0]
        stop = np.append(part, len(data))
        if at + piece + top < len(chars):
            stop[-1] = chars[at + piece + top]
        prefix = _BYTES.prefix(BYTE_VALUES[data[low: stop[-1]]])
        text = np.searchsorted(offsets, part, "right") - 1
        for k in o.char_ngrams:
            m = min(piece, len(part), max(0, len(stop) - k))
            s, e = part[:m], stop[k: k + m]
            inside = e <= offsets[text[:m] + 1]
            yield text[:m][inside], bucket(_BYTES.ranges(prefix, s - low, e - low)[inside] + _U(k))


@dataclass
class Model:
    """``weights[bucket]``: what a feature adds to the log odds of class 1, before averaging."""

    weights: np.ndarray
    options: Options = field(default_factory=Options)

    def scores(self, column: pa.Array) -> np.ndarray:
        total, count = np.zeros(len(column)), np.zeros(len(column))
        for row, bucket in features(column, self.options):
            total += np.bincount(row, self.weights[bucket], len(column))
            count += np.bincount(row, minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1), -500, 500)))


def train(texts: list[str], labels: np.ndarray, o: Options = Options()) -> Model:
    """Fit the vectors (buckets x dim) and the softmax output (dim x 2) document by document.
    Without any labelled text every score is 0.5."""
    if not len(texts):
        return Model(np.zeros(o.buckets), o)
    rows = []
    for at in range(0, len(texts), 64):
        part = pa.array(texts[at: at + 64], pa.string())
        found = list(features(part, o))
        row = np.concatenate([r for r, _ in found])
        pair, count = np.unique(row * o.buckets + np.concatenate([b for _, b in found]), return_counts=True)
        edge = np.searchsorted(pair, np.arange(len(part) + 1) * o.buckets)
        for i in range(len(part)):
            c = count[edge[i]: edge[i + 1]].astype(np.float32)
            rows.append(((pair[edge[i]: edge[i + 1]] - i * o.buckets).astype(np.int32), c / c.sum()))
    rng = np.random.default_rng(o.seed)
    vectors = rng.uniform(-1 / o.dim, 1 / o.dim, (o.buckets, o.dim)).astype(np.float32)
    output = np.zeros((o.dim, 2), np.float32)
    y = np.asarray(labels, int)
    epochs = max(o.epochs, -(-o.least_steps // len(rows)))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            rate = o.rate * (1 - done / steps)
            done += 1
            at, share = rows[i]
            hidden = share @ vectors[at]
            z = hidden @ output
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = output @ p
            output -= rate * np.outer(hidden, p)
            vectors[at] -= rate * np.outer(share * len(share) ** 0.5, back)
    return Model(vectors.astype(float) @ (output[:, 1] - output[:, 0]).astype(float), o)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", options: Options = Options()) -> Model:
    """Fit on labelled rows (label not null): those ``max_rows`` with the smallest hash of their
    id, texts up to ``max_chars``. A null text counts as empty; labels without a document are
    passed over, repeated ones count as often as they stand, up to ``2 * max_rows`` labelled
    texts in the order of the hash, then id, label and hash of the text, so reruns agree."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("__id"), (F.col(label_col) > 0).cast("int").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id", "__y").limit(options.max_rows))
    d = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    rows = (d.where(F.length("__t") <= options.max_chars).join(F.broadcast(picked), "__id")
            .orderBy(F.xxhash64("__id"), "__id", "__y", F.xxhash64("__t")).limit(2 * options.max_rows)
            .select("__id", "__t", "__y").toPandas())
    rows = rows.sort_values(["__id", "__y", "__t"])
    return train(rows["__t"].tolist(), rows["__y"].to_numpy(), options)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1, higher: class 1 likelier) in place of the text column.

    Null and empty texts are scored by the end mark alone; long texts are read whole; every
    row is scored, repeated ones alike; an empty table gives none."""
    keep = [c for c in docs.columns if c not in (text_col, score_col)]
    d = docs.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias("__t"))
    shared = d.sparkSession.sparkContext.broadcast(model)

    @frugal
    def run(batches):
        m = shared.value
        for b in blocks(batches, "__t", FINE_BLOCK):
            out = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*out, pa.array(m.scores(b.column(b.num_columns - 1)))], [*b.schema.names[:-1], "__score"])

    schema = ", ".join(f"__in{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = d.mapInArrow(run, f"{schema}, __score double" if schema else "__score double")
    return out.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(keep)], F.col("__score").alias(score_col))
