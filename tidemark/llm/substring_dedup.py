"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in
Spark; windows that repeat an earlier document merge into maximal removal intervals.

A window can only repeat if its anchor does: the smallest of the hashes of its GRAM-word
grams (the same for equal windows). Anchors are few (about one in twenty words), so first
they are counted; windows whose anchor stands in one document only are settled, and of the
others every window is hashed with 128 bits and counted. Nothing is sampled: equal windows
always share their anchor."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rolling, Words, blocks, maybe_in, mix, named_back, set_aside, signed, store

WINDOW, GRAM = 50, 10
_GRAM_HASH, _FIRST, _SECOND = (Rolling(b) for b in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, span = len(x) - width + 1, 1
    if n <= 0:
        return x[:0]
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span: width - span + n])


def window_anchors(words: Words, hashes: np.ndarray, window: int, gram: int):
    """(row of each window, its first word, its anchor), windows in order."""
    low = _sliding_min(_GRAM_HASH.windows(hashes, gram), window - gram + 1)
    each = np.maximum(np.diff(words.bounds) - window + 1, 0)
    row = np.repeat(np.arange(len(each)), each)
    at = np.arange(len(row)) + np.repeat(words.bounds[:-1] - (np.cumsum(each) - each), each)
    return row, at, low[at]


def _kept_text(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each text joined by one space: (bytes, offsets with a spare space after each word)."""
    s, length = words.starts[keep], (words.ends - words.starts)[keep] + 1
    out = np.cumsum(length) - length
    total = int(length.sum())
    source = np.arange(total) - np.repeat(out - s, length)
    ends = out + length - 1
    source[ends] = 0
    text = words.data[source] if total else np.empty(0, np.uint8)
    text[ends] = 32
    per_row = np.concatenate([[0], np.cumsum(keep)])[words.bounds]
    return text, np.concatenate([out, [total]])[per_row]


def _digests(words: Words, keep: np.ndarray) -> list[str]:
    text, at = _kept_text(words, keep)
    view = memoryview(np.ascontiguousarray(text))
    return [hashlib.sha256(view[a: max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.ListArray:
    """Values (sorted by row) as a list column of ``n`` rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def _profile(window: int, gram: int):
    def run(batches):
        for b in blocks(batches, "__t"):
            w = Words(b.column("__t"))
            row, _, anchor = window_anchors(w, w.hashes(), window, gram)
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
            row, anchor = row[new], anchor[new]
            order = np.lexsort((anchor, row))
            row, anchor = row[order], anchor[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), b.column("__row"), pa.array(np.diff(w.bounds)), pa.array(_digests(w, np.ones(len(w.starts), bool)), pa.string()),
                 _lists(signed(anchor[new]), row[new], b.num_rows)], ["__id", "__row", "n_words", "kept_sha256", "anchors"])
    return run


def _windows(window: int, gram: int):
    def run(batches):
        for b in blocks(batches, "__t"):
            w = Words(b.column("__t"))
            h = w.hashes()
            row, at, anchor = window_anchors(w, h, window, gram)
            shared = b.column("anchors").flatten().to_numpy(zero_copy_only=False)
            keep = np.isin(signed(anchor), shared)
            row, at = row[keep], at[keep]
            yield pa.RecordBatch.from_arrays(
                [b.column("__id").take(pa.array(row)), b.column("__row").take(pa.array(row)), pa.array((at - w.bounds[row]).astype(np.int32)),
                 pa.array(signed(_FIRST.windows(h, window)[at])), pa.array(signed(_SECOND.windows(mix(h ^ np.uint64(0x5851F42D4C957F2D)), window)[at]))],
                ["__id", "__row", "at", "h1", "h2"])
    return run


def intervals(positions: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal [start, end) word ranges covered by windows at sorted ``positions``."""
    if not len(positions):
        return []
    gap = np.flatnonzero(np.diff(positions) > window)
    starts = positions[np.concatenate([[0], gap + 1])]
    ends = positions[np.concatenate([gap, [len(positions) - 1]])] + window
    return list(zip(starts.tolist(), ends.tolist()))


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _remove(window: int):
    def run(batches):
        for b in blocks(batches, "__t"):
            w = Words(b.column("__t"))
            keep, spans = np.ones(len(w.starts), bool), []
            for i, at in enumerate(b.column("at")):
                found = intervals(np.sort(np.asarray(at.values.to_numpy(zero_copy_only=False), np.int64)), window)
                spans.append([{"start": s, "end": e} for s, e in found])
                for s, e in found:
                    keep[w.bounds[i] + s: w.bounds[i] + e] = False
            text, at = _kept_text(w, keep)
            raw = text.tobytes()
            kept = [raw[a: max(a, z - 1)].decode() for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
            gone = np.diff(np.concatenate([[0], np.cumsum(~keep)])[w.bounds])
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__row"), pa.array(gone), pa.array(spans, _SPANS), pa.array(kept, pa.string())],
                                             ["__id", "__row", "n_removed", "spans", "kept_text"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(profile, removed).

    profile: one row per row of ``docs``: __id, __row (hash of id and text), n_words,
    kept_sha256 of the untouched words. removed: one row per row that loses words: __id,
    __row, n_removed, spans (maximal word ranges), kept_text.

    A word goes if a window of ``window`` words over it also starts in a document with a
    smaller id (judged on the input). Null and empty texts have no words; rows with a null id
    keep everything and remove nothing elsewhere; rows with one id are one document (they do
    not remove each other); other columns are ignored whatever their names."""
    d = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t"))
    d = d.withColumn("__row", F.xxhash64("__id", "__t"))
    profile = store(d.mapInArrow(_profile(window, gram), "__id long, __row long, n_words long, kept_sha256 string, anchors array<long>"), "profile")
    # a document equal word for word to one with a smaller id loses every word, and whatever it
    # could remove, that one removes: such copies are settled before any window is counted
    long_enough = profile.where(F.col("__id").isNotNull() & (F.col("n_words") >= window))
    firsts = long_enough.groupBy(F.col("kept_sha256").alias("sha")).agg(F.min("__id").alias("lo"))
    placed = long_enough.join(firsts, F.col("kept_sha256") == F.col("sha"))
    copies = placed.where("__id > lo").select("__row", "__id", "n_words").distinct()
    anchors = placed.where("__id = lo").select("__id", "__row", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("__id").alias("lo"), F.max("__id").alias("hi")).where("lo < hi").select("anchor")
    hit = store(anchors.join(shared, "anchor").groupBy("__row", "__id").agg(F.collect_set("anchor").alias("anchors")), "shared")
    texts = maybe_in(d, hit, "__row").dropDuplicates(["__row", "__id"])
    texts = store(texts.join(hit, ["__row", "__id"]).select("__id", "__row", "__t", "anchors"), "repeating")
    windows = texts.mapInArrow(_windows(window, gram), "__id long, __row long, at int, h1 long, h2 long")
    first = windows.groupBy("h1", "h2").agg(F.min("__id").alias("lo"), F.max("__id").alias("hi")).where("lo < hi").select("h1", "h2", "lo")
    again = windows.join(first, ["h1", "h2"]).where("__id > lo")
    at = again.groupBy("__row", "__id").agg(F.collect_list("at").alias("at"))
    removed = store(texts.drop("anchors").join(at, ["__row", "__id"]).select("__id", "__row", "__t", "at")
                    .mapInArrow(_remove(window), "__id long, __row long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"), "removed")
    whole = copies.select("__id", "__row", F.col("n_words").alias("n_removed"),
                          F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).alias("spans"), F.lit("").alias("kept_text"))
    return profile.drop("anchors"), removed.union(whole)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id (the id column's name), n_words, n_removed, kept_sha256 and spans per row of ``docs``."""
    profile, removed = find(docs, **options)
    r = removed.select(F.col("__row").alias("__r"), F.col("__id").alias("__i"), "n_removed", "spans", F.sha2("kept_text", 256).alias("sha"))
    out = profile.join(r, (F.col("__row") == F.col("__r")) & F.col("__id").eqNullSafe(F.col("__i")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    return out.select(F.col("__id").alias(options.get("id_col", "doc_id")), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                      F.coalesce("sha", "kept_sha256").alias("kept_sha256"), F.coalesce("spans", none).alias("spans"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated passages taken out of the text; texts that lose nothing stay as they are.
    All other columns pass through, whatever their names."""
    given, (docs, (id_col, text_col)) = docs, set_aside(docs, id_col, text_col)
    _, removed = find(docs, id_col, text_col, **options)
    r = removed.select(F.col("__row").alias("__r"), F.col("__id").alias("__i"), "kept_text")
    d = docs.withColumn("__row", F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)))
    out = d.join(r, (F.col("__row") == F.col("__r")) & F.col(id_col).cast("long").eqNullSafe(F.col("__i")), "left")
    return named_back(out.withColumn(text_col, F.coalesce("kept_text", text_col)), given)
