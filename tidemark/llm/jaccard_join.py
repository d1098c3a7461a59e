"""N-gram Jaccard join with token-combination prefixes.

A text's tokens are its distinct 5-word shingles (hashes). Tokens are ordered rare first,
frequent last, each by hash. Two sets with Jaccard >= t share so much that

* the first token they share stands in the first d + 1 tokens of both, d = n - ceil(t n)
  being the most tokens a set can fail to share: rare tokens there are indexed singly;
* if that first shared token is a frequent one, all rare tokens are unshared, so at most
  e = d - (rare tokens) frequent ones are, and among the first shared frequent tokens two
  neighbours stand side by side in both sets. So the prefix is extended into the frequent
  tokens and side-by-side pairs of them (2-token combinations) are indexed, no single ones.

Rows of a key are linked to the key's smallest document only (a star, linear in the key's
rows; keys of frequent tokens are salted and their star has two levels), each such pair is
verified on the whole sets, and components are formed; a centre that has met all rows of its key
is done there, and further rounds do the same with another centre among the rows left, for the
keys that still hold several components. At last the documents of one
key that are still in different components meet pairwise: the join itself drops pairs whose
sizes or parity sketches rule the threshold out, the rest are verified, which makes the
components exact. Which tokens count as frequent and how many rounds run changes the work,
never the result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import FINE_BLOCK, Rolling, Words, blocks, components, frugal, maybe_in, mix, named_back, set_aside, signed, store
from tidemark.session import discard

SHINGLE, PERCENT = 5, 75
#: A token in this many documents or more is frequent (as far as blocks of a task show it).
FREQUENT = 16
#: At most this many frequent tokens are told to the tasks (2 MB); others are treated as rare.
MOST_FREQUENT = 1 << 18
SALTS = 8
#: Rounds with another centre per key, and longs of a parity sketch. Unlike sets differ in about
#: half its bits, which rules them out up to some 900 tokens each; sets of LARGE tokens or more
#: carry a second one of WIDE longs, good for some 3,500.
ROUNDS, SKETCH, WIDE, LARGE = 2, 8, 32, 600
#: Earlier keys of its set that a row carries into the last join.
PASSED = 8
_SHINGLES = {n: Rolling(0x9E3779B97F4A7C15 + 2 * n) for n in range(1, 65)}
_PAIR = np.uint64(0x2127599BF4325C37)
_U = np.uint64


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of each text. With fewer than ``k``
    words the whole sequence is one; without words the set is empty."""
    w = Words(column, fold_case=True)
    h = w.hashes()
    n = np.diff(w.bounds)
    each = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), each)
    at = np.arange(len(row)) + np.repeat(w.bounds[:-1] - (np.cumsum(each) - each), each)
    out = np.empty(len(row), _U)
    full = n[row] >= k
    rolled = _SHINGLES[k].windows(h, k)
    out[full] = rolled[at[full]]
    for size in np.unique(n[(n > 0) & (n < k)]).tolist():  # short texts: one token of another kind
        short = n[row] == size
        out[short] = mix(_SHINGLES[size].windows(h, size)[at[short]] + _U(size))
    ends = np.cumsum(each)
    for a, b in zip((ends - each).tolist(), ends.tolist()):
        out[a:b].sort()
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
    row, out = row[new], out[new]
    return out, np.searchsorted(row, np.arange(len(n) + 1))


def _count_tokens(k: int, block_tokens: int = 1_000_000):
    """Tokens that several texts of a task's block hold, with their count there."""
    def told(parts):
        token = np.concatenate(parts)
        parts.clear()
        token.sort()
        again = np.zeros(len(token) + 1, bool)   # equal to the one before
        again[1:-1] = token[1:] == token[:-1]
        first, last = np.flatnonzero(again[1:] & ~again[:-1]), np.flatnonzero(again[:-1] & ~again[1:])
        return pa.RecordBatch.from_arrays([pa.array(signed(token[first])), pa.array(last - first + 1)], ["token", "n"])

    @frugal
    def run(batches):
        parts, held = [], 0
        for b in blocks(batches, "__t", FINE_BLOCK):
            tokens, _ = shingle_sets(b.column("__t"), k)
            parts.append(tokens)
            held += len(tokens)
            if held >= block_tokens:
                yield told(parts)
                held = 0
        if parts:
            yield told(parts)
    return run


def frequent_tokens(d: DataFrame, k: int) -> np.ndarray:
    """The frequent tokens, at most MOST_FREQUENT (a bound on what is broadcast), sorted."""
    counts = d.mapInArrow(_count_tokens(k), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(MOST_FREQUENT).select("token")
    return np.sort(top.toPandas()["token"].to_numpy(np.int64).astype(np.int64).view(_U))


def prefix_keys(tokens: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, percent: int):
    """(row, key, salted) of every index entry of the sets."""
    n = np.diff(bounds)
    row = np.repeat(np.arange(len(n)), n)
    if len(frequent):
        near = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        often = frequent[near] == tokens
    else:
        often = np.zeros(len(tokens), bool)
    if often.any():                       # rare ones first; both stay in hash order
        order = np.argsort(2 * row + often, kind="stable")
        tokens, often = tokens[order], often[order]
    at = np.arange(len(tokens)) - bounds[row]
    d = n - (percent * n + 99) // 100
    rare = n - np.bincount(row[often], minlength=len(n))
    spare = d - rare                      # frequent tokens that may be unshared, if no rare one is shared
    single = (at <= d[row]) & (~often | (n[row] <= 4))
    other = (n * 100 // percent) - (percent * (n * 100 // percent) + 99) // 100   # the largest d of a partner
    reach = 2 * spare + other + 2
    place = at - rare[row]                # place among the frequent tokens
    pair = np.zeros(len(tokens), bool)
    pair[:-1] = often[:-1] & (row[1:] == row[:-1]) & (spare[row[:-1]] >= 0) & (place[:-1] + 1 < reach[row[:-1]])
    left = np.flatnonzero(pair)
    keys = np.concatenate([tokens[single], mix(tokens[left] * _PAIR + mix(tokens[left + 1]))])
    return np.concatenate([row[single], row[left]]), keys, np.concatenate([often[single], np.ones(len(left), bool)])


def _index(k: int, percent: int, frequent):
    @frugal
    def run(batches):
        hot = frequent.value
        for b in blocks(batches, "__t", FINE_BLOCK):
            tokens, bounds = shingle_sets(b.column("__t"), k)
            row, key, salted = prefix_keys(tokens, bounds, hot, percent)
            ids = b.column("__id").to_numpy(zero_copy_only=False)
            doc = ids[row]
            salt = np.where(salted, 1 + (mix(doc.astype(_U)) % _U(SALTS)).astype(np.int8), 0).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(salt), pa.array(doc), pa.array(np.diff(bounds)[row].astype(np.int32))],
                                             ["key", "salt", "doc", "n"])
    return run


def parity_bits(tokens: np.ndarray) -> bytes:
    """A bit vector of a power of two of bits, about one per token: each token flips one bit.
    Bits that differ between two sets each need a token that only one of them has."""
    width = max(64 * (WIDE if len(tokens) >= LARGE else SKETCH), 1 << int(len(tokens)).bit_length())
    odd = np.bincount((mix(tokens) & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """At least so many tokens stand in one of two sets only (the longer vector is folded)."""
    a, b = np.frombuffer(x, _U), np.frombuffer(y, _U)
    if len(a) < len(b):
        a, b = b, a
    a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def _profile(k: int):
    """Set size, a 128-bit signature of the set and its parity bits."""
    @frugal
    def run(batches):
        for b in blocks(batches, "__t", FINE_BLOCK):
            tokens, bounds = shingle_sets(b.column("__t"), k)
            sums = [np.concatenate([np.zeros(1, _U), np.cumsum(mix(tokens ^ s))]) for s in (_U(0x51), _U(0xC3A5))]
            s1, s2 = (signed(x[bounds[1:]] - x[bounds[:-1]]) for x in sums)
            at = bounds.tolist()
            bits = [parity_bits(tokens[x:y]) if y > x else b"" for x, y in zip(at[:-1], at[1:])]
            fold = lambda x, longs: np.bitwise_xor.reduce(np.frombuffer(x, np.int64).reshape(-1, longs), axis=0)
            short = [fold(x, SKETCH) if x else np.zeros(SKETCH, np.int64) for x in bits]
            flat = pa.array(np.concatenate(short) if short else np.empty(0, np.int64))
            sketch = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, SKETCH, dtype=np.int32)), flat)
            wide = pa.array([fold(x, WIDE) if m >= LARGE else None for x, m in zip(bits, np.diff(bounds).tolist())], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(s1), pa.array(s2), pa.array(bits, pa.binary()), sketch, wide],
                                             ["doc", "n", "s1", "s2", "bits", "sketch", "wide"])
    return run


def _may_link(percent: int):
    """Drop pairs whose sizes or parity bits rule the threshold out."""
    @frugal
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                n = part.column("n").to_numpy() + part.column("m").to_numpy()
                keep = np.zeros(part.num_rows, bool)
                for i, (x, y) in enumerate(zip(part.column("x"), part.column("y"))):
                    # intersection >= p/100 union  <=>  difference <= total * (100 - p) / (100 + p)
                    keep[i] = least_difference(x.as_buffer(), y.as_buffer()) * (100 + percent) <= int(n[i]) * (100 - percent)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])
    return run


def _sets(k: int):
    @frugal
    def run(batches):
        for b in blocks(batches, "__t", FINE_BLOCK):
            tokens, bounds = shingle_sets(b.column("__t"), k)
            raw, at = signed(tokens).tobytes(), (bounds * 8).tolist()
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array([raw[x:y] for x, y in zip(at[:-1], at[1:])], pa.binary())], ["doc", "tokens"])
    return run


def _verify(percent: int):
    @frugal
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                keep = np.zeros(part.num_rows, bool)
                for i, (x, y) in enumerate(zip(part.column("x"), part.column("y"))):
                    x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                    both = len(x) + len(y) - len(np.union1d(x, y))
                    keep[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])
    return run


def verified(pairs: DataFrame, d: DataFrame, profile: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets reach the threshold, stored: sizes and parity bits
    rule most others out, the rest are compared on the whole sets."""
    p = profile.where("n > 0")
    x = p.select(F.col("doc").alias("a"), F.col("n").alias("l"), F.col("bits").alias("x"))  # built as y, so one shuffle serves both
    y = p.select(F.col("doc").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    near = (pairs.join(x, "a").join(y, "b").where(sizes_allow("l", "m", percent))
            .select("a", "b", F.col("l").alias("n"), "m", "x", "y").mapInArrow(_may_link(percent), "a long, b long"))
    near = store(near.distinct(), "near-pairs")
    named = near.select(F.col("a").alias("__id")).union(near.select(F.col("b").alias("__id"))).distinct()
    sets = store(maybe_in(d, named, "__id").mapInArrow(_sets(k), "doc long, tokens binary"), "sets")
    x = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y"))
    links = (near.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"))
    links = store(links.distinct(), "links")
    discard(near, sets)
    return links


def profiles(docs: DataFrame, id_col: str, text_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(documents as (__id, __t), stored profile (doc, n, s1, s2, bits, sketch, wide) of every row)."""
    d = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__t"))
    return d, store(d.mapInArrow(_profile(k), "doc long, n long, s1 long, s2 long, bits binary, sketch array<long>, wide array<long>"), "profile")


def join(d: DataFrame, profile: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(links, component of each linked document): ``links(a, b)`` are pairs that reach the
    threshold and span every component (not all pairs within one), ``components(node, component)``.

    ``d`` and ``profile`` as :func:`profiles` gives them. Null, empty and blank texts have an
    empty set and link with nothing, nor do rows with a null id. Rows with one id are one node;
    equal sets are settled by their signature, and only the smallest id of them goes on. Very
    long texts are read whole, a block at a time. No rows: no links."""
    d = d.where(F.col("__id").isNotNull() & F.col("__t").isNotNull())
    profile = profile.where(F.col("doc").isNotNull() & (F.col("n") > 0))
    firsts = profile.groupBy("n", "s1", "s2").agg(F.min("doc").alias("first"))
    copies = store(profile.select("doc", "n", "s1", "s2").join(firsts, ["n", "s1", "s2"]).where("doc > first").select("doc", "first").distinct(), "copies")
    hot = d.sparkSession.sparkContext.broadcast(frequent_tokens(d, k))
    entries = d.mapInArrow(_index(k, percent, hot), "key long, salt byte, doc long, n int")
    group = Window.partitionBy("key", "salt")
    seen = entries.withColumns({"low": F.min("doc").over(group), "high": F.max("doc").over(group)})
    seen = seen.where("low < high or salt > 0").select("key", F.col("salt") > 0, "doc", "n").toDF("key", "often", "doc", "n")
    first = F.coalesce("first", "doc")
    seen = seen.join(copies, "doc", "left").select("key", F.when(F.col("often"), 1 + F.pmod(F.xxhash64(first), F.lit(SALTS))).otherwise(0).alias("salt"),
                                                   first.alias("doc"), "n").distinct()
    at = F.struct("doc", "n")
    seen = store(seen.withColumns({"low": F.min(at).over(group), "rows": F.count("*").over(group)}), "index")
    # salted keys: the salts' smallest documents meet once more
    tops = seen.where((F.col("salt") > 0) & (at == F.col("low"))).select("key", "doc", "n").distinct()
    tops = tops.withColumn("low", F.min(at).over(Window.partitionBy("key")))
    stars = seen.select("doc", "n", "low").union(tops.select("doc", "n", "low")).where("doc > low.doc")
    stars = stars.where(sizes_allow("n", "low.n", percent)).select(F.col("low.doc").alias("a"), F.col("doc").alias("b")).distinct()
    stars = store(stars, "stars")
    links = verified(stars, d, profile, k, percent).union(copies.select(F.col("first").alias("a"), F.col("doc").alias("b")))
    links = store(links.distinct(), "links")
    now, tested = components(links), stars
    # the centre of a key has met all its rows, and goes; so keys of two rows are done
    rest = seen.where((F.col("salt") > 0) | ((F.col("rows") > 2) & (at != F.col("low")))).select("key", "doc", "n")
    for r in range(ROUNDS):
        apart = still_apart(rest, now, r)
        if not r:
            discard(seen)
        pairs = apart.where(F.col("component") != F.col("centre.component")).where(sizes_allow("n", "centre.n", percent))
        pairs = pairs.select(F.least("doc", "centre.doc").alias("a"), F.greatest("doc", "centre.doc").alias("b"))
        pairs = store(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        links, now = extended(links, now, verified(pairs, d, profile, k, percent))
        tested = tested.union(pairs)
        rest = apart.where((F.col("doc") != F.col("centre.doc")) | (F.col("n") != F.col("centre.n"))).select("key", "doc", "n")
    # documents of one key that are still apart meet
    left = meeting(still_apart(rest, now, ROUNDS).drop("centre"), profile, percent).distinct()
    left = store(left.join(tested, ["a", "b"], "left_anti"), "rest")
    return extended(links, now, verified(left, d, profile, k, percent))


def meeting(apart: DataFrame, profile: DataFrame, percent: int) -> DataFrame:
    """(a, b): documents of different components that share a key of ``apart(key, doc, n,
    component)`` and that neither sizes nor sketches keep from the threshold. Alike sets share
    most of their keys, so a row carries the PASSED keys before its own among those of its set:
    where two rows have one of these in common, the pair meets there already. At the least key
    that two sets share none is, so no pair is lost."""
    earlier = Window.partitionBy("doc", "n").orderBy("key").rowsBetween(-PASSED, -1)
    apart = apart.withColumn("passed", F.array_remove(F.collect_list("key").over(earlier), F.col("key")))
    sketch = profile.select("doc", "n", "wide", *[F.get("sketch", i).alias(f"k{i}") for i in range(SKETCH)])
    apart = apart.join(sketch, ["doc", "n"])
    x, y = (apart.select(*[F.col(c).alias(f"{c}_{s}") for c in apart.columns]) for s in "xy")
    total, differ = F.col("n_x") + F.col("n_y"), sum(F.bit_count(F.col(f"k{i}_x").bitwiseXOR(F.col(f"k{i}_y"))) for i in range(SKETCH))
    may = ((F.col("component_x") < F.col("component_y")) & sizes_allow("n_x", "n_y", percent)
           & (differ * (100 + percent) <= total * (100 - percent)))
    wide = F.aggregate(F.zip_with("wide_x", "wide_y", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x)
    may = may & (F.col("wide_x").isNull() | F.col("wide_y").isNull() | (wide * (100 + percent) <= total * (100 - percent)))
    may = may & ~F.arrays_overlap("passed_x", "passed_y")
    return x.join(y, (F.col("key_x") == F.col("key_y")) & may).select(
        F.least("doc_x", "doc_y").alias("a"), F.greatest("doc_x", "doc_y").alias("b"))


def sizes_allow(n: str, m: str, percent: int):
    """Sets of ``n`` and ``m`` tokens can reach the threshold."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def extended(links: DataFrame, now: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links with ``more`` of them, and their components: ``now`` if there are none."""
    if more.isEmpty():
        return links, now
    merged = components(now.toDF("a", "b").union(more))
    return links.union(more).distinct(), merged


def still_apart(rest: DataFrame, now: DataFrame, r: int) -> DataFrame:
    """(key, doc, n, component, centre) of the keys of ``rest`` that hold several components,
    stored. ``centre`` (doc, n, component) is the row of the key that round ``r`` picks."""
    placed = rest.join(now.withColumnRenamed("node", "doc"), "doc", "left").select(
        "key", "doc", F.col("n").cast("long").alias("n"), F.coalesce("component", "doc").alias("component"))
    row = F.struct(F.xxhash64("doc", F.lit(r)).alias("h"), "doc", "n", "component")
    keys = placed.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.min(row).alias("centre"))
    return store(placed.join(keys.where("c1 < c2").select("key", "centre"), "key"), "apart")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
           percent: int = PERCENT) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links, itself included; null for
    a null id), one row per row of ``docs``."""
    d, profile = profiles(docs, id_col, text_col, k)
    _, found = join(d, profile, k, percent)
    out = profile.join(found.select(F.col("node").alias("doc"), "component"), "doc", "left")
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group left, that with the smallest id (all rows of it).
    Rows without an id, and null, empty or blank texts, all stay; other columns pass through,
    whatever their names."""
    given, (docs, (id_col, text_col)) = docs, set_aside(docs, id_col, text_col)
    _, found = join(*profiles(docs, id_col, text_col, options.get("k", SHINGLE)), **options)
    gone = found.where("component < node").select(F.col("node").alias("__gone"))
    return named_back(docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti"), given)
