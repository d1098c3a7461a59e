"""H5, H7, H1 as tables: a linear text model whose weights are rows (term, idf, weight).

Nothing as large as the vocabulary ever reaches the driver or a single task. Training solves the
regularised hinge loss (the linear support vector machine, min |w|^2 / 2 + C sum(loss)) by dual
coordinate ascent in shards: documents are dealt by hash into shards of a bounded number of
(document, term) values; each shard improves its own dual values against the weights of its own
terms, and the shards' changes of a term are added up by a grouped sum. One shard is solved by
one round; several take ``rounds`` rounds, each shard answering for its share of the change
(so the sum never overshoots; the loss comes within a few percent of the least one). Weights are those of :func:`textml.tfidf`; the intercept is the
weight of the term ''. Scoring joins the terms of a text with the table and sums per text."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .textml import MAX_BROADCAST_BYTES, by_frequency, dealt, one_each, row_counts, terms, tfidf_rows, word_counts

#: (document, term) values a shard holds at most, if its documents are not longer than that.
SHARD_VALUES = 1_000_000
BIAS = ""


class TextModel:
    """``weights(term, idf, weight)`` with the intercept as the term '', and the two numbers that
    turn a margin into a probability (None without calibration)."""

    def __init__(self, weights: DataFrame, text: str = "text", scale: tuple[float, float] | None = None):
        self.weights, self.text, self.scale = weights, text, scale

    def margins(self, df: DataFrame, keys: list[str] | None = None) -> DataFrame:
        """One row per distinct text: its 128-bit hash (_h1, _h2), or ``keys``, and the margin.
        Terms the model does not know count for nothing; a text without any known term, or a null
        one, has the intercept as its margin."""
        known = self.weights.where(F.col("term") != BIAS).select("term", "idf", "weight")
        # one field, null or not, as in tfidf_rows
        on = F.struct(*keys or [F.xxhash64(self.text).alias("_h1"), F.xxhash64(F.lit(1), self.text).alias("_h2")]).alias("_k")
        rows = df.select(on, F.col(self.text).alias("_c"))
        if not keys:
            found = rows.select("_k", F.explode(terms("_c")).alias("term")).groupBy("_k", "term").agg(F.count(F.lit(1)).alias("tf"))
        elif one_each(df, *keys):
            found = rows.select("_k", F.inline_outer(row_counts("_c")))
        else:
            found = word_counts(dealt(rows, "_c", "_k"), "_k", "_c")
        raw = F.col("tf") * F.col("idf")
        sums = lambda x: x.groupBy("_k").agg(F.sum(raw * F.col("weight")).alias("p"), F.sum(raw * raw).alias("q"))
        common, rare = by_frequency(known, F.floor(-F.col("idf") * 8), MAX_BROADCAST_BYTES)
        out = found.join(F.broadcast(common), "term")
        if rare is None:
            out = sums(out)
        else:
            left = found.where(F.col("term").isNotNull()).join(F.broadcast(common.select("term")), "term", "left_anti").join(rare, "term")
            out = sums(out).union(sums(left)).groupBy("_k").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        return out.select("_k.*", (F.col("p") / F.sqrt("q") + self.bias()).alias("margin"))

    def bias(self) -> Column:
        return F.coalesce(self.weights.where(F.col("term") == BIAS).select(F.max("weight")).scalar(), F.lit(0.0))

    def transform(self, df: DataFrame, id_col: str | None = None) -> DataFrame:
        """``df`` with margin, prediction (1.0 if the margin is positive, else 0.0) and, where the
        model is calibrated, the probability of class 1. With ``id_col`` (one text per id) the
        margins come back on the id, else on a hash of the text, so repeated texts agree."""
        if id_col:
            m = self.margins(df, [id_col]).withColumnRenamed(id_col, "_id")
            out = df.join(m, F.col(id_col).eqNullSafe(F.col("_id")), "left").drop("_id")
        else:
            d = df.withColumns({"_h1": F.xxhash64(self.text), "_h2": F.xxhash64(F.lit(1), self.text)})
            out = d.join(self.margins(df), ["_h1", "_h2"], "left").drop("_h1", "_h2")
        out = out.withColumn("margin", F.coalesce("margin", self.bias()))
        out = out.withColumn("prediction", (F.col("margin") > 0).cast("double"))
        if self.scale is None:
            return out
        a, b = self.scale
        return out.withColumn("probability", 1.0 / (1.0 + F.exp(-(F.col("margin") * a + b))))


DEALT = "shard int, at int, y double, copies double, norm double, cols array<int>, tfs array<int>, idfs array<double>, term string, idf double"
#: Blocks of terms at most, whose parts from all shards are added up together.
MAX_BLOCKS = 256


def _number(n_docs: int):
    """One shard's documents (id, y, copies, norm, terms, tfs, dfs) with its own numbers for its
    terms: a row of the terms' idf (at -1), a row per document in the order of their ids, and a
    row per term. The last term is the intercept's."""
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        # an order of the documents that does not depend on how rows arrived
        table = table.take(pa.array(np.argsort(np.asarray(table["id"].to_pylist(), object))))
        flat = lambda name: pc.list_flatten(table[name]).combine_chunks()
        ends = np.cumsum(np.asarray(pc.list_value_length(table["tfs"])))
        words = pc.list_flatten(pc.split_pattern(table["terms"].filter(pc.not_equal(table["terms"], "")), " ")).combine_chunks().dictionary_encode()
        cols = np.asarray(words.indices)
        df = np.zeros(len(words.dictionary))
        df[cols] = np.asarray(flat("dfs"))
        idfs = np.append(np.log((1.0 + n_docs) / (1.0 + df)) + 1.0, 1.0)
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        n, m = table.num_rows, len(idfs)
        parts = [{"at": pa.array([-1], pa.int32()), "idfs": pa.array([idfs], pa.list_(pa.float64()))},
                 {"at": pa.array(np.arange(n, dtype=np.int32)), **{c: table[c] for c in ("y", "copies", "norm")},
                  "cols": pa.ListArray.from_arrays(offsets, pa.array(cols, pa.int32())), "tfs": pa.ListArray.from_arrays(offsets, flat("tfs"))},
                 {"at": pa.array(np.arange(m, dtype=np.int32)), "term": pa.concat_arrays([words.dictionary.cast(pa.string()), pa.array([BIAS])]), "idf": pa.array(idfs)}]
        types = {"at": pa.int32(), **dict.fromkeys(("y", "copies", "norm"), pa.float64()), **dict.fromkeys(("cols", "tfs"), pa.list_(pa.int32())),
                 "idfs": pa.list_(pa.float64()), "term": pa.string(), "idf": pa.float64()}
        out = pa.concat_tables([pa.table({c: p.get(c, pa.nulls(len(p["at"]), t)) for c, t in types.items()}) for p in parts])
        return out.add_column(0, "shard", pa.array(np.full(out.num_rows, shard, np.int32)))
    return run


class _Shard:
    """A shard's documents as one sparse matrix (the intercept's 1 comes last in each), its terms'
    places (block, tid) in the vocabulary, its dual values, and the weights that came for its terms."""

    def __init__(self, docs: pa.Table, state: pa.Table):
        docs = docs.sort_by("at")
        places, idfs = docs.slice(0, 1), np.asarray(docs["idfs"][1].as_py())
        self.shard, docs = docs["shard"][0].as_py(), docs.slice(2)
        size = np.asarray(pc.list_value_length(docs["cols"])).astype(np.int64)
        flat = lambda table, name: np.asarray(pc.list_flatten(table[name]).combine_chunks())
        cols, tfs = flat(docs, "cols"), flat(docs, "tfs")
        norm = np.repeat(np.asarray(docs["norm"]), size)
        ends = np.cumsum(size)
        self.col, self.value = np.insert(cols, ends, len(idfs) - 1), np.insert(tfs * idfs[cols] / norm, ends, 1.0)
        self.first = ends - size + np.arange(len(size))
        self.ends = ends + np.arange(len(size)) + 1
        self.y, self.copies = np.asarray(docs["y"]), np.asarray(docs["copies"])
        self.block, self.tid = flat(places, "cols"), flat(places, "tfs")
        self.order = np.lexsort((self.tid, self.block))
        old = state.filter(pc.is_null(state["block"])) if state.num_rows else state
        self.alpha = np.array(old["w"][0].as_py()) if old.num_rows else np.zeros(len(size))
        self.w = np.zeros(len(idfs))
        sums = state.filter(pc.is_valid(state["block"])).sort_by("block") if state.num_rows else state
        if sums.num_rows:
            self.w[self.order] = flat(sums, "w")


def _parts(number: pa.DataType):
    """What a shard's dual values give its terms' weights (sum of alpha * y * value), one row a block."""
    def run(docs: pa.Table, state: pa.Table) -> pa.Table:
        x = _Shard(docs, state)
        part = np.bincount(x.col, np.repeat(x.alpha * x.y, x.ends - x.first) * x.value, len(x.w))[x.order]
        blocks, first = np.unique(x.block[x.order], return_index=True)
        offsets = pa.array(np.append(first, len(part)).astype(np.int32))
        return pa.table({"block": pa.array(blocks, pa.int32()), "shard": pa.array(np.full(len(blocks), x.shard, np.int32)),
                         "tids": pa.ListArray.from_arrays(offsets, pa.array(x.tid[x.order], pa.int32())),
                         "part": pa.ListArray.from_arrays(offsets, pa.array(part).cast(number, safe=False))})
    return run


def _sum(parts: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    parts = parts.sort_by("shard")
    tids = np.asarray(pc.list_flatten(parts["tids"]).combine_chunks())
    return tids, np.bincount(tids, np.asarray(pc.list_flatten(parts["part"]).combine_chunks(), float)), parts


def _back(number: pa.DataType):
    """The weights of a block's terms, to each shard those it sent a part of."""
    def run(parts: pa.Table) -> pa.Table:
        tids, w, parts = _sum(parts)
        offsets = np.append(0, np.cumsum(np.asarray(pc.list_value_length(parts["tids"])))).astype(np.int32)
        return pa.table({"shard": parts["shard"], "block": parts["block"], "w": pa.ListArray.from_arrays(pa.array(offsets), pa.array(w[tids]).cast(number, safe=False))})
    return run


def _weights(parts: pa.Table) -> pa.Table:
    tids, w, parts = _sum(parts)
    tids = np.unique(tids)
    return pa.table({"block": pa.array(np.full(len(tids), parts["block"][0].as_py(), np.int32)), "tid": pa.array(tids, pa.int32()), "weight": w[tids]})


def _solve(cost: float, epochs: int, shards: int, seed: int):
    """One shard's round: its documents, weights and dual values to new dual values."""
    def run(docs: pa.Table, state: pa.Table) -> pa.Table:
        x = _Shard(docs, state)
        w, old, y, most = x.w, x.alpha, x.y.tolist(), (cost * x.copies).tolist()
        length = (shards * np.add.reduceat(x.value * x.value, x.first)).tolist()
        rows = [(x.col[a:z], x.value[a:z]) for a, z in zip(x.first.tolist(), x.ends.tolist())]
        now = old.tolist()
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            moved = 0.0
            for i in rng.permutation(len(rows)).tolist():
                c, v = rows[i]
                new = min(max(now[i] + (1 - y[i] * float(w[c] @ v)) / length[i], 0.0), most[i])
                if new != now[i]:
                    w[c] += shards * (new - now[i]) * y[i] * v
                    moved += abs(new - now[i])
                    now[i] = new
            if moved < 1e-6 * len(rows):
                break
        return pa.table({"shard": pa.array([x.shard], pa.int32()), "block": pa.nulls(1, pa.int32()), "w": pa.array([now], pa.list_(pa.float64()))})
    return run


def _margins(docs: pa.Table, state: pa.Table) -> pa.Table:
    x = _Shard(docs, state)
    return pa.table({"y": x.y, "copies": x.copies, "m": np.add.reduceat(x.value * x.w[x.col], x.first)})


def linear_fit(train: DataFrame, text: str = "text", label: str = "label", cost: float = 1.0, rounds: int = 8, epochs: int = 30,
               calibrate: bool = False, seed: int = 42, shard_values: int = SHARD_VALUES) -> TextModel:
    """Fit on rows with a text and a label (class 1 if positive, else 0). Equal texts of one
    label count as one row with that many copies; rows with a null text or label are left out,
    an empty text has the intercept only. Reruns agree whatever the partitioning, up to the
    rounding of sums. Without any row the model is empty: every margin is 0.

    Documents go to their shards once, packed as numbers of the shard's terms, and stay there. As
    weights are sums over the dual values, only the latter are stored by a round; between rounds a
    shard sends one number a term to the term's block and gets the sum of all shards back (in
    single precision; the last sums, which are the model, in double)."""
    rows = train.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    y = F.when(F.col(label) > 0, 1.0).otherwise(-1.0)
    row_id = F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(1), text), y.cast("int"))
    docs = rows.groupBy(row_id.alias("id"), y.alias("y")).agg(F.count(F.lit(1)).cast("double").alias("copies"), F.any_value(text).alias("_text"))
    docs = materialize(docs, "labelled")
    n_docs = docs.count()
    x = tfidf_rows(docs.select(F.struct("id", "y", "copies").alias("doc"), "_text"), "doc", "_text")
    # terms hold no space, so that they can travel as one string
    x = materialize(x.select("doc.*", "norm", F.array_join("items.term", " ").alias("terms"), *[F.col(f"items.{a}").cast("array<int>").alias(f"{a}s") for a in ("tf", "df")]), "tfidf")
    n = x.agg(F.sum(F.size("tfs") + 1)).first()[0] or 0
    shards = max(1, math.ceil(n / shard_values))
    at_shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    both = materialize(x.withColumn("shard", at_shard).repartition(shards, "shard").groupBy("shard").applyInArrow(_number(n_docs), DEALT), "shards")
    words = both.where(F.col("term").isNotNull()).select(F.col("shard").alias("shard"), F.col("at").alias("at"), "term", "idf")
    block = F.pmod(F.xxhash64("term"), F.lit(min(shards, MAX_BLOCKS))).cast("int")
    vocabulary = words.groupBy("term").agg(F.max("idf").alias("idf")).withColumn("block", block)
    vocabulary = materialize(vocabulary.withColumn("tid", F.row_number().over(Window.partitionBy("block").orderBy("term")) - 1), "vocabulary")
    places = words.select("shard", "at", "term").join(vocabulary.drop("idf"), "term").groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("at", "block", "tid"))).alias("p"))
    packed = both.where(F.col("term").isNull()).drop("term", "idf").unionByName(
        places.select("shard", F.lit(-2).alias("at"), F.col("p.block").alias("cols"), F.col("p.tid").alias("tfs")), allowMissingColumns=True)
    packed = packed.repartition(shards, "shard").sortWithinPartitions("shard").persist(StorageLevel.DISK_ONLY)
    spark, at_shards = docs.sparkSession, packed.groupBy("shard")
    state = alphas = spark.createDataFrame([], "shard int, block int, w array<double>")

    def parts(number):
        kind = "float" if number == pa.float32() else "double"
        return kind, at_shards.cogroup(alphas.groupBy("shard")).applyInArrow(_parts(number), f"block int, shard int, tids array<int>, part array<{kind}>").groupBy("block")

    def sums(number):
        kind, sent = parts(number)
        return sent.applyInArrow(_back(number), f"shard int, block int, w array<{kind}>").withColumn("w", F.col("w").cast("array<double>")).union(alphas)
    try:
        for r in range(rounds if shards > 1 else 1):
            state = sums(pa.float32()) if r else alphas
            alphas = materialize(at_shards.cogroup(state.groupBy("shard")).applyInArrow(_solve(cost, epochs, shards, seed + r), "shard int, block int, w array<double>"), "alphas")
        weights = parts(pa.float64())[1].applyInArrow(_weights, "block int, tid int, weight double")
        table = materialize(weights.join(vocabulary, ["block", "tid"]).select("term", "idf", "weight"), "text-model")
        if calibrate:
            margins = materialize(at_shards.cogroup(sums(pa.float64()).groupBy("shard")).applyInArrow(_margins, "y double, copies double, m double"), "margins")
    finally:
        packed.unpersist()
    return TextModel(table, text, calibration(margins) if calibrate else None)


def calibration(margins: DataFrame, steps: int = 25) -> tuple[float, float]:
    """(a, b) of probability = 1 / (1 + exp(-(a m + b))) for rows (m, y, copies), by Newton steps
    with halving; each step brings six sums to the driver. The labels are drawn in by one part in
    (class size + 2), so that separable margins have an end."""
    size = {r["y"]: r["n"] for r in margins.groupBy("y").agg(F.sum("copies").alias("n")).collect()}
    pos, neg = size.get(1.0, 0.0), size.get(-1.0, 0.0)
    t = F.when(F.col("y") > 0, (pos + 1) / (pos + 2)).otherwise(1 / (neg + 2))
    a, b = 1.0, 0.0

    def sums(a, b):
        z = F.col("m") * a + b
        p = 1.0 / (1.0 + F.exp(-z))
        loss = F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - t * z
        q, c, m = p * (1.0 - p), F.col("copies"), F.col("m")
        return [x or 0.0 for x in margins.agg(*[F.sum(c * e) for e in (loss, (p - t) * m, p - t, q * m * m, q * m, q)]).first()]
    now = sums(a, b)
    for _ in range(steps):
        loss, ga, gb, haa, hab, hbb = now
        det = (haa + 1e-9) * (hbb + 1e-9) - hab * hab
        if abs(ga) + abs(gb) < 1e-6 * (1 + pos + neg) or det <= 0:
            break
        da, db = ((hbb + 1e-9) * ga - hab * gb) / det, ((haa + 1e-9) * gb - hab * ga) / det
        rate = 1.0
        while rate > 1e-4:
            then = sums(a - rate * da, b - rate * db)
            if then[0] <= loss:
                break
            rate /= 2
        else:
            break
        a, b, now = a - rate * da, b - rate * db, then
    return a, b
