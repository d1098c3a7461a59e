"""Embedding near-dedup on a robust-pruned flat graph.

Distinct vectors are dealt to overlapping cluster shards (each goes to its nearest centroids),
every shard builds a robust-pruned neighbour graph, the adjacency lists of a vector are united
over its shards, and every vector then searches the shards it was dealt to: greedily from the
shard's medoid, and from the first hit on it expands whatever lies in range. Vectors with an id
divisible by 50 (a bounded number) are compared with all rows; where the search finds too few
of their links, it is done again with more overlap. Hits are verified by the
cosine in double precision. Every vector found linked then counts its links exactly, over all
cells that a link can reach, in blocks; so do the vectors these turn up, and those of shards
too large for a graph. Only links between two vectors that the search finds linked with nothing
can be missed; the recall of what was counted is reported by the same audit."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, store

SAME = 0.9
#: Numbers in a block of the exact count (rows x dimensions), and cells in a region.
BLOCK_VALUES, REGION_CELLS = 1 << 19, 8
ASKED, GIVEN, EDGE = 0, 1, 2


def unit_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, h1, h2, ok): a 128-bit hash of each vector, and whether it can link at all."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    norm = F.aggregate(v, F.lit(0.0), lambda a, x: a + F.abs(x))
    ok = F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & (norm > 0)
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(ok, F.lit(False)).alias("ok"),
                     F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"))


def normalise(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return normalise(flat.reshape(len(column), -1))


def centroids(sample: np.ndarray, k: int, rounds: int = 6, seed: int = 5) -> np.ndarray:
    """Spherical k-means of a bounded sample."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(sample[i: i + 4096] @ c.T).argmax(1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
    return c


def prune(near: np.ndarray, sims: np.ndarray, x: np.ndarray, degree: int, alpha: float) -> list[int]:
    """Robust pruning of candidates (nearest first): one is dropped if a kept one is closer to
    it, by the factor ``alpha``, than the node itself."""
    own = 2 - 2 * sims
    between = 2 - 2 * (x[near] @ x[near].T)
    alive, out = np.ones(len(near), bool), []
    for i in range(len(near)):
        if not alive[i]:
            continue
        out.append(int(near[i]))
        if len(out) == degree:
            break
        alive &= ~(alpha * alpha * between[i] <= own)
    return out


def build_graph(x: np.ndarray, degree: int, wide: int, alpha: float) -> list[list[int]]:
    """Adjacency of a shard: its nearest ``wide`` pruned, then reverse edges, pruned again
    where a node has too many."""
    n = len(x)
    links: list[set[int]] = [set() for _ in range(n)]
    for at in range(0, n, 512):
        s = x[at: at + 512] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        m = min(wide, n - 1)
        if not m:
            continue
        top = np.argpartition(-s, m - 1, axis=1)[:, :m]
        for r in range(len(s)):
            near = top[r][np.argsort(-s[r, top[r]], kind="stable")]
            links[at + r].update(prune(near, s[r, near], x, degree, alpha))
    reverse: list[list[int]] = [[] for _ in range(n)]
    for a, out in enumerate(links):
        for b in out:
            reverse[b].append(a)
    for b in range(n):
        links[b].update(reverse[b])
        if len(links[b]) > 2 * degree:
            near = np.array(sorted(links[b]))
            s = x[near] @ x[b]
            order = np.argsort(-s, kind="stable")
            links[b] = set(prune(near[order], s[order], x, 2 * degree, alpha))
    return [sorted(out) for out in links]


def range_search(q: np.ndarray, x: np.ndarray, graph: list[np.ndarray], start: int, beam: int, least: float) -> np.ndarray:
    """Nodes with similarity >= ``least``: greedy best-first from ``start`` with a beam, then
    every node in range is expanded until no new one turns up."""
    seen = np.zeros(len(x), bool)
    seen[start] = True
    nodes, sims = np.array([start]), np.array([x[start] @ q])
    done = np.zeros(len(x), bool)
    hits = []
    while True:
        todo = nodes[~done[nodes]]
        if not len(todo):
            break
        best = todo[:1] if sims[~done[nodes]][0] < least else nodes[(~done[nodes]) & (sims >= least)]
        done[best] = True
        new = np.unique(np.concatenate([graph[b] for b in best])) if len(best) else nodes[:0]
        new = new[~seen[new]]
        seen[new] = True
        nodes, sims = np.concatenate([nodes, new]), np.concatenate([sims, x[new] @ q])
        order = np.argsort(-sims, kind="stable")
        nodes, sims = nodes[order], sims[order]
        inside = int((sims >= least).sum())
        hits, keep = nodes[:inside], max(beam, inside)
        nodes, sims = nodes[:keep], sims[:keep]
    return hits


def _shard_graph(degree: int, wide: int, alpha: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        x = normalise(np.stack(pdf["v"].to_numpy()))
        graph = build_graph(x, degree, wide, alpha)
        return pd.DataFrame({"id": ids, "near": [ids[g].tolist() for g in graph]})
    return run


def _shard_search(beam: int, least: float):
    """Ids of the vectors that have a link in a shard: each searches every shard that it is dealt to."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy()
        x = normalise(np.stack(pdf["v"].to_numpy()))
        place = {int(i): p for p, i in enumerate(ids)}
        graph = [np.array(sorted({place[int(j)] for j in near if int(j) in place}), np.int64) for near in pdf["near"]]
        medoid = int((x @ x.mean(0)).argmax())
        linked = np.zeros(len(ids), bool)
        for p in range(len(ids)):
            if linked[p]:
                continue
            found = range_search(x[p], x, graph, medoid, beam, least)
            found = found[found != p]
            found = found[(x[found] * x[p]).sum(1) >= least]
            linked[found] = True
            linked[p] = len(found) > 0
        return pd.DataFrame({"id": ids[linked]})
    return run


def _place(shared, overlap: int):
    """Deals each vector to the shards of its ``overlap`` nearest centroids; the nearest is its home."""
    def run(batches):
        for b in batches:
            dims = b.column(3).to_numpy()
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                c, region = shared.value[d]
                s = _matrix(part.column(1)) @ c.T
                near = np.argsort(-s, axis=1, kind="stable")[:, : min(overlap, len(c))]
                for rank in range(near.shape[1]):
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near[:, rank].astype(np.int32)), pa.array(region[near[:, rank]]),
                                                      pa.array(np.full(len(near), rank == 0))], [*part.schema.names, "shard", "region", "home"])
    return run


def _reach(shared, least: float):
    """Adds to each vector the regions that may hold a vector with similarity >= ``least``: one
    in cell j lies beyond the bisector of j and the vector's own cell, so the vector is no
    farther from it than from the other vector."""
    far = math.sqrt(max(0.0, 2 - 2 * least))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                dims = part.column(3).to_numpy()
                for d in np.unique(dims).tolist():
                    rows = part.filter(pa.array(dims == d))
                    c, region = shared.value[d]
                    s, own = _matrix(rows.column(1)) @ c.T, rows.column(4).to_numpy()
                    mine = c[own]
                    gap = np.sqrt(np.maximum(0, (mine * mine).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * mine @ c.T))
                    open_ = s[np.arange(len(s)), own][:, None] - s <= far * gap + 1e-6
                    to = [np.unique(region[o]).tolist() for o in open_]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(to, pa.list_(pa.int32()))], [*rows.schema.names, "to"])
    return run


def _block_counts(least: float):
    """Of a block of asking vectors and one of others: how many each asking one links with
    (ASKED), how many links it gives the others (GIVEN), and edges (a, b) that connect whatever
    is linked (EDGE)."""
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        asks = t.column("asks").to_numpy()
        def side(mask):
            part = t.filter(pa.array(mask))
            if not part.num_rows:
                return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 1))
            return part.column("id").to_numpy(), part.column("n").to_numpy(), _matrix(part.column("v").combine_chunks())
        ids, n, x = side(asks)
        others, m, y = side(~asks)
        out = [(ids[:0], ids[:0], ids[:0], 0)]
        given, label = np.zeros(len(others), np.int64), np.arange(len(others))
        if len(ids) and len(others):
            order = np.argsort(others)
            others, m, y = others[order], m[order], y[order]
            thin, slack = y.astype(np.float32).T, max(1e-5, 3e-7 * y.shape[1])
            for at in range(0, len(ids), 512):
                q = x[at: at + 512]
                s = q.astype(np.float32) @ thin
                hit = s >= least + slack
                r, c = np.nonzero((s >= least - slack) & ~hit)
                for low in range(0, len(r), 1 << 14):
                    i, j = r[low: low + (1 << 14)], c[low: low + (1 << 14)]
                    hit[i, j] = (q[i] * y[j]).sum(1) >= least
                own = np.minimum(np.searchsorted(others, ids[at: at + 512]), len(others) - 1)
                same = np.flatnonzero(others[own] == ids[at: at + 512])
                hit[same, own[same]] = False
                got = np.array([m[h].sum() for h in hit], np.int64)
                out.append((ids[at: at + 512], got, got, ASKED))
                for k in np.flatnonzero(got).tolist():
                    found = np.flatnonzero(hit[k])
                    given[found] += n[at + k]
                    seen, first = np.unique(label[found], return_index=True)
                    if len(seen) > 1:
                        label[np.isin(label, seen)] = seen[0]
                    out.append((np.full(len(first), ids[at + k]), others[found[first]], first, EDGE))
            some = given > 0
            out.append((others[some], given[some], given[some], GIVEN))
        kind = np.repeat([o[3] for o in out], [len(o[0]) for o in out])
        return pa.table({k: np.concatenate([o[i] for o in out]) for i, k in enumerate(("a", "b", "n"))} | {"kind": kind.astype(np.int32)})
    return run


def true_links(classes: DataFrame, least: float, queries: int) -> DataFrame:
    """(id, n_true), stored: the links of at most ``queries`` vectors whose id is divisible by 50, by brute force
    against all rows in blocks. They are picked by another hash than the sample that the centroids are fitted on."""
    picked = (classes.where(F.pmod(F.col("id"), F.lit(50)) == 0).orderBy(F.xxhash64("id", F.lit(50)), "id").limit(queries)
              .select("id", "d", "v").collect())
    if not picked:
        return classes.sparkSession.createDataFrame([], "id long, n_true long")
    by_length = {}
    for r in picked:
        by_length.setdefault(r["d"], []).append(r)
    shared = classes.sparkSession.sparkContext.broadcast(
        {d: (np.array([r["id"] for r in rows]), normalise(np.array([r["v"] for r in rows]))) for d, rows in by_length.items()})

    def count(batches):
        total = {d: np.zeros(len(own), np.int64) for d, (own, _) in shared.value.items()}
        for b in batches:
            dims = b.column(3).to_numpy()
            for d in set(dims.tolist()) & set(total):
                own, q = shared.value[d]
                part = b.filter(pa.array(dims == d))
                ids, n = part.column(0).to_numpy(), part.column(2).to_numpy()
                for at in range(0, part.num_rows, 2048):
                    hit = (q @ _matrix(part.column(1).slice(at, 2048)).T >= least) & (own[:, None] != ids[None, at: at + 2048])
                    total[d] += (hit * n[None, at: at + 2048]).sum(1)
        for d, (own, _) in shared.value.items():
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[d])], ["id", "n_true"])

    return store(classes.select("id", "v", "n", "d").mapInArrow(count, "id long, n_true long").groupBy("id").agg(F.sum("n_true").alias("n_true")), "audit")


def share_found(true: DataFrame, found: DataFrame) -> float:
    """Of the audited vectors that have links, the share among ``found(id)``."""
    both = (true.where("n_true > 0").join(found.select("id").distinct().withColumn("hit", F.lit(1)), "id", "left")
            .agg(F.sum("hit").alias("got"), F.count("*").alias("all")).first())
    return (both["got"] or 0) / both["all"] if both["all"] else 1.0


def audit(true: DataFrame, counts: DataFrame) -> float:
    """Recall: of the links of the audited vectors, the share that ``counts(id, links)`` has."""
    both = true.join(counts.select("id", "links"), "id").agg(F.sum(F.least("n_true", "links")).alias("got"), F.sum("n_true").alias("all")).first()
    return 1.0 if not both["all"] else both["got"] / both["all"]


def _exact(asking: DataFrame, homes: DataFrame, regions: DataFrame, shared, least: float, names: str) -> DataFrame:
    """Counts of the ``asking`` vectors against all of ``homes`` that a link can reach, one task
    for each pair of blocks (a region's parts)."""
    wanted = store(asking.select("id", "v", "n", "d", "shard", "region", "part")
                   .mapInArrow(_reach(shared, least), f"{names}, part int, to array<int>"), "reach")
    of = [F.col("region").alias("qr"), F.col("part").alias("qp")]
    key = ["d", "qr", "qp", "region", "part"]
    spread = lambda q: (q.join(regions, ["d", "region"])
                        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
    pairs = spread(wanted.select("d", *of, F.explode("to").alias("region")).distinct())
    left = spread(wanted.select("d", *of, "id", "n", "v", F.explode("to").alias("region"))).select(*key, "id", "n", "v", F.lit(True).alias("asks"))
    right = homes.join(pairs, ["d", "region", "part"]).select(*key, "id", "n", "v", F.lit(False).alias("asks"))
    return left.union(right).groupBy(*key).applyInArrow(_block_counts(least), "a long, b long, n long, kind int")


def dedup(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = SAME, per_shard: int = 1000,
          overlap: int = 4, degree: int = 24, wide: int = 64, alpha: float = 1.2, beam: int = 32, sample_rows: int = 20_000,
          audit_queries: int = 1000, aim: float = 0.95, most_overlap: int = 32) -> DataFrame:
    """id, n_links, component_id, kept and audit_recall, one row per row of ``df``.

    n_links: other rows found with cosine >= ``least``; component_id: smallest id reachable by
    links; kept: the row's id is that one. All links of a vector that the graph search or
    another vector's count finds linked are counted, however large its group. Equal vectors are
    one node of the graph (all their links count). Null, zero and non-finite vectors and null ids link with nothing; vectors of
    different lengths never link. Repeated ids are rows of one node. Centroids are fitted on at
    most ``sample_rows`` vectors; every vector is indexed and searched, or counted without a
    search where its shard has over 4 * ``overlap`` * ``per_shard`` vectors. Where the search finds
    fewer than ``aim`` of the audited vectors that have links (at most ``audit_queries`` with an id
    divisible by 50), it is done again with twice the overlap, up to ``most_overlap``; if the audit
    of all counted links stays under 0.9, RuntimeError."""
    rows = store(unit_vectors(df, id_col, vec_col), "vectors")
    good = rows.where("ok").withColumn("d", F.size("v"))
    classes = store(good.groupBy("d", "h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v")), "classes")
    sizes = {r["d"]: r["count"] for r in classes.groupBy("d").count().collect()}
    parts = {}
    for d, n in sizes.items():
        k = max(1, math.ceil(n / per_shard))
        sample = classes.where(F.col("d") == d).orderBy(F.xxhash64("id"), "id").limit(min(sample_rows, 64 * k)).select("v").toPandas()
        x = normalise(np.stack(sample["v"].to_numpy()))
        c = centroids(x, min(k, len(x)))
        over = centroids(c, max(1, len(c) // REGION_CELLS))
        parts[d] = c, (c @ over.T).argmax(1).astype(np.int32)
    shared = df.sparkSession.sparkContext.broadcast(parts)

    names = "id long, v array<double>, n long, d int, shard int, region int"
    true = true_links(classes, least, audit_queries)
    while True:
        dealt = store(classes.select("id", "v", "n", "d").mapInArrow(_place(shared, overlap), f"{names}, home boolean"), "shards")
        large = store(dealt.groupBy("d", "shard").count().where(F.col("count") > 4 * overlap * per_shard).select("d", "shard"), "large-shards")
        small = dealt.join(F.broadcast(large), ["d", "shard"], "left_anti")
        lists = small.groupBy("d", "shard").applyInPandas(_shard_graph(degree, wide, alpha), "id long, near array<long>")
        graph = store(lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
        found = small.join(graph, "id").groupBy("d", "shard").applyInPandas(_shard_search(beam, least), "id long")
        unsearched = dealt.where("home").join(F.broadcast(large), ["d", "shard"]).select("id")
        ask = store(found.union(unsearched).distinct(), "asking")
        if share_found(true, ask) >= aim or overlap >= min(most_overlap, max((len(c) for c, _ in parts.values()), default=1)):
            break
        overlap *= 2

    regions = (dealt.where("home").groupBy("d", "region").count()
               .select("d", "region", F.ceil(F.col("count") * F.col("d") / F.lit(BLOCK_VALUES)).cast("int").alias("parts")))
    regions = store(regions, "regions")
    homes = dealt.where("home").join(regions, ["d", "region"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    asked = counted = None
    while not ask.isEmpty():
        counted_now = store(_exact(homes.join(ask, "id"), homes, regions, shared, least, names), "counted")
        counted = counted_now if counted is None else counted.union(counted_now)
        asked = ask if asked is None else asked.union(ask)
        ask = store(counted.where(F.col("kind") == GIVEN).select(F.col("a").alias("id")).distinct().join(asked, "id", "left_anti"), "asking")
    if counted is None:
        counted = df.sparkSession.createDataFrame([], "a long, b long, n long, kind int")
    total = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")))
    counts = counted.where(F.col("kind") != EDGE).groupBy(F.col("a").alias("id")).agg(F.coalesce(total(ASKED), total(GIVEN)).alias("links"))
    counts = store(classes.select("id").join(counts, "id", "left").select("id", F.coalesce("links", F.lit(0)).cast("long").alias("links")), "link-counts")
    links = counted.where(F.col("kind") == EDGE).select("a", "b")
    recall = audit(true, counts)
    if recall < 0.9:
        raise RuntimeError(f"recall {recall:.3f} of the audited vectors' links: raise sample_rows, beam or most_overlap")
    groups = components(links)
    node = (classes.select("d", "h1", "h2", "id", "n").join(counts, "id", "left")
            .join(groups.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("d").alias("d2"), F.col("h1").alias("g1"), F.col("h2").alias("g2"),
                    (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    out = rows.withColumn("d", F.when(F.col("ok"), F.size("v"))).join(
        node, (F.col("d") == F.col("d2")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).cast("long").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
                      F.lit(float(recall)).alias("audit_recall"))
