"""URL filters, mixing, vector dedup, components, and the pipeline."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_url_rules_and_model(spark):
    from tidemark.llm import url_filters as U
    rows = [(0, "http://Example.COM/en/x?y#z"), (1, "https://www.example.com/en/1"), (2, "http://a.b.net/es/"), (3, "http://net/es"),
            (4, "http://examplecom/"), (5, None), (6, "no scheme"), (7, "http://"), (8, "x://É.com#f"), (9, "http://m.www.example.com/en/"),
            (10, "a://b://c.com/"), (11, "http://shop.org/es/1"), (12, "http://shop.org/de/1"), (None, ""), (0, "http://Example.COM/en/x?y#z")]
    rows += [(100 + i, f"http://h{i}.net/{'es' if i % 2 else 'de'}/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("__host", F.lit(1)).withColumn("verdict", F.lit("old"))
    labels = U.labelled_by_rules(pages).union(spark.createDataFrame([(f"http://h{i}.net/de/{i}", 0) for i in range(0, 60, 2)], "url string, label int"))
    out = U.judge(pages, U.fit(labels))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert out.count() == len(rows) and "__host" in out.columns
    assert got[0] == ("example.com", "/en/x", "example.com/en/", "block")
    assert got[1][2:] == ("www.example.com/en/", "allow") and got[9][2:] == ("www.example.com/en/", "allow")
    assert got[2][2:] == ("net/es/", "block") and got[3] == ("net", "/es", None, got[3][3])
    assert got[4][2] is None and got[8][:3] == ("É.com", "", None) and got[10][:3] == ("b:", "//c.com/", None)
    assert got[5][:3] == got[6][:3] == got[7][:3] == ("", "", None)
    assert got[11][3] == "block" and got[12][3] == "allow"
    assert U.judge(pages.where("page_id = -1"), 0.0).count() == 0
    assert {r["verdict"] for r in U.judge(pages.where("page_id = 12"), U.fit(labels.where("false"))).collect()} == {"allow"}


def test_url_sample_counts_distinct_urls(spark):
    from tidemark.llm import url_filters as U
    urls = spark.createDataFrame([(f"http://h{i}.org/p/{i}",) for i in range(10)], "url string")
    first = urls.orderBy(F.xxhash64(U.host_of(F.col("url")), U.path_of(F.col("url")))).first()["url"]
    rows = [(r["url"], int(r["url"] == first)) for r in urls.collect()] + [(f"{first}?{i}", 1) for i in range(50)]
    assert not isinstance(U.fit(spark.createDataFrame(rows, "url string, label int"), max_rows=5), float)


def waterfill(sizes, weights, most):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not full:
            target.update({s: level * w[s] for s in open_})
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target


def test_mixing_hits_its_targets(spark):
    from tidemark.llm import mixing
    r = random.Random(5)
    rows = [(i, r.choice(["a", "a", "a", "b", "c", "é", "Z", None]), " ".join("w" * r.randrange(1, 5) for _ in range(r.randrange(0, 40)))) for i in range(600)]
    rows += [(700, "tiny", "one two"), (701, "none", ""), (702, "none", None), (None, "a", "x y z"), (5, "a", "twice"), (5, "a", "twice")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    want = waterfill(sizes, mixing.WEIGHTS, 3)
    outs = [sorted(map(str, mixing.mix_sizes(df, rows_per_bucket=n).collect())) for n in (7, 20_000)]
    assert outs[0] == outs[1] and len(outs[0]) == len(rows)
    taken = defaultdict(int)
    for x in mixing.mix_sizes(df.repartition(3)).collect():
        taken[x["source"]] += x["taken"]
        assert 0 <= x["taken"] <= 3 * x["size"] and x["source_size"] == sizes[x["source"]]
        assert math.isclose(x["target"], want[x["source"]], rel_tol=1e-9, abs_tol=1e-9)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    words = defaultdict(int)
    for x in mixed.collect():
        words[x["source"]] += len(x["text"].split())
    assert all(words[s] == taken[s] for s in want)
    assert mixing.mix_sizes(df.where("doc_id = -1")).count() == 0


def test_components(spark):
    from tidemark.llm.common import components
    r = random.Random(1)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {}
    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in links if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_need_no_round(spark, monkeypatch):
    from tidemark.llm import common
    names, store = [], common.store
    monkeypatch.setattr(common, "store", lambda df, name: names.append(name) or store(df, name))
    links = [(1, k) for k in range(2, 30)] + [(40, 41), (42, 40), (41, 40)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 30), 1), 40: 40, 41: 40, 42: 40} and names == ["links"]


def test_stored_tables_need_no_schema_job_and_can_be_discarded(spark):
    from tidemark import session
    sc = spark.sparkContext
    ran = lambda: sc._jsc.sc().dagScheduler().numTotalJobs()
    before = ran()
    t = session.materialize(spark.range(5).selectExpr("id", "array(id) as ids"), "kept")
    assert ran() - before == 1 and t.count() == 5
    other = session.materialize(spark.range(3), "other")
    n = len(session._TABLES)
    session.discard(t)
    assert len(session._TABLES) == n - 1 and other.count() == 3


def test_vector_dedup_matches_brute_force(spark):
    from tidemark.llm import vector_dedup
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 16))
    near = base[:40].repeat(5, axis=0) + rng.normal(size=(200, 16)) * 0.12
    x = np.concatenate([base, near, base[:10], base[:1].repeat(30, axis=0)])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [1.0, None] * 8), (9004, [1.0]), (9005, [float("inf")] + [1.0] * 15), (9006, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    got = {r["vec_id"]: r for r in vector_dedup.dedup(df, per_shard=150).collect()}
    assert len(got) == len(rows) + len(odd)
    n = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (n <= linked.sum(1)).all() and n.sum() >= 0.97 * linked.sum() and got[0]["audit_recall"] >= 0.95
    for i, _ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    for i in range(len(x)):
        assert got[i]["kept"] == (got[i]["component_id"] == i)
    assert vector_dedup.dedup(df.where("vec_id < 0")).count() == 0


def test_vector_dedup_counts_groups_larger_than_shards(spark):
    from tidemark.llm import vector_dedup
    rng = np.random.default_rng(3)
    base = rng.normal(size=(3, 16))
    group = base[0] + rng.normal(size=(600, 16)) * 0.17 * np.linalg.norm(base[0]) / 4
    scaled = base[1] * rng.uniform(1, 2, size=(500, 1))         # one direction: all in one shard
    x = np.concatenate([rng.normal(size=(300, 16)), group, scaled])
    x = x[rng.permutation(len(x))]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([(i - 5, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"] + 5: r for r in vector_dedup.dedup(df, per_shard=50).collect()}
    many = linked.sum(1) >= 100
    assert many.sum() > 900 and len(got) == len(x)
    assert [got[i]["n_links"] for i in np.flatnonzero(many)] == linked.sum(1)[many].tolist()
    low = np.arange(len(x))
    for _ in range(20):
        low = np.minimum(low, np.where(linked, low[None], len(x)).min(1))
    assert all(got[i]["component_id"] == low[i] - 5 for i in np.flatnonzero(many))
    assert got[0]["audit_recall"] >= 0.99


def test_vector_dedup_finds_isolated_pairs_across_shards(spark):
    from tidemark.llm import vector_dedup
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    a = unit(rng.normal(size=(2000, 48)))
    side = rng.normal(size=a.shape)
    side = unit(side - (side * a).sum(1, keepdims=True) * a)
    x = np.concatenate([a, 0.905 * a + np.sqrt(1 - 0.905 ** 2) * side])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    linked = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    # one shard a vector at first: the audit must notice and raise the overlap
    got = {r["vec_id"]: r for r in vector_dedup.dedup(df, per_shard=100, overlap=1).collect()}
    n = np.array([got[i]["n_links"] for i in range(len(x))])
    recall = n.sum() / linked.sum()
    assert (n <= linked.sum(1)).all() and recall >= 0.9
    assert abs(got[0]["audit_recall"] - recall) <= 0.1      # 80 audited vectors


def test_maybe_in_loses_nothing(spark):
    from tidemark.llm.common import maybe_in
    df, keys = spark.range(5000).withColumnRenamed("id", "k"), spark.range(0, 5000, 13).withColumnRenamed("id", "k")
    got = {r["k"] for r in maybe_in(df, keys, "k", words=64).collect()}
    assert set(range(0, 5000, 13)) <= got and len(got) < 4000


def test_queries_are_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "tokens"]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as P
    import public_tokenizers
    from tidemark.llm import unigram
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    m = unigram.model(public_tokenizers.path("piece_bpe_32k.model"))
    at, sizes = docs, [docs.count()]
    for name, f in P.STAGES[:-1]:
        at = f(spark, at, sf_dir).cache()
        assert at.columns == docs.columns
        sizes.append(at.count())
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0
    mixed = sorted(r["text"] for r in at.collect())
    out = P.STAGES[-1][1](spark, at, sf_dir).collect()
    assert sorted(m.decode(r["ids"]) for r in out) == mixed


def test_pipeline_quality_without_labels(spark, tmp_path):
    import corpus_pipeline as P
    docs = spark.createDataFrame([(1, "some clean text"), (2, None)], "doc_id long, text string")
    for i, rows in enumerate(([], [(1, None)], [(77, 1)])):
        spark.createDataFrame(rows, "doc_id long, quality int").write.parquet(f"{tmp_path}/{i}/labels.parquet")
        assert P.quality(spark, docs, f"{tmp_path}/{i}").count() == 2
