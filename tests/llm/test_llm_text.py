"""Text operators against brute force on small fixtures, with nulls, empties, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n, vocabulary=300):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randrange(2, 7))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) + ("\n" if r.random() < 0.05 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = [prose(i, 120) for i in range(12)]
    out = list(base)
    out += [base[0], base[0], base[1].upper()]                                 # exact copies, another case
    for i in range(8):                                                         # near copies
        w = base[2].split(" ")
        w[5 + i] = "changed%d" % i
        out.append(" ".join(w))
    passage = " ".join(base[3].split()[:70])
    out += [prose(100 + i, 30) + " " + passage + " " + prose(200 + i, 30) for i in range(6)]
    out += [None, "", "  \n\t ", "one", "one two three", "ONE two three", "\x0b\x0c\r", "x " * 400, "word\x1cwith\x85odd\xa0blanks " * 30]
    out.append(" ".join(prose(7, 3000).split()))                                # long
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "s%d" % (i % 3) if i % 7 else None, "extra") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, __t string").cache()


def empty(docs):
    return docs.where(F.lit(False))


def test_substring_dedup_matches_brute_force(docs, texts):
    from tidemark.llm import substring_dedup
    first = {}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), i)
    got = {r["doc_id"]: r for r in substring_dedup.report(docs).collect()}
    assert len(got) == len(texts)
    lost = 0
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < i:
                gone[k:k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        lost += sum(gone)
        r = got[i]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
        assert sum(s["end"] - s["start"] for s in r["spans"]) == sum(gone)
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    assert lost > 300
    assert substring_dedup.report(empty(docs)).count() == 0
    cleaned = {r["doc_id"]: r["text"] for r in substring_dedup.clean(docs).collect()}
    assert cleaned[12] == "" and cleaned[0] == texts[0]


def test_substring_dedup_null_and_repeated_ids(spark):
    from tidemark.llm import substring_dedup
    t = prose(1, 60)
    df = spark.createDataFrame([(None, t), (None, t), (5, t), (5, t), (6, t)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring_dedup.report(df).collect())
    n = len(WORD.findall(t))
    assert got == [(0, 0), (0, 0), (5, 0), (5, 0), (6, n)]


def shingles(t):
    w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_of(ids, linked):
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("often", [2, 16, 10_000])
def test_jaccard_join_matches_brute_force(docs, texts, often, monkeypatch):
    from tidemark.llm import jaccard_join
    monkeypatch.setattr(jaccard_join, "FREQUENT", often)
    s = [shingles(t) for t in texts]
    linked = [(a, b) for a in range(len(s)) for b in range(a) if s[a] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])]
    want = components_of(range(len(s)), linked)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.report(docs).collect()}
    assert got == {i: (len(s[i]), want[i]) for i in range(len(s))} and len(linked) > 10
    if often == 16:
        left = sorted(r["doc_id"] for r in jaccard_join.dedup(docs).collect())
        assert left == sorted(set(want.values()))
        assert jaccard_join.report(empty(docs)).count() == 0


def test_jaccard_prefixes_never_miss_a_pair():
    from tidemark.llm import jaccard_join as J
    r = np.random.default_rng(3)
    for trial in range(400):
        n = int(r.integers(1, 60))
        x = r.choice(np.arange(1, 200, dtype=np.uint64), n, replace=False)
        y = np.unique(np.concatenate([x[r.random(n) < 0.9], r.integers(200, 260, int(r.integers(0, 1 + n // 6))).astype(np.uint64)]))
        x = np.unique(x)
        if not len(y) or 100 * len(np.intersect1d(x, y)) < 75 * len(np.union1d(x, y)):
            continue
        hot = np.sort(r.choice(np.arange(1, 260, dtype=np.uint64), int(r.integers(0, 250)), replace=False))
        _, a, _ = J.prefix_keys(x, np.array([0, len(x)]), hot, 75)
        _, b, _ = J.prefix_keys(y, np.array([0, len(y)]), hot, 75)
        assert len(np.intersect1d(a, b)), (x, y, hot)


def test_parity_bits_never_exceed_the_difference():
    from tidemark.llm import jaccard_join as J
    r = np.random.default_rng(4)
    for n, m in ((10, 12), (300, 5000), (600, 500), (2000, 2100)):
        x, y = (np.unique(r.integers(0, 3000, k)).astype(np.uint64) for k in (n, m))
        assert J.least_difference(J.parity_bits(x), J.parity_bits(y)) <= len(np.setxor1d(x, y))


def test_jaccard_keys_of_two_sets_end_after_the_star(spark, monkeypatch):
    from tidemark.llm import jaccard_join
    tables, store = {}, jaccard_join.store
    monkeypatch.setattr(jaccard_join, "store", lambda df, name: tables.setdefault(name, []).append(store(df, name)) or tables[name][-1])
    base = [prose(50 + i, 60).split() for i in range(6)]
    # each text shares its first half with one other: every key has two sets, which do not link
    texts = [" ".join(base[i // 2][:30] + base[(i + 1) % 6][30:] + [f"only{i}"] * 20) for i in range(6)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.report(df).collect()}
    assert got == {i: i for i in range(6)}
    assert tables["stars"][0].count() and not any(t.count() for t in tables["apart"])


def test_jaccard_null_and_repeated_ids(spark):
    from tidemark.llm import jaccard_join
    t = prose(1, 60)
    df = spark.createDataFrame([(None, t), (5, t), (5, t), (6, t), (7, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["component_id"]) for r in jaccard_join.report(df).collect()), key=str)
    assert got == [(0, None), (5, 5), (5, 5), (6, 5), (7, 7)]


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edited(r, text, edits):
    b = list(text)
    for _ in range(edits if b else 0):
        i, kind = r.randrange(len(b)), r.randrange(1 if len(b) == 1 else 0, 3)
        b[i:i + 1] = {0: [], 1: [b[i], r.choice("xyzé")], 2: [r.choice("xyzé")]}[kind]
    return "".join(b)


def test_edit_distances():
    from tidemark.llm.line_dedup import edit_distances
    r = random.Random(1)
    a = ["".join(r.choice("abé") for _ in range(r.randrange(14))) for _ in range(1500)]
    b = [edited(r, x, r.randrange(5)) if x else "ab" for x in a]
    for most in (1, 2, 3):
        assert edit_distances(a, b, most).tolist() == [min(edit_distance(x, y), most + 1) for x, y in zip(a, b)]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_line_dedup_matches_brute_force(spark, most):
    from tidemark.llm import line_dedup
    r = random.Random(most)
    lines = ["".join(r.choice("abcdé ") for _ in range(r.randrange(20, 45))) for _ in range(30)]
    rows = []
    for i in range(25):
        part = []
        for _ in range(r.randrange(0, 7)):
            x = r.choice(lines)
            part.append(edited(r, x, r.randrange(0, 5)) if r.random() < 0.6 else x)
        part += ["short"] * r.randrange(3)
        rows.append((i, "\n".join(part)))
    rows += [(25, None), (26, ""), (27, "\n\n"), (28, lines[0] * 40), (29, lines[0] * 40 + "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    every = [(i, at, x) for i, t in rows for at, x in enumerate((t or "").split("\n")) if len(x) >= 20]
    want = {i: [] for i, _ in rows}
    for n, (i, at, x) in enumerate(every):
        if any(abs(len(x) - len(y)) <= most and edit_distance(x, y) <= most for _, _, y in every[:n]):
            want[i].append(at)
    got = {r["doc_id"]: r for r in line_dedup.report(df, max_edits=most).collect()}
    assert {i: r["removed"] for i, r in got.items()} == want and sum(map(len, want.values())) > 10
    assert got[25]["n_lines"] == 0 and got[27]["n_lines"] == 3
    left = {r["doc_id"]: r["text"] for r in line_dedup.clean(df, max_edits=most).collect()}
    for i, t in rows:
        kept = "\n".join(x for at, x in enumerate((t or "").split("\n")) if at not in want[i])
        if not want[i]:
            assert left[i] == t
        elif kept.strip():
            assert left[i] == kept
        else:
            assert i not in left
    assert line_dedup.report(df.where("doc_id < 0")).count() == 0


def test_line_dedup_null_and_repeated_ids(spark):
    from tidemark.llm import line_dedup
    t = "a line that is long enough to count"
    df = spark.createDataFrame([(None, t), (3, t), (3, t), (4, t + "\n" + t)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["removed"]) for r in line_dedup.report(df).collect()), key=str)
    assert got == [(3, []), (3, []), (4, [0, 1]), (None, [0])]


def test_line_dedup_short_lines(spark):
    from tidemark.llm import line_dedup
    twin = "eighteen chars now"
    rows = [(0, "short\n \n" + twin), (1, "short\nshorn\n \n" + twin + "!!"), (2, twin + "\n" + twin[:-1] + "\nshort"), (3, twin + "!!?")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(df).collect()}
    assert got == {0: [], 1: [3], 2: [], 3: [0]}                   # twin: 18 characters, with !!: 20
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(df, short_repeats=True).collect()}
    assert got == {0: [], 1: [0, 3], 2: [0, 2], 3: [0]}


def test_quality_rules_base_counts(docs, texts):
    from tidemark.llm import quality_rules
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        cover = {p for k, g in enumerate(tri) if tri.count(g) > 1 for p in (k, k + 1, k + 2)} if len(w) < 1000 else None
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        if cover is not None:
            assert r["n_repeat_words"] == len(cover)
            assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.judge(empty(docs)).count() == 0


def test_quality_rules_lines_per_host(spark):
    from tidemark.llm import quality_rules
    common = "This very line stands on each page of the host and says nothing much at all"
    rows = [(i, common + "  %d\n" % i + prose(i, 8 if i < 5 else 200), "h") for i in range(40)]
    rows += [(100 + i, common + "\n" + prose(i, 60), "other") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(df, min_words=5, min_left=0.5).collect()}
    assert all(not got[i]["kept"] for i in range(5)) and all(got[i]["kept"] for i in range(5, 40))
    assert all(got[100 + i]["n_line_words_removed"] == 0 for i in range(5))
    twice = {r["doc_id"]: r["n_line_words_removed"] for r in quality_rules.judge(df.union(df.where("doc_id = 7")), min_words=5).collect()}
    assert twice[7] == got[7]["n_line_words_removed"] == 17


def test_classifier_learns_and_scores_every_row(spark):
    from tidemark.llm import quality_classifier as Q
    good, bad = [prose(i, 60) for i in range(120)], [" ".join(x.upper() + "!!" for x in prose(500 + i, 60).split()) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(900, None), (901, ""), (902, "x" * 300_000), (None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(180) if i % 3] + [(None, 1), (5, None)], "doc_id long, quality int")
    o = Q.Options(buckets=1 << 14, epochs=4)
    model = Q.fit(docs, labels, options=o)
    got = Q.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None and r["doc_id"] < 180 and r["doc_id"] % 3 == 0}
    assert all((s >= 0.7) == (i < 120) for i, s in held.items())
    assert np.allclose(Q.fit(docs, labels, options=o).weights, model.weights)       # reruns agree
    assert Q.score(empty(docs), model).count() == 0
    assert set(r["score"] for r in Q.score(docs, Q.fit(docs, empty(labels), options=o)).collect()) == {0.5}


def test_classifier_features_do_not_depend_on_blocks():
    from tidemark.llm import quality_classifier as Q
    texts = ["one two two two é", "", "日本語 text", "a", "x" * 50]
    def bags(column, piece):
        rows = [[] for _ in range(len(column))]
        for row, bucket in Q.features(column, Q.Options(buckets=1 << 12), piece):
            for r, b in zip(row.tolist(), bucket.tolist()):
                rows[r].append(b)
        return [sorted(x) for x in rows]
    whole = bags(pa.array(texts), 1 << 19)
    assert whole == bags(pa.array(texts), 3) == [bags(pa.array([t]), 5)[0] for t in texts]
    assert len(whole[3]) == 2 and len(whole[1]) == 1


def brute_unigram(pieces, scores, unknown, chunk):
    best = {0: (0.0, [])}
    for e in range(1, len(chunk) + 1):
        found = []
        for s in range(e):
            if s in best:
                x = chunk[s:e]
                if x in pieces:
                    found.append((best[s][0] + scores[pieces.index(x)], best[s][1] + [x]))
                elif e == s + 1:
                    found.append((best[s][0] + unknown, best[s][1] + [x]))
        best[e] = max(found, key=lambda f: f[0])
    return best[len(chunk)]


def test_unigram_finds_the_best_segmentation():
    from tidemark.llm.unigram import MARK, Unigram
    r = random.Random(2)
    pieces = sorted({"".join(r.choice("abé" + MARK) for _ in range(r.randrange(1, 5))) for _ in range(60)} | {MARK, "a"})
    pieces = [p for p in pieces if MARK not in p.lstrip(MARK)]
    scores = [-r.random() * 9 for _ in pieces]
    names = ["<unk>"] + ["<0x%02X>" % b for b in range(256)] + pieces
    m = Unigram(names, [0.0] * 257 + scores, [False] * 257 + [True] * len(pieces), list(range(1, 257)))
    score = {n: s for n, s in zip(pieces, scores)}
    for _ in range(150):
        t = "".join(r.choice("abéü \n") for _ in range(r.randrange(0, 70)))
        ids = np.frombuffer(m.encode([t])[0], "<i4").tolist()
        assert m.decode(ids) == t
        if not t:
            assert ids == []
            continue
        want, path = brute_unigram(pieces, scores, m.unknown_score, (" " + t).replace(" ", MARK))
        total, pending = 0.0, b""
        for i in ids:
            if i <= 256:
                pending += bytes([i - 1])
                try:
                    pending.decode()
                    total, pending = total + m.unknown_score, b""
                except UnicodeDecodeError:
                    pass
            else:
                total += score[names[i]]
        assert abs(total - want) < 1e-6
        raw = (MARK + t.split("\n")[0].split(" ")[0]).encode()
        assert np.frombuffer(m._many([raw])[0], "<i4").tolist() == m._one(raw)


def test_unigram_round_trip_and_public_vocabulary(docs, texts):
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2
    from tidemark.llm import unigram
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = unigram.decode(unigram.encode(docs.withColumn("ids", F.lit(1)), path), path).collect()
    assert len(out) == len(texts) and all(r["decoded"] == (r["text"] or "") for r in out)
    assert unigram.encode(empty(docs), path).count() == 0
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    m = unigram.model(path)
    words = ["Tokenization", "information", "hello", "Die", "große", "été", "constructing", "word"]
    score = lambda ids: sum(library.get_score(i) for i in ids)
    for w in words:
        mine = np.frombuffer(m.encode([w])[0], "<i4").tolist()
        assert score(mine) >= score(library.encode(w))


def test_token_store_round_trip(spark, docs, texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    from tidemark.llm import token_store
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = f"file://{tmp_path}/store"
    extra = spark.createDataFrame([(None, "null id", None, ""), (3, "again", None, ""), (9, "Don't <|endoftext|> ΑΣ İx", None, "")], docs.schema)
    all_docs = docs.union(extra)
    token_store.write(all_docs, folder, path, docs_per_shard=5)
    rows = sorted(((i, t) for i, t in [(r["doc_id"], r["text"]) for r in all_docs.collect()]),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    library = Tokenizer.from_file(path)
    want, start = [], 0
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    got = token_store.read(spark, folder, all_docs.select("doc_id"), with_ids=True).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    some = spark.createDataFrame([(2,), (2,), (7,), (10**9,), (-5,)], "doc_id long")
    assert sorted(r["doc_id"] for r in token_store.read(spark, folder, some).collect()) == [2, 7]
    token_store.write(empty(docs), f"file://{tmp_path}/none", path)
    assert token_store.read(spark, f"file://{tmp_path}/none", some).count() == 0


def test_perfect_hash_is_minimal():
    from tidemark.llm.token_store import PerfectHash
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 20_000)).astype(np.uint64)
    h = PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert len(PerfectHash.build(keys[:0]).slots(keys[:5])) == 5
