"""Byte-level BPE, importance resampling, fill-in-middle: against the libraries and plain Python."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def byte_vocabulary():
    P = pytest.importorskip("public_tokenizers")
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts(n=400, seed=1):
    r = random.Random(seed)
    pool = [chr(r.choice([r.randrange(0x80), r.randrange(0x250), r.randrange(0x3000), r.randrange(0x1F300, 0x1F700)])) for _ in range(600)]
    pool += list("  \n\t'sa1 \xa0́‍") * 15
    return [None, "", " ", "\n\n x  ", "I'll 'sabc don't", "<|endoftext|>", "caf\xe9's " * 300, "x" * 20_000, "\U0001f600\U0001f600 文"] + [
        "".join(r.choices(pool, k=r.randrange(60))) for _ in range(n)]


def test_byte_bpe_equals_tiktoken(spark, byte_vocabulary):
    from tidemark.llm import byte_bpe as B
    path, pattern, library = byte_vocabulary
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b", "x")] * 2, "doc_id long, text string, ids string")
    docs = docs.withColumn("a.b", F.lit(1)).withColumn("__in0", F.lit(2))
    out = B.encode(docs, path, pattern, offsets=True)
    assert out.columns == ["doc_id", "text", "a.b", "__in0", "ids", "starts", "ends"]
    rows = B.decode(B.decode(out, path, pattern), path, pattern, out_col="parts", texts=True).collect()
    assert len(rows) == len(texts) + 2
    chain = B.codec(path, pattern).tokenizer
    for r in rows:
        t = r["text"] or ""
        assert r["ids"] == library.encode_ordinary(t) and bytes(r["decoded"]) == t.encode() and "".join(r["parts"]) == t
        assert list(zip(r["starts"], r["ends"])) == chain.encode(t).offsets
    packed = B.decode(B.encode(docs, path, pattern, packed=True), path, pattern)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() and bytes(r["ids"]) == np.array(library.encode_ordinary(r["text"] or ""), "<u4").tobytes()
               for r in packed.collect())
    assert B.encode(docs.where("false"), path, pattern).count() == 0


def test_byte_bpe_split_characters(byte_vocabulary):
    from tidemark.llm.byte_bpe import codec
    path, pattern, library = byte_vocabulary
    c, smile = codec(path, pattern), "\U0001fae0"
    ids = np.array(library.encode_ordinary(smile))
    assert len(ids) > 1 and c.texts(ids) == [""] * (len(ids) - 1) + [smile]
    assert c.texts(ids[:-1])[-1] == "�" and c.decode(ids[:1]) + c.decode(ids[1:]) == smile.encode()
    with pytest.raises(ValueError):
        c.decode(np.array([60_000]))


def test_byte_bpe_every_character(byte_vocabulary):
    from tidemark.llm.byte_bpe import codec
    path, pattern, library = byte_vocabulary
    chars = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    texts = [f"a{c}1 {c}{c}  {c}!\n{c}" for c in chars]
    got = codec(path, pattern).encode(texts)
    want = library.encode_ordinary_batch(texts)
    assert [c for c, g, w in zip(chars, got, want) if np.frombuffer(g, "<u4").tolist() != w] == []


def test_word_ids_of_every_latin_character():
    P = pytest.importorskip("public_tokenizers")
    from tidemark.llm.token_store import tokenizer
    t = tokenizer(P.path("word_bpe_49k.json"))
    chars = [chr(i) for i in range(0x3100)]
    r = random.Random(2)
    texts = [f for c in chars for f in (c, f"a{c}b {c}1{c}", f"Q{c}'s")] + ["".join(r.choices(chars[0x180:0x250] + list(" 's1\n") * 5, k=12)) for _ in range(3000)]
    got, want = t.encode(texts), t.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert t.plain and [x for x, g, w in zip(texts, got, want) if np.frombuffer(g, t.dtype).tolist() != w.ids] == []


# ---- fill in the middle ---------------------------------------------------------------------

def _fim(row_id, text, percent, spm):
    t, n = text or "", len(UNIT.findall(text or ""))
    d = sha(f"42:{'' if row_id is None else row_id}")
    h = [int(d[k: k + 8], 16) for k in (0, 8, 16, 24)]
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return row_id, n, "plain", None, None, sha(t), sha(t), t
    u, (a, z) = UNIT.findall(t), sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:z]), "".join(u[z:])
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return row_id, n, form, len(p), len(m), sha(out), sha(t), out


@pytest.mark.parametrize("size", [8, 100, 1 << 16])
def test_fill_in_middle(spark, size):
    from tidemark.llm import fim
    r = random.Random(3)
    letters = list("ab<PSM> \t\n\xe9一\U0001f600") + ["<P>", " \x0b", "\xa0"]
    rows = [(i if i % 50 else None, None if i % 97 == 5 else "".join(r.choices(letters, k=r.choice([0, 1, 3, 10, 60, 300])))) for i in range(400)]
    rows += [(5, "x" * 5000), (6, " " * 500), (8, "\U0001f600" * 300 + " " + "\xe9" * 200 + "  "), (8, "<<S <P"), (11, "one two " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("id", F.lit(0))
    framed = fim.frames(docs, size=size)
    out = fim.transform(framed, percent=70, spm_percent=50, with_output=True, size=size)
    key = lambda x: tuple((y is None, y) for y in x)
    assert sorted((tuple(x) for x in out.collect()), key=key) == sorted((_fim(i, t, 70, 50) for i, t in rows), key=key)
    one = framed.orderBy(F.desc("n")).first()
    assert len(one["frames"]) == len(one["frame_bytes"]) and one["frame_units"][-1] == one["n"] == 6001 and one["frame_chars"][-1] == one["chars"]
    assert fim.transform(fim.frames(docs.where("false"))).count() == 0


def test_fill_in_middle_reads_only_the_cut_frame():
    from tidemark.llm import fim
    text = ("word " * 200_000).encode()
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64()), "text": pa.array([text.decode()])})
    row = next(fim._frames(fim.FRAME)([batch])).to_pylist()[0]
    f = fim.Frames(row["frames"], row["frame_bytes"], row["frame_units"], row["frame_chars"])
    opened = []
    inner, f._open = f._open, lambda x: opened.append(1) or inner(x)
    assert f.cut(150_001) == (750_004, 750_004) and len(opened) == 1 and len(f.data) > 10


# ---- importance resampling ------------------------------------------------------------------

def _features(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(w[i: i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)], len(w)


def test_position_table_crc():
    from tidemark.llm.importance import PositionCRC
    r = random.Random(1)
    data = np.frombuffer(r.randbytes(60_000), np.uint8)
    starts = np.array([r.randrange(0, 30_000) for _ in range(800)])
    ends = starts + np.array([r.choice([1, 2, 63, 64, 65, 128, 129, r.randrange(1, 3000), 30_000]) for _ in starts])
    for block in (4, 64):
        got = PositionCRC(block).spans(data, starts, ends)
        assert got.tolist() == [zlib.crc32(data[a:z].tobytes()) for a, z in zip(starts, ends)]


def test_importance_resampling(spark):
    from tidemark.llm import importance as I
    r = random.Random(4)
    words = ["Alpha", "beta", "g1", "\xe9t\xe9", "一", "x" * 200] + [f"w{i}" for i in range(60)]
    text = lambda k: "".join(r.choice(words) + r.choice([" ", "-", "\n", ". "]) for _ in range(k))
    rows = [(i, text(r.randrange(0, 60))) for i in range(300)] + [(300, None), (301, ""), (302, "Y" * 5000 + " z"), (7, "alpha " * 30), (7, "alpha " * 30), (None, "beta " * 25)]
    bench = [(1, text(80)), (2, None), (3, "alpha beta " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("score", F.lit(0.5)).repartition(5)
    out = I.resample(docs, spark.createDataFrame(bench, "item_id long, text string"))
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    b = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = [0] * 10_000, [0] * 10_000
    for side, table in ((s, rows), (t, bench)):
        for _, x in table:
            for f in _features(x)[0]:
                side[b(f)] += 1
    gain = [math.floor(1000 * math.log((t[k] + 1) * (sum(s) + 10_000) / ((s[k] + 1) * (sum(t) + 10_000)))) for k in range(10_000)]
    want = []
    for i, x in rows:
        f, n = _features(x)
        h = int(sha(f"42:{'' if i is None else i}")[:8], 16)
        w = sum(gain[b(y)] for y in f)
        want.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    may = sorted((x for x in want if x[1] >= 20), key=lambda x: (-x[4], x[0] is not None, x[0] or 0))
    k = 5 * len(may) // 100
    for place, x in enumerate(may, 1):
        x.append(place if place <= k else None)
    want = [tuple(x if len(x) == 6 else [*x, None]) for x in want]
    key = lambda x: tuple((y is None, y) for y in x)
    assert k > 3 and sorted((tuple(x) for x in out.collect()), key=key) == sorted(want, key=key)


def test_importance_of_nothing(spark):
    from tidemark.llm import importance as I
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert I.resample(docs, some).count() == 0
    row = I.resample(some, docs).first()
    assert row["n_words"] == 40 and row["n_features"] == 117 and row["rank"] is None      # 5 % of one document: none


def test_cleaned_tables_keep_columns_of_any_name(spark):
    from tidemark.llm import jaccard_join, line_dedup, mixing, substring_dedup
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"a line that repeats here\n{long}", "s"), (2, f"a line that repeats here\nown {long}", "s"), (3, None, "t"), (None, "", None), (2, "x y", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = ["removed", "__row", "kept_text", "__gone", "size", "taken", "__times", "__r", "__id", "n_words", "a.b"]
    docs = docs.withColumns({n: F.lit(f"my {n}") for n in names})
    for out in (line_dedup.clean(docs), substring_dedup.clean(docs), jaccard_join.dedup(docs), mixing.mix(docs)):
        got = out.collect()
        assert out.columns == docs.columns and got and all(r[n] == f"my {n}" for r in got for n in names)
    assert {(r["doc_id"], r["text"]) for r in line_dedup.clean(docs).collect()} >= {(3, None), (None, "")}
    assert len(jaccard_join.dedup(docs).collect()) == 3         # both rows of document 2 go with the copy of document 1


def _peak(run):
    """MB that ``run()`` holds at most, as numpy and Python tell."""
    import tracemalloc
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1] / 2**20
    tracemalloc.stop()
    return most


def _batch(n_bytes):
    r = random.Random(5)
    texts, size = [], 0
    while size < n_bytes:
        texts.append(" ".join(f"w{r.randrange(40000)}" for _ in range(r.randrange(20, 400))))
        size += len(texts[-1])
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "t"])


def test_memory_of_python_tasks_is_bounded():
    import public_tokenizers
    from tidemark.llm import jaccard_join, line_dedup, unigram
    b = _batch(4 << 20)
    docs, lines = b.rename_columns(["__id", "__t"]), b.rename_columns(["lid", "line"])
    drain = lambda run, x: _peak(lambda: [None for _ in run([x])])
    drain(jaccard_join._profile(5), docs)                            # tables of powers grow once
    assert drain(jaccard_join._profile(5), docs) < 10
    assert drain(line_dedup._entries("probe", 2, 20), lines) < 40
    hot = type("Hot", (), {"value": np.arange(8, dtype=np.uint64)})
    assert drain(jaccard_join._index(5, 75, hot), docs) < 10
    m = unigram.model(public_tokenizers.path("piece_bpe_32k.model"))
    assert m.cache.limit <= 50_000


def test_edit_distance_of_one_long_pair_among_short_ones():
    from tidemark.llm.line_dedup import edit_distances
    left = ["a short line of text"] * 1500 + ["ab" * 4000]
    right = ["a short lime of text"] * 1500 + ["ab" * 2000 + "c" + "ab" * 2000]
    found = []
    assert _peak(lambda: found.append(edit_distances(left, right, 2))) < 16
    assert found[0].tolist() == [1] * 1501


def test_count_tokens_counts_each_repeated_token():
    from collections import Counter
    from tidemark.llm import jaccard_join
    docs = _batch(20_000).rename_columns(["__id", "__t"])
    docs = pa.Table.from_batches([docs, docs, docs]).combine_chunks().to_batches()[0]
    out = [(t, n) for x in jaccard_join._count_tokens(5)([docs]) for t, n in zip(x["token"].to_pylist(), x["n"].to_pylist())]
    tokens, _ = jaccard_join.shingle_sets(docs["__t"], 5)
    want = Counter(tokens.view(np.int64).tolist())
    assert dict(out) == {t: n for t, n in want.items() if n > 1} and len(out) == len(dict(out))


def test_line_entries_are_those_of_distinct_lines():
    from tidemark.llm import line_dedup
    lines = [f"line number {i % 700} of a text, {i % 700}" * (1 + i % 3) for i in range(4200)] + ["x" * 300_000]
    ids = [zlib.crc32(x.encode()) for x in lines]
    whole = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines)], ["lid", "line"])
    for kind in ("index", "probe"):
        rows = lambda x: [r for y in line_dedup._entries(kind, 2, 20)([x]) for r in zip(*[c.to_pylist() for c in y.columns])]
        single = {r for i in {x: k for k, x in enumerate(ids)}.values() for r in rows(whole.slice(i, 1))}
        assert set(rows(whole)) == single


def test_documents_of_one_key_meet_once_however_many_keys_they_share(spark):
    from itertools import combinations

    from tidemark.llm import jaccard_join
    r = random.Random(9)
    held = {doc: r.sample(range(60), 55) if doc < 30 else r.sample(range(1000, 1200), 6) for doc in range(60)}
    held[60], held[61] = [5000], [5000, 5001]
    rows = [(k, doc, 100 + doc % 2, doc) for doc, keys in held.items() for k in keys] + [(5000, 60, 100, 60)]  # a row twice
    apart = spark.createDataFrame(rows, "key long, doc long, n long, component long")
    profile = spark.createDataFrame([(doc, 100 + doc % 2, [0] * jaccard_join.SKETCH, None) for doc in held],
                                    "doc long, n long, sketch array<long>, wide array<long>")
    found = [tuple(x) for x in jaccard_join.meeting(apart, profile, 75).collect()]
    assert set(found) == {(a, b) for a, b in combinations(held, 2) if set(held[a]) & set(held[b])}
    assert len(found) <= 1.2 * len(set(found))
