"""Text functions and keyword operators against the hand fixtures."""

import pytest
from pyspark.sql import functions as F

from tidemark.constants import CRYPTO_KEYWORDS, GENERAL_KEYWORDS, STOPWORDS_EN
from tidemark.functions.arrays import generalise_tokens, union_tokens
from tidemark.functions.conditional import pick_better, percentage
from tidemark.functions.dates import parse_ts
from tidemark.functions.text import clean_text, map_label
from tidemark.operators import keywords as K
from tidemark.operators.rollup import explode_tokens


def one(spark, expr, schema="x string", rows=None):
    df = spark.createDataFrame(rows or [(None,)], schema)
    return df.select(expr.alias("r")).collect()


def test_clean_text_fixture(spark):
    df = spark.createDataFrame([("Don't buy THE dip! http://x.y/z ₿ Ξ é ²",), (None,)], "t string")
    out = [r[0] for r in df.select(clean_text("t", ["the"])).collect()]
    assert out == ["dont buy dip ξ é ²", None]


def test_clean_text_default_stopwords(spark):
    df = spark.createDataFrame([("This is the BEST coin, isn't it?",)], "t string")
    assert df.select(clean_text("t")).first()[0] == "best coin isnt"
    assert len(STOPWORDS_EN) == 181


def test_extract_tokens_fixture(spark):
    d = {**CRYPTO_KEYWORDS, **{w: [w] for w in GENERAL_KEYWORDS}}
    df = spark.createDataFrame([(1, "btc satoshi moon nothing"), (2, "")], "id int, t string")
    out = {r["id"]: r["tokens"] for r in K.extract_tokens(df, "t", d).collect()}
    assert out == {1: ["BTC", "moon"], 2: []}


def test_extract_tokens_join_path_equals_literal(spark, monkeypatch):
    d = {**CRYPTO_KEYWORDS, **{w: [w] for w in GENERAL_KEYWORDS}}
    df = spark.createDataFrame([(1, "btc satoshi moon nothing"), (2, "eth and link pump"), (3, "x")],
                               "id int, t string")
    lit = {r["id"]: r["tokens"] for r in K.extract_tokens(df, "t", d).collect()}
    table = spark.createDataFrame(K.dictionary_rows(d), "tag string, keyword string")
    monkeypatch.setattr(K, "MAX_LITERAL_ENTRIES", 1)
    joined = {r["id"]: r["tokens"] for r in K.extract_tokens(df, "t", table, id_col="id").collect()}
    assert lit == joined


def test_find_keywords_fixture(spark):
    df = spark.createDataFrame([(1, "Smart contracts on BTC"), (2, "subtc"), (3, "smart  contracts"),
                                (4, "BTC-usd, smart contracts!")], "id int, t string")
    out = {r["id"]: (r["words_found"], r["word_found"])
           for r in K.find_keywords(df, "t", ["btc", "smart contracts"]).collect()}
    assert out[1] == (["btc", "smart contracts"], "btc")
    assert out[2] == ([], None)
    assert out[3] == ([], None)       # two spaces: the keyword's separator must match
    assert out[4] == (["btc", "smart contracts"], "btc")


def test_find_keywords_join_path_equals_literal(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Smart contracts on BTC"), (2, "nothing here"), (3, "de la tion")],
                               "id int, t string")
    kws = ["btc", "smart contracts", "de la", "tion"]
    lit = {r["id"]: r["words_found"] for r in K.find_keywords(df, "t", kws).collect()}
    table = spark.createDataFrame([(k, k) for k in kws], "tag string, keyword string")
    monkeypatch.setattr(K, "MAX_LITERAL_ENTRIES", 1)
    joined = {r["id"]: r["words_found"] for r in K.find_keywords(df, "t", table, id_col="id").collect()}
    assert lit == joined


def test_generalise_and_union(spark):
    df = spark.createDataFrame([(["moon", "BTC", "fud"], ["BTC", ""]), ([""], None), (None, None)],
                               "a array<string>, b array<string>")
    u = [r[0] for r in df.select(union_tokens("a", "b")).collect()]
    assert u == [["BTC", "fud", "moon"], [], []]
    g = df.select(generalise_tokens(union_tokens("a", "b"), GENERAL_KEYWORDS).alias("t"))
    assert g.first()["t"] == ["BTC", "general"]
    # R1 + R2: [''] and null give no row
    rows = explode_tokens(g.withColumn("id", F.monotonically_increasing_id()), "t", "token").collect()
    assert sorted(r["token"] for r in rows) == ["BTC", "general"]


def test_pick_better_fixture(spark):
    df = spark.createDataFrame([(1, 0.7, -1, 0.7), (None, None, 1, 0.6)],
                               "tl int, ts double, hl int, hs double")
    out = [tuple(r[0]) for r in df.select(pick_better("tl", "ts", "hl", "hs")).collect()]
    assert out == [(1, 0.7), (1, 0.6)]


def test_percentage_zero_total(spark):
    df = spark.createDataFrame([(3, 0), (1, 4)], "p int, t int")
    assert [r[0] for r in df.select(percentage("p", "t")).collect()] == [None, 25.0]


def test_map_label(spark):
    df = spark.createDataFrame([("LABEL_0",), ("LABEL_1",), ("x",)], "l string")
    out = [r[0] for r in df.select(map_label("l", {"LABEL_0": -1, "LABEL_1": 1}, 0)).collect()]
    assert out == [-1, 1, 0]


def test_parse_ts_fixture(spark):
    import datetime as dt
    df = spark.createDataFrame([("31/07/2024 23:10:00",), ("bad",)], "s string")
    out = [r[0] for r in df.select(parse_ts("s", "dd/MM/yyyy HH:mm:ss")).collect()]
    assert out == [dt.datetime(2024, 7, 31, 23, 10), None]


def test_null_keeping_filter(spark):
    df = spark.createDataFrame([("moderator",), (None,), ("x",)], "d string")
    kept = [r[0] for r in df.filter(~F.col("d").eqNullSafe("moderator")).collect()]
    assert sorted(kept, key=str) == [None, "x"] or sorted(kept, key=lambda v: (v is not None, v)) == [None, "x"]


def test_lexicon(spark):
    df = spark.createDataFrame([("good good bad",)], "t string")
    w = F.split("t", " ")
    s = df.select(K.lexicon_score(w, {"good": 1.0, "bad": -2.0}).alias("s")).first()["s"]
    assert s == 0.0


def test_large_dictionary_join_path_broadcasts(spark, monkeypatch):
    table = spark.createDataFrame([("T", "btc"), ("T", "eth")], "tag string, keyword string")
    df = spark.createDataFrame([(1, "btc and eth")], "id int, t string")
    monkeypatch.setattr(K, "MAX_LITERAL_ENTRIES", 1)
    out = K.find_keywords(df, "t", table, id_col="id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "BatchEvalPython" not in plan
    assert out.first()["words_found"] == ["btc", "eth"]


def test_label_articles_dedupes_repeats(spark):
    import datetime as dt
    from tidemark.plans.composed import label_articles
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "BTC up", "great gain"), (t, "BTC up", "great gain"), (t, "ETH", None)],
                               "ts timestamp, title string, description string")
    out = label_articles(df, "ts", "title", "description", CRYPTO_KEYWORDS, lexicon={"great": 1.0})
    rows = sorted((r["token"], r["clean_text"], r["label"], r["label_word"]) for r in out.collect())
    assert rows == [("BTC", "btc great gain", 1, "positive"), ("ETH", "eth", None, "unknown")]


def test_find_keywords_equals_python_word_bound_regex(spark):
    """Brute force: for random texts, the n-gram search returns exactly the
    keywords that Python's ``\\bkeyword\\b`` (case ignored) finds."""
    import random
    import re
    rnd = random.Random(11)
    vocab = ["btc", "bitcoin", "smart", "contract", "contracts", "eth", "ether", "moon", "to", "the",
             "de", "la", "café", "Über", "x1", "proof", "of", "stake", "sub", "subtc", "BTC"]
    seps = [" ", "  ", "-", ", ", "! ", ".", "_", "\n", "/", "'"]
    kws = ["btc", "smart contracts", "smart contract", "proof-of-stake", "de la", "café", "über",
           "to the moon", "eth", "x1"]
    texts = []
    for i in range(300):
        n = rnd.randint(0, 12)
        t = "".join(rnd.choice(vocab) + rnd.choice(seps) for _ in range(n))
        texts.append((i, t if rnd.random() > 0.05 else None))
    df = spark.createDataFrame(texts, "id int, t string")
    got = {r["id"]: r["words_found"] for r in K.find_keywords(df, "t", kws).collect()}
    for i, t in texts:
        if t is None:
            assert got[i] is None
            continue
        exp = sorted(k for k in kws if re.search(r"\b" + re.escape(k) + r"\b", t, re.IGNORECASE))
        assert got[i] == exp, (t, got[i], exp)


def test_clean_text_equals_python_pipeline(spark):
    """Brute force: the JVM cleaning equals the Python steps it re-expresses
    (URL strip, Unicode \\w/\\s symbol strip, lower, split, stopwords)."""
    import random
    import re
    rnd = random.Random(5)
    pieces = ["Don't", "BUY", "the", "dip!", "http://x.y/z?a=1", "https://t.co/ab", "₿", "Ξ", "é", "²",
              "naïve", "Ünïcode", "x_y", "__", "3.14", "(ok)", "🚀", "中文", "İstanbul", "ß", "it's", "was",
              " ", " ", "\t", "\x0b", "\x1c", "\x85", "-", "—", "#tag", "@user"]
    texts = [(i, "".join(rnd.choice(pieces) + rnd.choice([" ", "", "  ", "\n"]) for _ in range(rnd.randint(0, 10))))
             for i in range(300)]
    df = spark.createDataFrame(texts, "id int, t string")
    got = {r["id"]: r["c"] for r in df.select("id", clean_text("t").alias("c")).collect()}
    sw = set(STOPWORDS_EN)

    def py_clean(t):
        t = re.sub(r"http\S+", "", t)
        t = re.sub(r"[^\w\s]", "", t)
        return " ".join(w for w in t.lower().split() if w not in sw)
    bad = [(t, got[i], py_clean(t)) for i, t in texts if got[i] != py_clean(t)]
    assert not bad, bad[:3]


def test_large_dictionary_gives_what_a_small_one_gives(spark, monkeypatch):
    from tidemark.operators import keywords as K
    rows = [(1, "btc up"), (1, "eth up"), (1, "eth up"), (2, None), (3, ""), (3, "buy the very big red dip now")]
    df = spark.createDataFrame(rows, "id int, t string")
    words = ["btc", "eth", "dip", "buy the very big red"]
    key = lambda r: (r["id"], r["t"] or "", r["words_found"])
    small = sorted((key(r) for r in K.find_keywords(df, "t", words).collect()), key=str)
    tags = sorted((str((r["id"], r["t"], r["tokens"])) for r in K.extract_tokens(df, "t", words).collect()))
    monkeypatch.setattr(K, "MAX_LITERAL_ENTRIES", 1)
    assert sorted((key(r) for r in K.find_keywords(df, "t", words).collect()), key=str) == small
    assert sorted((str((r["id"], r["t"], r["tokens"])) for r in K.extract_tokens(df, "t", words).collect())) == tags
    assert (3, "buy the very big red dip now", ["buy the very big red", "dip"]) in small
    assert (1, "btc up", ["btc"]) in small


def _plain_search(text, keywords):
    import unicodedata
    inside = lambda c: c == "_" or unicodedata.category(c)[0] in "LN"
    low, found = text.lower(), set()
    for k in keywords:
        at = low.find(k)
        while at >= 0 and k:
            z = at + len(k)
            if inside(k[0]) and inside(k[-1]) and (at == 0 or not inside(low[at - 1])) and (z == len(low) or not inside(low[z])):
                found.add(k)
            at = low.find(k, at + 1)
    return sorted(found)


def test_trie_walk_equals_plain_search(spark):
    import random
    r = random.Random(7)
    words, seps = ["a", "b", "ab", "été", "x_1", "42", "o'b"], [" ", "  ", "-", ", ", "'"]
    phrase = lambda n: "".join(r.choice(words) + r.choice(seps) for _ in range(n)).rstrip(" -,'")
    kws = sorted({phrase(r.randrange(1, 7)) for _ in range(60)} | {"a", "#a", "a.", "b a b a b a b a b", "it's \\d", "b'"})
    rows = [(i, r.choice(["", " ", "#"]) + phrase(r.randrange(0, 40)).title() + r.choice(["", ".", " "])) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "..."), (903, "b a b a b a b a b a b"), (904, "It's \\d")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {x["id"]: x["words_found"] for x in K.find_keywords(df, "t", kws).collect()}
    assert got[900] is None
    assert {i: _plain_search(t, kws) for i, t in rows if t is not None} == {i: w for i, w in got.items() if i != 900}
    singles = {x["id"]: x["words_found"] for x in K.find_keywords(df, "t", ["a", "42", "#b"]).collect()}
    assert {i: _plain_search(t, ["a", "42"]) for i, t in rows if t is not None} == {i: w for i, w in singles.items() if i != 900}


def test_a_stream_refuses_a_dictionary_beyond_the_bound(spark, monkeypatch, tmpdir_fresh):
    import pytest
    stream = spark.readStream.schema("t string").json(tmpdir_fresh)
    table = spark.createDataFrame([("x", "btc"), ("x", "eth")], "tag string, keyword string")
    assert K.find_keywords(stream, "t", table).isStreaming
    monkeypatch.setattr(K, "MAX_LITERAL_ENTRIES", 1)
    with pytest.raises(ValueError):
        K.find_keywords(stream, "t", table)


@pytest.mark.parametrize("most", [1 << 20, 150, 0])
def test_large_dictionary_shuffles_texts_not_hits(spark, monkeypatch, most):
    """Hits are collected where their text is: nothing is dealt out between the search and the sets."""
    from tidemark.operators import keywords
    monkeypatch.setattr(keywords, "MAX_LITERAL_ENTRIES", 1)
    monkeypatch.setattr(keywords, "MAX_BROADCAST_BYTES", most)
    rows = [(1, "Alpha beta"), (1, "beta"), (2, "Alpha beta"), (None, None), (3, ""), (4, "other words")]
    df = spark.createDataFrame(rows, "id long, text string")
    table = spark.createDataFrame([("alpha", "alpha"), ("beta", "beta"), ("zeta", "zeta")], "tag string, keyword string")
    out = keywords.find_keywords(df, "text", table)
    found = {"Alpha beta": ["alpha", "beta"], "beta": ["beta"], "": [], "other words": [], None: None}
    assert sorted(map(str, out.select("id", "text", "words_found").collect())) == sorted(str(r) for r in spark.createDataFrame(
        [(i, t, found[t]) for i, t in rows], "id long, text string, words_found array<string>").collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    searched = plan[plan.index("collect_set"):plan.index("Generate")]
    assert "hashpartitioning" not in searched and "BroadcastHashJoin" in searched
