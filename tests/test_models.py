"""Model operators (†): closed-form or separable cases."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.conditional import noise_factor
from tidemark.operators.textml import hash_split, relevance_fit, score_text, text_pipeline, tfidf


def _corpus(spark):
    pos = [(i, f"bullish moon pump great gain {i}", 1.0) for i in range(30)]
    neg = [(100 + i, f"bearish dump crash loss fear {i}", 0.0) for i in range(30)]
    return spark.createDataFrame(pos + neg, "id long, text string, label double")


def test_classifier_beats_majority(spark):
    df = hash_split(_corpus(spark), "id")
    model = relevance_fit(df.filter("is_train"), "text", "label")
    pred = model.transform(df.filter(~F.col("is_train")))
    acc = pred.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.9


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(200).withColumnRenamed("id", "doc_id")
    a = {r["doc_id"] for r in hash_split(df, "doc_id").filter("is_train").collect()}
    b = {r["doc_id"] for r in hash_split(df.repartition(7), "doc_id").filter("is_train").collect()}
    assert a == b and 120 < len(a) < 190


def test_score_text_model_and_batch(spark):
    df = _corpus(spark)
    model = text_pipeline("text", "label", "logistic").fit(df)
    out = score_text(df.select("id", "text"), "text", model).collect()
    assert all(r["label"] in (-1, 1) and 0.5 <= r["score"] <= 1.0 for r in out)

    def batch(texts: pd.Series) -> pd.DataFrame:
        pos = texts.str.contains("bullish")
        return pd.DataFrame({"label": pos.map({True: 1, False: -1}), "score": 0.9})
    out2 = score_text(df.select("id", "text"), "text", None, batch_fn=batch)
    got = {r["id"]: r["label"] for r in out2.collect()}
    assert got[0] == 1 and got[100] == -1


def test_tfidf_matches_definition(spark):
    import math
    df = spark.createDataFrame([(1, "a bb bb cc"), (2, "bb dd")], "id long, text string")
    out = {(r["id"], r["term"]): r["tfidf"] for r in tfidf(df, "id", "text").collect()}
    idf = lambda d: math.log((1 + 2) / (1 + d)) + 1
    raw = {"bb": 2 * idf(2), "cc": idf(1)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert out[(1, "bb")] == pytest.approx(raw["bb"] / norm) and (1, "a") not in out


def test_noise_factor_seeded(spark):
    df = spark.createDataFrame([("BTC",), ("ETH",)] * 50, "token string")
    a = df.select(noise_factor("token", {"BTC": 0.025}, 0.05, seed=1).alias("f")).collect()
    b = df.select(noise_factor("token", {"BTC": 0.025}, 0.05, seed=1).alias("f")).collect()
    assert a == b and all(0.5 < r["f"] < 1.5 for r in a)


def test_ml_weights_are_those_of_tfidf(spark):
    from tidemark.operators.textml import fit_text_model, tfidf
    rows = [(1, "alpha beta beta common", 1.0), (2, "alpha gamma common", 0.0), (3, "delta delta common", 1.0), (4, "epsilon common", 0.0)]
    df = spark.createDataFrame(rows, "id int, text string, label double")
    model = fit_text_model(df, classifier="logistic", max_iter=2)
    vocabulary = model.stages[1].vocabulary
    want = {(r["id"], r["term"]): r["tfidf"] for r in tfidf(df, "id", "text").collect()}
    got = {(r["id"], vocabulary[i]): v for r in model.transform(df).collect() for i, v in zip(r["features"].indices.tolist(), r["features"].values.tolist())}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_trees_take_any_number_of_keys_and_no_late_label(spark):
    from pyspark.sql import functions as F
    from tidemark.operators.forecast import gbt_forecast
    df = spark.range(40 * 30).select(F.concat(F.lit("k"), F.col("id") % 40).alias("k"), F.floor(F.col("id") / 40).alias("i"))
    df = df.select("k", F.timestamp_seconds(F.col("i") * 3600).alias("t"), (F.when(F.col("i") >= 20, 1e6).otherwise(F.col("i") % 3) * 1.0).alias("v"))
    out = gbt_forecast(df, "k", "t", "v", 3, split_ts="1970-01-01 20:00:00", params={"max_depth": 2, "n_estimators": 2})
    got = out.agg(F.count("*"), F.countDistinct("k"), F.max("prediction")).first()
    assert got[0] == 400 and got[1] == 40 and got[2] < 100     # no training label from after the split


def test_ar_fit_with_many_lags(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from tidemark.operators.forecast import ar_fit
    rng = np.random.default_rng(1)
    v = np.zeros(600)
    for i in range(2, 600):
        v[i] = 1.0 + 0.5 * v[i - 1] - 0.2 * v[i - 2] + rng.normal()
    df = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate(v)], "k string, s long, v double").select("k", F.timestamp_seconds("s").alias("t"), "v")
    got = ar_fit(df, "k", "t", "v", 2).first()
    x = np.column_stack([np.ones(598), v[1:-1], v[:-2]])
    assert np.allclose(got["coef"], np.linalg.lstsq(x, v[2:], rcond=None)[0], atol=1e-3) and got["n_train"] == 598
    assert len(ar_fit(df, "k", "t", "v", 120).first()["coef"]) == 121


def test_stored_table_follows_its_input(spark, tmpdir_fresh):
    from tidemark import session
    path = tmpdir_fresh + "/in.parquet"
    read = lambda: session.stored(spark, "t", tmpdir_fresh, lambda: spark.read.parquet(path), [path]).count()
    spark.range(500).write.parquet(path)
    assert read() == read() == 500
    spark.range(500).write.mode("append").parquet(path)
    assert read() == 1000
    assert session.input_state(spark, [path]) == session.input_state(spark, [path])


@pytest.mark.parametrize("most", [1 << 20, 150, 0])
def test_tfidf_of_repeated_and_null_ids(spark, monkeypatch, most):
    """Whatever part of the vocabulary is broadcast, rows of one id (null is one) are one document."""
    import math
    from collections import Counter
    from tidemark.operators import textml
    monkeypatch.setattr(textml, "MAX_BROADCAST_BYTES", most)
    rows = [(1, "aa bb bb"), (1, "aa cc"), (2, "aa bb"), (2, "aa bb"), (3, ""), (4, None), (None, "aa dd"), (None, "dd ee"), (5, "aa bb")]
    docs = {}
    for i, t in rows:
        docs.setdefault(i, Counter()).update((t or "").split())
    df = Counter(t for d in docs.values() for t in d)
    idf = {t: math.log((1 + 5) / (1 + k)) + 1 for t, k in df.items()}      # a null id is not counted
    norm = {i: math.sqrt(sum((k * idf[t]) ** 2 for t, k in d.items())) for i, d in docs.items()}
    want = {(i, t): (k, df[t], pytest.approx(k * idf[t] / norm[i])) for i, d in docs.items() for t, k in d.items()}
    for part in (rows, [r for r in rows if r[0] == 5]):
        out = tfidf(spark.createDataFrame(part, "id long, text string"), "id", "text").collect()
        assert len(out) == len({(r["id"], r["term"]) for r in out})
        if part is rows:
            assert {(r["id"], r["term"]): (r["tf"], r["df"], r["tfidf"]) for r in out} == want


def test_tfidf_shuffles_texts_not_terms(spark):
    """Terms are counted, weighed and normed where the texts of their id are: one exchange by id."""
    df = spark.createDataFrame([(i, f"common word{i} word{i % 7}") for i in range(50)], "id long, text string")
    plan = tfidf(df, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_k") == 1 and "Window" not in plan and plan.count("hashpartitioning(term") == 0
