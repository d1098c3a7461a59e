"""E2 on trees, exogenous inputs, noise, and the Gram sums of the autoregression against plain Python."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.forecast import ar_fit, ar_forecast
from tidemark.operators.trees import NODE_SCHEMA, node_table, pack, predict, tree_fit, tree_forecast


def _series(spark, n=260, keys=("a", "b")):
    rng = np.random.default_rng(3)
    rows = []
    for j, k in enumerate(keys):
        v = np.cumsum(rng.normal(size=n)) + 20 * j
        x = rng.normal(size=n)
        rows += [(k, i, float(v[i] + 2 * x[i]), float(x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, s long, v double, x double")
    return df.select("k", F.timestamp_seconds(F.col("s") * 3600).alias("t"), "v", "x"), rows


def test_tree_forecast_equals_the_model_step_by_step(spark):
    from pyspark.ml.linalg import Vectors
    df, rows = _series(spark)
    p, steps = 5, 12
    model = tree_fit(df, "k", "t", "v", p, ["x"], {"max_depth": 3, "n_estimators": 6, "learning_rate": 0.3})
    nodes = node_table(model)
    for restart in (False, True):
        got = {(r["k"], r["step"]): r["prediction"] for r in tree_forecast(df, "k", "t", "v", p, steps, ["x"], nodes=nodes, restart=restart).collect()}
        assert len(got) == 2 * steps
        for k in ("a", "b"):
            v, x = [r[2] for r in rows if r[0] == k], [r[3] for r in rows if r[0] == k][-1]
            lags = (v[:-1] if restart else v)[::-1][:p]
            for s in range(1, steps + 1):
                want = model.predict(Vectors.dense([*lags, x, sum(v) / len(v)]))
                assert got[(k, s)] == pytest.approx(want, rel=1e-12)
                lags = [want, *lags[:-1]]


def test_predict_missing_values_and_single_leaf(spark):
    nodes = spark.createDataFrame([(0, 0, 0, 1.0, 1, 2, 0.0, 2.0), (0, 1, -1, 0.0, -1, -1, 5.0, 2.0), (0, 2, -1, 0.0, -1, -1, 7.0, 2.0),
                                   (3, 0, -1, 0.0, -1, -1, 0.25, 1.0)], NODE_SCHEMA)
    x = spark.createDataFrame([(0, 1.0), (1, 1.5), (2, None), (3, float("nan"))], "i int, x double")
    out = x.withColumn("m", pack(nodes)).select("i", predict(F.col("m"), lambda f: F.get(F.array("x"), f)).alias("y"))
    assert {r["i"]: r["y"] for r in out.collect()} == {0: 10.25, 1: 14.25, 2: 14.25, 3: 14.25}


def _noise(key, step, seed=42):
    u = [(int(hashlib.md5(f"{key}|{seed}|{step}|{n}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32 for n in (1, 2)]
    return math.sqrt(-2 * math.log(u[0])) * math.cos(2 * math.pi * u[1])


def test_noise_is_fed_back_and_reruns_agree(spark):
    df, rows = _series(spark, 20)
    coef = spark.createDataFrame([("a", [1.0, 0.5, 0.25, 2.0]), ("b", [0.0, 1.0, 0.0, 0.0])], "k string, coef array<double>")
    run = lambda d: {(r["k"], r["step"]): r["prediction"] for r in ar_forecast(d, "k", "t", "v", 2, 6, coef=coef, exog=["x"], noise={"a": 0.1}, default_noise=0.3).collect()}
    got = run(df)
    assert got == run(df.repartition(5))
    for k, c, s in (("a", [1.0, 0.5, 0.25, 2.0], 0.1), ("b", [0.0, 1.0, 0.0, 0.0], 0.3)):
        v, x = [r[2] for r in rows if r[0] == k], [r[3] for r in rows if r[0] == k][-1]
        l1, l2 = v[-1], v[-2]
        for i in range(1, 7):
            y = (c[0] + c[1] * l1 + c[2] * l2 + c[3] * x) * (1 + s * _noise(k, i))
            assert got[(k, i)] == pytest.approx(y, rel=1e-9)
            l1, l2 = y, l1


@pytest.mark.parametrize("seg_rows", [None, 40])
def test_arx_fit_equals_least_squares(spark, seg_rows):
    df, rows = _series(spark, 300, ("a", None))
    hole = (F.col("k") == "a") & (F.unix_seconds("t") == 150 * 3600)
    df = df.withColumn("v", F.when(~F.coalesce(hole, F.lit(False)), F.col("v"))).withColumn("x", F.when(F.unix_seconds("t") != 77 * 3600, F.col("x")))
    p = 7
    got = {r["k"]: r for r in ar_fit(df, "k", "t", "v", p, exog=["x"], seg_rows=seg_rows).collect()}
    assert set(got) == {"a", None}
    for k in ("a", None):
        v, x = ([r[j] for r in rows if r[0] == k] for j in (2, 3))
        if k == "a":
            v[150] = None
        x[77] = None
        use = [i for i in range(p, 300) if x[i] is not None and all(y is not None for y in v[i - p: i + 1])]
        m = np.array([[1, *v[i - p: i][::-1], x[i]] for i in use])
        want = np.linalg.lstsq(m, np.array([v[i] for i in use]), rcond=None)[0]
        assert got[k]["n_train"] == len(use) and np.allclose(got[k]["coef"], want, atol=2e-3)


def test_short_and_empty_series_have_no_forecast(spark):
    df, _ = _series(spark, 30)
    few = df.where("k = 'a' or unix_seconds(t) < 3 * 3600")
    assert {r["k"] for r in ar_forecast(few, "k", "t", "v", 5, 2).select("k").distinct().collect()} == {"a"}
    assert ar_fit(df.where("false"), "k", "t", "v", 3).count() == 0
    late = df.withColumn("v", F.when(F.unix_seconds("t") < 29 * 3600, F.col("v")))      # a null among the last lags
    assert ar_forecast(late, "k", "t", "v", 5, 2).count() == 0


def test_horizon_without_training_rows_is_null(spark):
    from tidemark.operators.forecast import gbt_forecast
    df, _ = _series(spark, 60)
    out = gbt_forecast(df, "k", "t", "v", 3, ["x"], [1, 500], "1970-01-02 12:00:00", {"max_depth": 2, "n_estimators": 2})
    got = {r["horizon"]: r for r in out.groupBy("horizon").agg(F.count("*").alias("n"), F.count("prediction").alias("p")).collect()}
    assert got[1]["p"] == got[1]["n"] == got[500]["n"] == 48 and got[500]["p"] == 0
