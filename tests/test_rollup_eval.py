"""Rollups, correlation, evaluation and forecasting against hand fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.correlate import corr_base
from tidemark.operators.evaluate import class_report, error_metrics
from tidemark.operators.forecast import ar_fit, ar_forecast, ar_recursion
from tidemark.operators.rollup import label_pivot, sentiment_daily

T0 = dt.datetime(2024, 1, 1)


def test_label_pivot_fixture(spark):
    df = spark.createDataFrame([(T0, "a", 1), (T0, "a", 1), (T0, None, 1)], "ts timestamp, token string, label int")
    out = label_pivot(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["token"], r["count_negative"], r["count_positive"], r["count_total"]) == ("a", 0, 2, 2)


def test_sentiment_daily_excludes_unknown(spark):
    df = spark.createDataFrame([(T0, "btc", 1), (T0, "btc", -1), (T0, "btc", None)],
                               "ts timestamp, token string, label int")
    r = sentiment_daily(df).first()
    assert (r["token"], r["total_count"], r["percentage_positive"]) == ("BTC", 2, 50.0)


def test_corr_position_mode_and_argmax(spark):
    rows = [("X", T0 + dt.timedelta(hours=i), v) for i, v in enumerate([1.0, 2.0, 3.0])]
    rows += [("BTC", T0 + dt.timedelta(hours=10 + i), v) for i, v in enumerate([3.0, 5.0, 9.0, 1.0])]
    df = spark.createDataFrame(rows, "token string, ts timestamp, price double")
    out = corr_base(df, bases=["BTC", "ETH"], align="position").collect()
    r = {x["base"]: x for x in out}
    assert r["BTC"]["r"] == pytest.approx(0.981981, abs=1e-6)
    assert r["ETH"]["r"] is None and r["BTC"]["best"] == "BTC"


def test_argmax_null_ranks_last(spark):
    rows = [("X", T0 + dt.timedelta(hours=i), v) for i, v in enumerate([1.0, 2.0, 4.0])]
    rows += [("ETH", T0 + dt.timedelta(hours=i), v) for i, v in enumerate([2.0, 1.0, 3.0])]
    rows += [("BTC", T0 + dt.timedelta(hours=i + 100), 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "token string, ts timestamp, price double")
    out = corr_base(df, bases=["BTC", "ETH"]).collect()
    assert {x["best"] for x in out} == {"ETH"}


def test_class_report_fixture(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = {x["class"]: x for x in class_report(df).collect()}
    assert r["accuracy"]["f1"] == pytest.approx(0.666667, abs=1e-6)
    assert r["1"]["precision"] == 0.0 and r["1"]["recall"] == 0.0
    assert r["0"]["support"] == 2


def test_error_metrics(spark):
    df = spark.createDataFrame([("A", "m", 1.0, 2.0), ("A", "m", 3.0, 1.0), ("A", "n", None, 1.0)],
                               "token string, model string, actual double, prediction double")
    r = error_metrics(df).collect()
    assert len(r) == 1 and r[0]["n"] == 2
    assert r[0]["mae"] == 1.5 and r[0]["mse"] == 2.5 and r[0]["rmse"] == pytest.approx(2.5 ** 0.5)


def test_ar_recursion_fixture(spark):
    df = spark.createDataFrame([([0.0, 0.5, 0.5], [1.0, 2.0])], "coef array<double>, lags array<double>")
    out = df.select(ar_recursion(F.col("coef"), F.col("lags"), 3).alias("p")).first()["p"]
    assert out == pytest.approx([1.5, 1.25, 1.375])


def test_ar_fit_recovers_ar1(spark):
    import random
    rnd = random.Random(7)
    vals, x = [], 10.0
    for _ in range(400):
        x = 2.0 + 0.8 * x + rnd.gauss(0.0, 1.0)
        vals.append(x)
    rows = [("A", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "token string, ts timestamp, price double")
    coef = ar_fit(df, "token", "ts", "price", 1).first()["coef"]
    assert coef[1] == pytest.approx(0.8, abs=0.06) and coef[0] == pytest.approx(2.0, abs=0.6)
    fc = ar_forecast(df, "token", "ts", "price", 1, 5).orderBy("step").collect()
    assert len(fc) == 5 and fc[0]["ts"] == rows[-1][1] + dt.timedelta(hours=1)
    assert fc[0]["prediction"] == pytest.approx(coef[0] + coef[1] * vals[-1])


def test_unique_by_first_last_and_nulls(spark):
    from tidemark.operators.joins import unique_by
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", 2, "w")],
                               "k string, o int, v string")
    first = {r["k"]: r["v"] for r in unique_by(df, ["k"], ["o"]).collect()}
    assert first == {"a": "z", "b": "w"}            # ascending, nulls first
    first_nl = {r["k"]: r["v"] for r in unique_by(df, ["k"], ["o"], nulls_last=True).collect()}
    assert first_nl == {"a": "y", "b": "w"}
    last = {r["k"]: r["v"] for r in unique_by(df, ["k"], ["o"], keep="last").collect()}
    assert last == {"a": "x", "b": "w"}
    assert unique_by(df, ["k"], ["o"]).columns == ["k", "o", "v"]


def test_pearson_constant_series_is_null_not_error(spark):
    from tidemark.operators.profile import corr_vector
    df = spark.createDataFrame([("A", float(i), 1.0, float(2 * i)) for i in range(5)],
                               "token string, price double, n double, v double")
    r = {x["feature"]: x["r"] for x in corr_vector(df, "token", "price", ["n", "v"]).collect()}
    assert r["n"] is None and r["v"] == pytest.approx(1.0)


def test_ar_forecast_scaled_matches_unscaled_linear_series(spark):
    """On an exact AR(1) series the scaled path recovers the same forecast as
    the direct one (scaling is affine, AR with intercept absorbs it)."""
    from tidemark.operators.forecast import ar_forecast_scaled
    vals, x = [], 50.0
    for _ in range(200):
        x = 5.0 + 0.9 * x
        vals.append(x + (0.5 if len(vals) % 3 == 0 else -0.25))
    rows = [("A", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "token string, ts timestamp, price double")
    a = [r["prediction"] for r in ar_forecast(df, "token", "ts", "price", 3, 6).orderBy("step").collect()]
    b = [r["prediction"] for r in ar_forecast_scaled(df, "token", "ts", "price", 3, 6).orderBy("step").collect()]
    assert len(b) == 6 and b == pytest.approx(a, rel=1e-3)
