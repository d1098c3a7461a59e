"""Time-series operators: hand fixtures and segmented == whole-series windows."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import series as S

T0 = dt.datetime(2024, 1, 1)


def hours(vals, key="A", step=1, start=T0):
    return [(key, start + dt.timedelta(hours=i * step), v) for i, v in enumerate(vals)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "token string, ts timestamp, v double")


def col_by_ts(df, c="v"):
    return [r[c] for r in df.orderBy("token", "ts").collect()]


NULLS = [None, 1.0, None, None, 4.0, None]


def test_ffill_fixture(spark):
    assert col_by_ts(S.ffill(frame(spark, hours(NULLS)), "token", "ts", ["v"])) == [None, 1, 1, 1, 4, 4]


def test_fill_both_parity_and_nearest(spark):
    df = frame(spark, hours(NULLS))
    assert col_by_ts(S.fill_both(df, "token", "ts", ["v"], "bfill_ffill")) == [1, 1, 4, 4, 4, 4]
    assert col_by_ts(S.fill_both(df, "token", "ts", ["v"], "nearest")) == [1, 1, 1, 4, 4, 4]


def test_resample_and_interpolate(spark):
    days = [("A", T0 + dt.timedelta(days=i), v) for i, v in enumerate([None, 1.0, 4.0, None])]
    df = frame(spark, days)
    grid = S.resample_hourly(df, "token", "ts", ["v"])
    assert grid.count() == 73
    out = col_by_ts(S.interpolate(grid, "token", "ts", ["v"]))
    assert all(x is None for x in out[:24])
    assert out[24] == 1.0 and out[25] == pytest.approx(1.125)
    assert all(x == 4.0 for x in out[48:])


def test_interpolate_keeps_known_points(spark):
    days = [("A", T0 + dt.timedelta(days=i), float(i * i)) for i in range(5)]
    df = frame(spark, days)
    out = S.interpolate(S.resample_hourly(df, "token", "ts", ["v"]), "token", "ts", ["v"])
    known = {r["ts"]: r["v"] for r in out.collect()}
    for _, ts, v in days:
        assert known[ts] == v


def test_rolling_mean_fixture(spark):
    df = frame(spark, hours([1.0, 2.0, None, 4.0, 5.0]))
    out = col_by_ts(S.rolling_mean(df, "token", "ts", ["v"], 2), "v_ma2")
    assert out == [None, 1.5, None, None, 4.5]


def test_rolling_mean_exact_scale(spark):
    df = frame(spark, hours([0.1, 0.2, 0.3, 0.4]))
    out = col_by_ts(S.rolling_mean(df, "token", "ts", ["v"], 3, scale=6), "v_ma3")
    assert out[2] == pytest.approx(0.2) and out[3] == pytest.approx(0.3)


def test_gaps_fixture(spark):
    rows = [("A", T0, 1.0), ("A", T0 + dt.timedelta(hours=1), 1.0), ("A", T0 + dt.timedelta(hours=3), 1.0)]
    out = S.gaps(frame(spark, rows), "token", "ts", 3600).collect()
    assert len(out) == 1 and out[0]["ts"] == T0 + dt.timedelta(hours=3) and out[0]["gap_seconds"] == 7200


def test_minmax_constant_and_inverse(spark):
    df = frame(spark, hours([2.0, 2.0]) + hours([1.0, 3.0, 5.0], key="B"))
    out = S.minmax_scale(df, "token", ["v"])
    rows = {(r["token"], r["v"]): r for r in out.collect()}
    assert rows[("A", 2.0)]["v_scaled"] == 0.0
    assert rows[("B", 3.0)]["v_scaled"] == 0.5
    back = out.select(S.inverse_minmax("v_scaled", "v_min", "v_max").alias("b"), "v").collect()
    assert all(r["b"] == pytest.approx(r["v"]) for r in back)


def test_last_n(spark):
    df = frame(spark, hours([1.0, 2.0, 3.0, 4.0]))
    assert col_by_ts(S.last_n(df, "token", "ts", 2)) == [3.0, 4.0]


def test_lag_array_fixture(spark):
    df = frame(spark, hours([1.0, 2.0, 3.0, 4.0]))
    out = S.lag_array(df, "token", "ts", "v", 2).orderBy("ts").collect()
    assert [r["lags"] for r in out] == [None, None, [2.0, 1.0], [3.0, 2.0]]


# ------------------------------------------------------------------ segmented
def _random_series(seed, n_keys=3, n=40):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        t = T0
        for i in range(n):
            t += dt.timedelta(hours=rnd.choice([1, 1, 1, 2, 5]))
            v = None if rnd.random() < 0.25 else round(rnd.uniform(0, 100), 2)
            rows.append((f"K{k}", t, v))
    return rows


def _pandas(rows):
    return pd.DataFrame(rows, columns=["token", "ts", "v"]).sort_values(["token", "ts"])


@pytest.mark.parametrize("seg_rows", [3, 7, 1 << 16])
def test_segmented_windows_equal_whole_series(spark, seg_rows):
    rows = _random_series(seg_rows)
    df = frame(spark, rows)
    pdf = _pandas(rows)
    kw = dict(seg_rows=seg_rows, bucket_seconds=3600)
    g = pdf.groupby("token")["v"]
    # forward fill / both sides
    ff = S.ffill(df, "token", "ts", ["v"], **kw).orderBy("token", "ts").toPandas()["v"].tolist()
    exp = g.ffill().tolist()
    assert [None if (x is None or (isinstance(x, float) and math.isnan(x))) else x for x in ff] == \
        [None if pd.isna(x) else x for x in exp]
    fb = S.fill_both(df, "token", "ts", ["v"], **kw).orderBy("token", "ts").toPandas()["v"].tolist()
    exp = pdf.assign(v=g.bfill()).assign(v=lambda d: d["v"].fillna(g.ffill())).v.tolist()
    assert [None if pd.isna(x) else x for x in fb] == [None if pd.isna(x) else x for x in exp]
    # rolling mean over 4 rows, full windows only
    rm = S.rolling_mean(df, "token", "ts", ["v"], 4, **kw).orderBy("token", "ts").toPandas()["v_ma4"]
    exp = g.transform(lambda s: s.rolling(4).mean())
    for a, b in zip(rm.tolist(), exp.tolist()):
        assert (pd.isna(a) and pd.isna(b)) or a == pytest.approx(b)
    # lags 1..5 as one array
    la = S.lag_array(df.na.drop(subset=["v"]), "token", "ts", "v", 5, **kw).orderBy("token", "ts").collect()
    nn = pdf.dropna(subset=["v"])
    for (_, grp) in nn.groupby("token"):
        vals = grp["v"].tolist()
        got = [r["lags"] for r in la if r["token"] == grp["token"].iloc[0]]
        for i, arr in enumerate(got):
            assert arr == (None if i < 5 else [vals[i - j] for j in range(1, 6)])
    # positions
    pos = S.with_position(df, "token", "ts", **kw).orderBy("token", "ts").collect()
    exp_pos = pdf.groupby("token").cumcount().tolist()
    assert [r["pos"] for r in pos] == exp_pos


def test_sequences_shape(spark):
    rows = hours([float(i) for i in range(10)])
    df = spark.createDataFrame([(k, t, v, v * 2) for k, t, v in rows], "token string, ts timestamp, a double, b double")
    out = S.sequences(df, "token", "ts", ["a", "b"], "a", 3, seg_rows=4).orderBy("ts").collect()
    assert len(out) == 7
    assert out[0]["x"] == [[0.0, 0.0], [1.0, 2.0], [2.0, 4.0]] and out[0]["y"] == 3.0


@pytest.mark.parametrize("seg_rows", [4, 1 << 12])
def test_sequences_by_reference_equal_copies(spark, seg_rows):
    import numpy as np
    from tidemark.operators import sequences as Q
    rows = hours([float(i) for i in range(40)]) + hours([None] + [3.0 * i for i in range(6)], key="A2")
    df = spark.createDataFrame([(k, t, v, (v or 0.0) * 2) for k, t, v in rows], "token string, ts timestamp, a double, b double")
    name = rows[0][0]
    lengths = spark.createDataFrame([(name, 7)], "token string, L int")
    blocks = Q.sequence_blocks(df, "token", "ts", ["a", "b"], "a", 7, seg_rows=seg_rows)
    blocks = Q.with_lengths(blocks, "token", lengths, "L", 3)
    want = S.sequences(df, "token", "ts", ["a", "b"], "a", "L", lengths=lengths.union(spark.createDataFrame([(name + "2", 3)], "token string, L int")),
                       max_length=7, seg_rows=seg_rows).collect()
    want = {(r["token"], r["ts"]): (r["x"], r["y"]) for r in want}
    assert len(want) == 33 + 4

    def flat(about, x, y):
        return about.assign(y=y, x=[v.ravel().tolist() for v in x])

    got = Q.read_sequences(blocks, "token", "L", flat, "token string, ts timestamp, y double, x array<double>", batch_rows=5).collect()
    assert len(got) == len(want)
    for r in got:
        x, y = want[r["token"], r["ts"]]
        assert np.array_equal(np.array(x, float).ravel(), np.array(r["x"], float), equal_nan=True) and r["y"] == y
    ends = Q.sequence_rows(blocks, "token", "L", {"oldest": 0, "newest": -1}).collect()
    assert {(r["token"], r["ts"]): (r["oldest"], r["newest"], r["y"]) for r in ends} == {k: (x[0], x[-1], y) for k, (x, y) in want.items()}
    assert Q.sequence_blocks(df.where("a < -1"), "token", "ts", ["a"], "a", 7).count() == 0


def test_plan_has_no_python_udf(spark):
    df = frame(spark, hours([1.0, None, 3.0]))
    plan = S.fill_both(df, "token", "ts", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_future_from_last(spark):
    df = frame(spark, hours([1.0, 2.0, 3.0, 4.0]))
    out = S.future_from_last(df, "token", "ts", 2).orderBy("ts").collect()
    assert [(r["ts"], r["v"]) for r in out] == [(T0 + dt.timedelta(hours=4), 3.0), (T0 + dt.timedelta(hours=5), 4.0)]


@pytest.mark.parametrize("seg_rows", [2, 1 << 16])
def test_leads_equal_shift(spark, seg_rows):
    df = frame(spark, hours([1.0, 2.0, 3.0, 4.0, 5.0]))
    out = S.leads(df, "token", "ts", "v", [1, 2], seg_rows=seg_rows).orderBy("ts").collect()
    assert [r["v_lead1"] for r in out] == [2.0, 3.0, 4.0, 5.0, None]
    assert [r["v_lead2"] for r in out] == [3.0, 4.0, 5.0, None, None]


def test_hot_key_segments_are_bounded(spark):
    """One key holds most rows: every (key, segment) window partition stays
    within seg_rows + halo rows (+ one hour bucket), and results still match."""
    rows = [("HOT", T0 + dt.timedelta(hours=i), float(i)) for i in range(300)]
    rows += [("COLD", T0 + dt.timedelta(hours=i), float(i)) for i in range(10)]
    df = frame(spark, rows)
    seg_rows, halo = 32, 5
    seg, _ = S.segmented(df, "token", "ts", halo=halo, seg_rows=seg_rows)
    sizes = [r["c"] for r in seg.groupBy("token", "_tseg").agg(F.count(F.lit(1)).alias("c")).collect()]
    assert max(sizes) <= seg_rows + halo + 1 and len(sizes) >= 300 // seg_rows
    own = seg.filter(~F.col("_halo")).count()
    assert own == len(rows)
    lagged = S.lags(df, "token", "ts", "v", [5], seg_rows=seg_rows).filter("token = 'HOT'").orderBy("ts").collect()
    assert [r["v_lag5"] for r in lagged] == [None] * 5 + [float(i) for i in range(295)]


def test_upsample_interpolate_equals_grid_then_fill(spark):
    days = [("A", T0 + dt.timedelta(days=i), v) for i, v in enumerate([None, 1.0, None, 4.0, None, 2.0, None])]
    days += [("B", T0 + dt.timedelta(days=i), None) for i in range(2)]
    days += [("C", T0 + dt.timedelta(days=0), 5.0)]
    df = frame(spark, days)
    a = S.upsample_interpolate(df, "token", "ts", "v")
    b = S.interpolate(S.resample_hourly(df, "token", "ts", ["v"]), "token", "ts", ["v"])
    ra = sorted((r["token"], r["ts"], r["v"]) for r in a.collect())
    rb = sorted((r["token"], r["ts"], r["v"]) for r in b.collect())
    assert len(ra) == len(rb) == 145 + 25 + 1
    for x, y in zip(ra, rb):
        assert x[:2] == y[:2] and ((x[2] is None and y[2] is None) or x[2] == pytest.approx(y[2]))


def test_null_keys_and_times_are_kept(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import series as S
    rows = [("a", "2024-01-01 00:00:00", 1.0), ("a", None, 2.0), (None, "2024-01-01 01:00:00", 3.0), (None, None, 4.0)]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    assert S.ffill(df, "k", "t", "v").count() == 4
    assert S.fill_both(df, "k", "t", "v").count() == 4
    assert S.rolling_mean(df, "k", "t", "v", 2).count() == 4
    assert S.with_position(df, "k", "t", seg_rows=1).count() == 4
    assert S.minmax_scale(df, "k", "v").where("v_scaled is not null").count() == 4


def test_dense_and_sparse_stretches_match_one_segment(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import series as S
    dense = spark.range(300).select(F.timestamp_seconds(F.col("id")).alias("t"), F.col("id"))
    sparse = spark.range(300, 340).select(F.timestamp_seconds(F.col("id") * 100_000).alias("t"), F.col("id"))
    df = dense.union(sparse).select(F.lit("a").alias("k"), "t", F.when(F.col("id") % 7 == 3, F.col("id") * 1.0).alias("v"))
    whole = S.fill_both(df, "k", "t", "v", "nearest").orderBy("t").collect()
    assert S.fill_both(df, "k", "t", "v", "nearest", seg_rows=20).orderBy("t").collect() == whole


def test_upsample_leaves_out_points_off_the_grid(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import series as S
    rows = [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 00:30:00", 9.0), ("a", "2024-01-01 02:00:00", 3.0)]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    fast = S.upsample_interpolate(df, "k", "t", "v").orderBy("t").collect()
    slow = S.interpolate(S.resample_hourly(df, "k", "t", ["v"]), "k", "t", ["v"]).orderBy("t").select("k", "t", "v").collect()
    assert fast == slow and [r["v"] for r in fast] == [1.0, 2.0, 3.0]


def test_long_gap_is_filled_in_runs(spark):
    from pyspark.sql import functions as F
    from tidemark.operators import series as S
    n = 3 * S.RUN_STEPS + 5
    df = spark.createDataFrame([("a", 0, 0.0), ("a", n * 3600, float(n))], "k string, s long, v double")
    out = S.upsample_interpolate(df.select("k", F.timestamp_seconds("s").alias("t"), "v"), "k", "t", "v")
    got = [r["v"] for r in out.orderBy("t").collect()]
    assert len(got) == n + 1 and all(abs(x - i) < 1e-6 for i, x in enumerate(got))


def test_backward_fill_is_linear(spark):
    import time
    from pyspark.sql import functions as F
    from tidemark.operators import series as S
    df = spark.range(40_000).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("t"),
                                    F.when(F.col("id") % 50 == 0, F.col("id") * 1.0).alias("v"))
    def timed(f):
        t = time.time()
        f(df, "k", "t", "v").write.format("noop").mode("overwrite").save()
        return time.time() - t
    timed(S.ffill)
    assert timed(S.bfill) < 3 * timed(S.ffill) + 3
