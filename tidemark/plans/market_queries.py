"""Registered queries over the market-like bindings (MKT, DAY, SENT, VOL, PRED).

Every output column is aliased identically in Spark and SQL; averages are
rounded to 6 places (window means to 4) on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .bindings import with_ctes
from .composed import feature_table, hour_day_table, daily_to_hourly
from .registry import register
from ..functions.conditional import coalesce_cols
from ..functions.dates import day_windows
from ..functions.text import map_label, label_word, token_upper
from ..operators import series as S
from ..operators.correlate import base_price, corr_base
from ..operators.evaluate import ensemble, error_metrics, to_long
from ..functions.arrays import any_in_range_arr, sum_arr
from ..operators.joins import any_in_range, left_fill, metrics_wide, mixed_grain_join, semi, anti
from ..operators.profile import (corr_vector, feature_select, null_profile, rows_with_null,
                                 distinct_values)
from ..operators.rollup import label_pivot, sentiment_daily, sentiment_hourly
from ..operators.sequences import sequence_blocks, sequence_rows, with_lengths

R6 = 6


def _r(c, n=R6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# grid of MKT: every hour from first to last row per token, gaps null
B.add_cte("grid", """SELECT g.token, g.ts, m.price, m.volume, m.n FROM
  (SELECT token, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
   FROM (SELECT token, min(ts) lo, max(ts) hi FROM mkt GROUP BY token)) g
  LEFT JOIN mkt m ON g.token = m.token AND g.ts = m.ts""", ["mkt"])


def _grid(spark, sf):
    m = B.mkt_table(spark, sf)
    return S.resample_hourly(m, "token", "ts", ["price", "volume", "n"])


# ------------------------------------------------------------------ D4 / MKT
@register("floor_hour", with_ctes(["mkt"], "SELECT token, ts, price, volume, n FROM mkt"))
def q_floor_hour(spark, sf):
    return B.mkt(spark, sf)


@register("filter_eq", with_ctes(["mkt"], "SELECT token, ts, price FROM mkt WHERE token = 'T3'"))
def q_filter_eq(spark, sf):
    return B.mkt_table(spark, sf).filter(F.col("token") == "T3").select("token", "ts", "price")


@register("filter_time", with_ctes(["mkt"],
          "SELECT token, ts, price FROM mkt WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'"))
def q_filter_time(spark, sf):
    return (B.mkt_table(spark, sf).filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp"))
            .select("token", "ts", "price"))


@register("time_split", with_ctes(["mkt"], """SELECT token, CASE WHEN ts < TIMESTAMP '2024-01-24 00:00:00'
    THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows, round(avg(price), 6) AS avg_price
    FROM mkt GROUP BY 1, 2"""))
def q_time_split(spark, sf):
    m = B.mkt_table(spark, sf)
    part = F.when(F.col("ts") < F.lit("2024-01-24 00:00:00").cast("timestamp"), "train").otherwise("test")
    return (m.withColumn("part", part).groupBy("token", "part")
            .agg(F.count(F.lit(1)).alias("n_rows"), _r(F.avg("price")).alias("avg_price")))


WANTED = ["price", "active_addresses", "volume", "mvrv"]


@register("project_existing", with_ctes(["mkt"], """SELECT token, ts, price, volume,
    CAST(NULL AS DOUBLE) AS active_addresses, CAST(NULL AS DOUBLE) AS mvrv FROM mkt"""))
def q_project_existing(spark, sf):
    m = B.mkt_table(spark, sf)
    have = [c for c in WANTED if c in m.columns]
    missing = [c for c in WANTED if c not in m.columns]
    return m.select("token", "ts", *have, *[F.lit(None).cast("double").alias(c) for c in missing])


# ------------------------------------------------------------------- W6 grid
@register("resample_hourly", with_ctes(["grid"], "SELECT token, ts, price, volume, n FROM grid"))
def q_resample(spark, sf):
    return _grid(spark, sf)


@register("rows_with_null", with_ctes(["grid"], """SELECT token, ts FROM grid
    WHERE price IS NULL OR volume IS NULL OR n IS NULL"""))
def q_rows_with_null(spark, sf):
    return rows_with_null(_grid(spark, sf), ["price", "volume", "n"]).select("token", "ts")


@register("dropna_subset", with_ctes(["grid"], "SELECT token, ts, price FROM grid WHERE price IS NOT NULL"))
def q_dropna(spark, sf):
    return _grid(spark, sf).na.drop(subset=["price"]).select("token", "ts", "price")


@register("null_profile", with_ctes(["grid"], """SELECT token, "column", n_rows, null_count,
    round(null_count / n_rows, 6) AS null_fraction, null_count / n_rows <= 0.3 AS keep FROM (
    SELECT token, count(*) AS n_rows, count(*) - count(price) AS np, count(*) - count(volume) AS nv,
           count(*) - count(n) AS nn FROM grid GROUP BY token) t,
    LATERAL (VALUES ('price', np), ('volume', nv), ('n', nn)) AS v("column", null_count)"""))
def q_null_profile(spark, sf):
    p = null_profile(_grid(spark, sf), "token", ["price", "volume", "n"], 0.3)
    return p.withColumn("null_fraction", _r("null_fraction"))


@register("gaps", with_ctes(["mkt"], """SELECT token, prev_ts, ts, gap_seconds FROM (
    SELECT token, ts, lag(ts) OVER (PARTITION BY token ORDER BY ts) AS prev_ts,
    CAST(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY token ORDER BY ts)) AS BIGINT) AS gap_seconds
    FROM mkt) WHERE gap_seconds > 3600"""))
def q_gaps(spark, sf):
    return S.gaps(B.mkt_table(spark, sf), "token", "ts", 3600)


@register("ffill", with_ctes(["grid"], """SELECT token, ts,
    last_value(price IGNORE NULLS) OVER w AS price, last_value(volume IGNORE NULLS) OVER w AS volume
    FROM grid WINDOW w AS (PARTITION BY token ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def q_ffill(spark, sf):
    return S.ffill(_grid(spark, sf).select("token", "ts", "price", "volume"), "token", "ts",
                   ["price", "volume"])


B.add_cte("grid_pos", """SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS pos,
    CASE WHEN price IS NOT NULL THEN row_number() OVER (PARTITION BY token ORDER BY ts) END AS kpos
    FROM grid""", ["grid"])


@register("fill_both", with_ctes(["grid_pos"], """SELECT token, ts,
    coalesce(price, first_value(price IGNORE NULLS) OVER wn, last_value(price IGNORE NULLS) OVER wp) AS price_bf,
    coalesce(price, CASE
      WHEN last_value(price IGNORE NULLS) OVER wp IS NULL THEN first_value(price IGNORE NULLS) OVER wn
      WHEN first_value(price IGNORE NULLS) OVER wn IS NULL THEN last_value(price IGNORE NULLS) OVER wp
      WHEN pos - last_value(kpos IGNORE NULLS) OVER wp <= first_value(kpos IGNORE NULLS) OVER wn - pos
        THEN last_value(price IGNORE NULLS) OVER wp
      ELSE first_value(price IGNORE NULLS) OVER wn END) AS price_near
    FROM grid_pos WINDOW
    wp AS (PARTITION BY token ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    wn AS (PARTITION BY token ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""))
def q_fill_both(spark, sf):
    g = _grid(spark, sf).select("token", "ts", "price")
    out = S.fill_modes(g, "token", "ts", "price", {"price_bf": "bfill_ffill", "price_near": "nearest"})
    return out.select("token", "ts", "price_bf", "price_near")


# daily series with every third day of the month removed, so interpolation has work
B.add_cte("day_holes", "SELECT * FROM day WHERE dayofmonth(d) % 3 <> 1", ["day"])
B.add_cte("day_hourly", """SELECT token, ts, CASE
      WHEN metric IS NOT NULL THEN metric
      WHEN pv IS NULL THEN NULL
      WHEN nv IS NULL THEN pv
      WHEN nt = pt THEN pv
      ELSE pv + (nv - pv) * (CAST(epoch_us(ts) - pt AS DOUBLE) / CAST(nt - pt AS DOUBLE)) END AS metric
    FROM (SELECT token, ts, metric,
      last_value(CASE WHEN metric IS NOT NULL THEN metric END IGNORE NULLS) OVER wp AS pv,
      last_value(CASE WHEN metric IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER wp AS pt,
      first_value(CASE WHEN metric IS NOT NULL THEN metric END IGNORE NULLS) OVER wn AS nv,
      first_value(CASE WHEN metric IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER wn AS nt
      FROM (SELECT g.token, g.ts, h.metric FROM
        (SELECT token, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM
          (SELECT token, CAST(min(d) AS TIMESTAMP) lo, CAST(max(d) AS TIMESTAMP) hi FROM day_holes GROUP BY token)) g
        LEFT JOIN day_holes h ON g.token = h.token AND g.ts = CAST(h.d AS TIMESTAMP))
      WINDOW wp AS (PARTITION BY token ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             wn AS (PARTITION BY token ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
          ["day_holes"])


def _day_holes(spark, sf):
    return B.day_table(spark, sf).filter(F.dayofmonth("d") % 3 != 1)


@register("interpolate", with_ctes(["day_hourly"], "SELECT token, ts, metric FROM day_hourly"))
def q_interpolate(spark, sf):
    dh = daily_to_hourly(_day_holes(spark, sf), "token", "d", ["metric"])
    return dh.select("token", "ts", "metric")


@register("interpolate_general", with_ctes(["day_hourly"], "SELECT token, ts, metric FROM day_hourly"))
def q_interpolate_general(spark, sf):
    """W6 then W7 as two operators, with segments small enough that every token has several."""
    d = _day_holes(spark, sf).select("token", F.col("d").cast("timestamp").alias("ts"), "metric")
    grid = S.resample_hourly(d, "token", "ts", ["metric"])
    return S.interpolate(grid, "token", "ts", ["metric"], seg_rows=100)


@register("fill_segments", with_ctes(["grid"], """SELECT token, ts,
    last_value(price IGNORE NULLS) OVER wp AS price_f, first_value(price IGNORE NULLS) OVER wn AS price_b,
    count(*) OVER wp - 1 AS pos FROM grid WINDOW
    wp AS (PARTITION BY token ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    wn AS (PARTITION BY token ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""))
def q_fill_segments(spark, sf):
    """Fills and positions over series of many segments (the carry between them is what it checks)."""
    g = _grid(spark, sf).select("token", "ts", "price")
    out = S.known_neighbours(g, "token", "ts", {"price": F.col("price")}, seg_rows=50)
    return out.select("token", "ts", F.col("price_prev").alias("price_f"), F.col("price_next").alias("price_b"),
                      F.col("_pos").alias("pos"))


@register("hour_day_join", with_ctes(["mkt", "day_hourly"], """SELECT m.token, m.ts, m.price, m.volume, m.n,
    h.metric FROM mkt m LEFT JOIN day_hourly h ON m.token = h.token AND m.ts = h.ts
    WHERE m.price IS NOT NULL"""))
def q_hour_day_join(spark, sf):
    out = hour_day_table(B.mkt_table(spark, sf), _day_holes(spark, sf), "token", "d", ["metric"])
    return out.select("token", "ts", "price", "volume", "n", "metric")


# ------------------------------------------------------------- row windows
@register("rolling_mean_336", with_ctes(["mkt"], """SELECT token, ts, price,
    round(CASE WHEN count(price) OVER w >= 336 THEN avg(price) OVER w END, 4) AS price_ma336
    FROM mkt WINDOW w AS (PARTITION BY token ORDER BY ts ROWS BETWEEN 335 PRECEDING AND CURRENT ROW)"""))
def q_rolling336(spark, sf):
    out = S.rolling_mean(B.mkt_table(spark, sf).select("token", "ts", "price"), "token", "ts", ["price"], 336)
    return out.withColumn("price_ma336", _r("price_ma336", 4))


@register("rolling7_diff", with_ctes(["mkt"], """SELECT token, ts, price,
    round(coalesce(CASE WHEN count(price) OVER w7 >= 7 THEN avg(price) OVER w7 END,
                   avg(price) OVER (PARTITION BY token)), 4) AS price_ma7,
    round(coalesce(price - lag(price) OVER w, 0.0), 6) AS price_diff
    FROM mkt WINDOW w AS (PARTITION BY token ORDER BY ts),
    w7 AS (PARTITION BY token ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def q_rolling7(spark, sf):
    out = S.rolling_diff(B.mkt_table(spark, sf).select("token", "ts", "price"), "token", "ts", "price", 7)
    return out.select("token", "ts", "price", _r("price_ma7", 4).alias("price_ma7"),
                      _r("price_diff").alias("price_diff"))


N_LAGS = 500


@register("lag_features", with_ctes(["mkt"], f"""SELECT token, ts, price, {N_LAGS} AS n_lags,
    array_to_string(list_transform(list_reverse(lg), lambda x: CAST(CAST(x AS DECIMAL(18, 6)) AS VARCHAR)), ',') AS lags
    FROM (SELECT token, ts, price, count(*) OVER w AS c, count(price) OVER w AS cn, list(price) OVER w AS lg
          FROM mkt WINDOW w AS (PARTITION BY token ORDER BY ts ROWS BETWEEN {N_LAGS} PRECEDING AND 1 PRECEDING))
    WHERE c = {N_LAGS} AND cn = {N_LAGS}"""))
def q_lag_features(spark, sf):
    out = S.lag_array(B.mkt_table(spark, sf).select("token", "ts", "price"), "token", "ts", "price", N_LAGS)
    out = out.filter(F.col("lags").isNotNull())
    txt = F.array_join(F.transform("lags", lambda x: x.cast("decimal(18,6)").cast("string")), ",")
    return out.select("token", "ts", "price", F.lit(N_LAGS).alias("n_lags"), txt.alias("lags"))


@register("last_n", with_ctes(["mkt"], """SELECT token, ts, price FROM (
    SELECT token, ts, price, row_number() OVER (PARTITION BY token ORDER BY ts DESC) AS rn FROM mkt)
    WHERE rn <= 31"""))
def q_last_n(spark, sf):
    return S.last_n(B.mkt_table(spark, sf).select("token", "ts", "price"), "token", "ts", 31)


@register("minmax_scale", with_ctes(["mkt"], """SELECT token, ts, price,
    round(CASE WHEN max(price) OVER t = min(price) OVER t THEN 0.0
          ELSE (price - min(price) OVER t) / (max(price) OVER t - min(price) OVER t) END, 6) AS price_scaled,
    round((CASE WHEN max(price) OVER t = min(price) OVER t THEN 0.0
          ELSE (price - min(price) OVER t) / (max(price) OVER t - min(price) OVER t) END)
          * (max(price) OVER t - min(price) OVER t) + min(price) OVER t, 6) AS price_back
    FROM mkt WINDOW t AS (PARTITION BY token)"""))
def q_minmax(spark, sf):
    out = S.minmax_scale(B.mkt_table(spark, sf).select("token", "ts", "price"), "token", ["price"])
    back = S.inverse_minmax("price_scaled", "price_min", "price_max")
    return out.select("token", "ts", "price", _r("price_scaled").alias("price_scaled"),
                      _r(back).alias("price_back"))


@register("future_grid", with_ctes(["mkt"], """SELECT token, unnest(generate_series(
    last_ts + INTERVAL 1 HOUR, last_ts + INTERVAL 744 HOUR, INTERVAL 1 HOUR)) AS ts
    FROM (SELECT token, max(ts) AS last_ts FROM mkt GROUP BY token)"""))
def q_future_grid(spark, sf):
    last = B.mkt_table(spark, sf).groupBy("token").agg(F.max("ts").alias("_last"))
    b = last.select("token", (F.col("_last") + F.expr("INTERVAL 1 HOUR")).alias("start"),
                    (F.col("_last") + F.expr("INTERVAL 744 HOURS")).alias("end"))
    return S.hourly_grid(b, "token", "start", "end", "ts")


@register("sequences", with_ctes(["mkt"], """SELECT r.token, r.ts, r.price AS y, l.seq_len,
    [f.price, f.volume, CAST(f.n AS DOUBLE)] AS first_row, [p.price, p.volume, CAST(p.n AS DOUBLE)] AS last_row
  FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS i FROM mkt) r
  JOIN (SELECT unnest(['T0', 'T1', 'T2', 'T3', 'T4', 'T5', 'T6', 'T7']) AS token, unnest([24, 48, 72, 24, 48, 72, 24, 48]) AS seq_len) l
    ON l.token = r.token
  JOIN (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS i FROM mkt) f ON f.token = r.token AND f.i = r.i - l.seq_len
  JOIN (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS i FROM mkt) p ON p.token = r.token AND p.i = r.i - 1"""))
def q_sequences(spark, sf):
    m = B.mkt_table(spark, sf).select("token", "ts", "price", "volume", "n")
    lengths = spark.createDataFrame([(f"T{i}", L) for i, L in enumerate([24, 48, 72, 24, 48, 72, 24, 48])],
                                    "token string, seq_len int")
    out = S.sequences(m, "token", "ts", ["price", "volume", "n"], "price", "seq_len",
                      lengths=lengths, max_length=72)
    return out.select("token", "ts", "y", F.size("x").alias("seq_len"),
                      F.element_at("x", 1).alias("first_row"), F.element_at("x", -1).alias("last_row"))


@register("sequences_by_reference", with_ctes(["mkt"], """SELECT r.token, r.ts, r.price AS y, l.seq_len,
    [f.price, f.volume, CAST(f.n AS DOUBLE)] AS first_row, [p.price, p.volume, CAST(p.n AS DOUBLE)] AS last_row
  FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS i FROM mkt) r
  JOIN (SELECT unnest(['T0', 'T1', 'T2', 'T3', 'T4', 'T5', 'T6', 'T7']) AS token, unnest([240, 540, 720, 240, 540, 720, 240, 540]) AS seq_len) l
    ON l.token = r.token
  JOIN (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS i FROM mkt) f ON f.token = r.token AND f.i = r.i - l.seq_len
  JOIN (SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts) AS i FROM mkt) p ON p.token = r.token AND p.i = r.i - 1"""))
def q_sequences_by_reference(spark, sf):
    """W9 at lengths 240, 540 and 720, from blocks of a few hundred rows (several a token)."""
    m = B.mkt_table(spark, sf).select("token", "ts", "price", "volume", "n")
    lengths = spark.createDataFrame([(f"T{i}", L) for i, L in enumerate([240, 540, 720, 240, 540, 720, 240, 540])],
                                    "token string, seq_len int")
    blocks = sequence_blocks(m, "token", "ts", ["price", "volume", "n"], "price", 720, seg_rows=256)
    return sequence_rows(with_lengths(blocks, "token", lengths, "seq_len", 720), "token", "seq_len", {"first_row": 0, "last_row": -1})


# ------------------------------------------------------------- correlation
@register("corr_base", with_ctes(["mkt"], """SELECT token, base, r, best FROM (
    SELECT token, base, r, arg_max(base, (r IS NOT NULL, coalesce(r, 0.0), -bi)) OVER (PARTITION BY token) AS best
    FROM (SELECT k.token, b.base, b.bi, round(c.r, 6) AS r FROM
      (SELECT DISTINCT token FROM mkt WHERE token NOT IN ('T0', 'T1')) k
      CROSS JOIN (VALUES ('T0', 0), ('T1', 1)) b(base, bi)
      LEFT JOIN (SELECT o.token, bs.token AS base, corr(o.price, bs.price) AS r
                 FROM mkt o JOIN mkt bs ON o.ts = bs.ts
                 WHERE o.token NOT IN ('T0', 'T1') AND bs.token IN ('T0', 'T1') GROUP BY 1, 2) c
      ON c.token = k.token AND c.base = b.base))"""))
def q_corr_base(spark, sf):
    out = corr_base(B.mkt_table(spark, sf), "token", "ts", "price", ["T0", "T1"], "time")
    return out.select("token", "base", _r("r").alias("r"), "best")


B.add_cte("base_corr", """SELECT o.token, bs.token AS base, corr(o.price, bs.price) AS r
    FROM mkt o JOIN mkt bs ON o.ts = bs.ts
    WHERE o.token NOT IN ('T0', 'T1') AND bs.token IN ('T0', 'T1') GROUP BY 1, 2""", ["mkt"])
B.add_cte("base_best", """SELECT token, arg_max(base, (r IS NOT NULL, coalesce(r, 0.0),
    -(CASE base WHEN 'T0' THEN 0 ELSE 1 END))) AS base FROM base_corr GROUP BY token""", ["base_corr"])


@register("base_price", with_ctes(["mkt", "base_best"], """SELECT m.token, m.ts, m.price, b.base,
    bp.price AS base_price FROM mkt m
  LEFT JOIN base_best b ON m.token = b.token
  LEFT JOIN mkt bp ON bp.token = b.base AND bp.ts = m.ts
  WHERE b.base IS NULL OR bp.price IS NOT NULL"""))
def q_base_price(spark, sf):
    out = base_price(B.mkt_table(spark, sf).select("token", "ts", "price"), "token", "ts", "price", ["T0", "T1"])
    return out.select("token", "ts", "price", "base", "base_price")


@register("corr_vector", with_ctes(["mkt"], """SELECT token, feature, round(r, 6) AS r FROM (
    SELECT token, corr(price, volume) AS rv, corr(price, n) AS rn FROM mkt GROUP BY token) t,
    LATERAL (VALUES ('volume', rv), ('n', rn)) AS v(feature, r)"""))
def q_corr_vector(spark, sf):
    out = corr_vector(B.mkt_table(spark, sf), "token", "price", ["volume", "n"])
    return out.withColumn("r", _r("r"))


@register("feature_select", with_ctes(["mkt"], """SELECT token, feature FROM (
    SELECT token, corr(price, volume) AS rv, corr(price, n) AS rn FROM mkt GROUP BY token) t,
    LATERAL (VALUES ('volume', rv), ('n', rn)) AS v(feature, r) WHERE abs(r) >= 0.4
    UNION ALL SELECT DISTINCT token, 'price' AS feature FROM mkt"""))
def q_feature_select(spark, sf):
    cv = corr_vector(B.mkt_table(spark, sf), "token", "price", ["volume", "n"])
    return feature_select(cv, "token", "price", 0.4).select("token", "feature")


@register("distinct_tokens", with_ctes(["mkt"], "SELECT DISTINCT token FROM mkt"))
def q_distinct_tokens(spark, sf):
    return distinct_values(B.mkt_table(spark, sf), "token")


# ------------------------------------------------------------- sentiment
@register("label_pivot", with_ctes(["sent"], """SELECT ts, token,
    count(*) FILTER (WHERE label = -1) AS count_negative, count(*) FILTER (WHERE label = 1) AS count_positive,
    count(*) AS count_total FROM sent WHERE label IN (-1, 1) AND token IS NOT NULL GROUP BY ts, token"""))
def q_label_pivot(spark, sf):
    return label_pivot(B.sent(spark, sf), "ts", "token", "label")


B.add_cte("sent_hourly", """SELECT ts, upper(token) AS token,
    count(*) FILTER (WHERE label = -1) AS count_negative, count(*) FILTER (WHERE label = 1) AS count_positive,
    count(*) AS count_total,
    CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS percentage_positive
    FROM sent WHERE label IN (-1, 1) AND token IS NOT NULL GROUP BY ts, upper(token)""", ["sent"])
B.add_cte("sent_daily", """SELECT CAST(ts AS DATE) AS date, upper(token) AS token,
    count(*) FILTER (WHERE label = 1) AS count_positive, count(*) FILTER (WHERE label = -1) AS count_negative,
    count(*) AS total_count, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS percentage_positive
    FROM sent WHERE label IN (-1, 1) AND token IS NOT NULL GROUP BY 1, 2""", ["sent"])


@register("sentiment_hourly", with_ctes(["sent_hourly"], """SELECT ts, token, count_negative, count_positive,
    count_total, round(percentage_positive, 6) AS percentage_positive FROM sent_hourly"""))
def q_sentiment_hourly(spark, sf):
    return sentiment_hourly(B.sent(spark, sf)).withColumn("percentage_positive", _r("percentage_positive"))


@register("sentiment_daily", with_ctes(["sent_daily"], """SELECT date, token, count_positive, count_negative,
    total_count, round(percentage_positive, 6) AS percentage_positive FROM sent_daily"""))
def q_sentiment_daily(spark, sf):
    return sentiment_daily(B.sent(spark, sf)).withColumn("percentage_positive", _r("percentage_positive"))


@register("map_label", with_ctes(["sent"], """SELECT event_id, label,
    CASE label WHEN -1 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'unknown' END AS label_word,
    CASE event_type WHEN 'purchase' THEN 'LABEL_1' WHEN 'error' THEN 'LABEL_0' END AS raw_label,
    CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 END AS mapped
    FROM sent JOIN events USING (event_id)"""))
def q_map_label(spark, sf):
    s = B.sent(spark, sf).join(B.read(spark, sf, "events").select("event_id", "event_type"), "event_id")
    raw = map_label("event_type", {"purchase": "LABEL_1", "error": "LABEL_0"})
    from ..constants import CLASSIFIER_LABELS
    return s.select("event_id", "label", label_word("label").alias("label_word"), raw.alias("raw_label"),
                    map_label(raw, CLASSIFIER_LABELS).cast("int").alias("mapped"))


@register("token_upper", with_ctes(["sent"], """SELECT event_id, upper(lower(token)) AS token FROM sent"""))
def q_token_upper(spark, sf):
    return B.sent(spark, sf).select("event_id", token_upper(F.lower("token")).alias("token"))


@register("feat_join_hour", with_ctes(["mkt", "sent_hourly"], """SELECT m.token, m.ts, m.price,
    coalesce(s.count_positive, 0) AS count_positive, coalesce(s.count_negative, 0) AS count_negative,
    coalesce(s.count_total, 0) AS count_total,
    round(coalesce(s.percentage_positive, 0), 6) AS percentage_positive
    FROM mkt m LEFT JOIN sent_hourly s ON m.token = s.token AND m.ts = s.ts"""))
def q_feat_join_hour(spark, sf):
    sh = sentiment_hourly(B.sent(spark, sf))
    out = left_fill(B.mkt_table(spark, sf).select("token", "ts", "price"), sh, ["token", "ts"])
    return out.withColumn("percentage_positive", _r("percentage_positive"))


@register("mixed_grain", with_ctes(["mkt", "sent_daily"], """SELECT m.token, m.ts, m.price,
    coalesce(s.count_positive, 0) AS count_positive_news, coalesce(s.count_negative, 0) AS count_negative_news,
    coalesce(s.total_count, 0) AS total_count_news,
    round(coalesce(s.percentage_positive, 0), 6) AS percentage_positive_news
    FROM mkt m LEFT JOIN sent_daily s ON m.token = s.token AND CAST(m.ts AS DATE) = s.date"""))
def q_mixed_grain(spark, sf):
    sd = sentiment_daily(B.sent(spark, sf))
    out = mixed_grain_join(B.mkt_table(spark, sf).select("token", "ts", "price"), sd, "token", "ts", "date", "_news")
    return out.withColumn("percentage_positive_news", _r("percentage_positive_news"))


@register("ctx_join", with_ctes(["mkt", "sent_hourly"], """SELECT token, ts, price, count_total,
    last_value(general_total IGNORE NULLS) OVER (PARTITION BY token ORDER BY ts
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS general_total
    FROM (SELECT m.token, m.ts, m.price, s.count_total, g.general_total FROM mkt m
      LEFT JOIN sent_hourly s ON m.token = s.token AND m.ts = s.ts
      LEFT JOIN (SELECT ts, sum(count_total) AS general_total FROM sent_hourly
                 WHERE token IN ('T0', 'T1') GROUP BY ts) g ON m.ts = g.ts)"""))
def q_ctx_join(spark, sf):
    sh = sentiment_hourly(B.sent(spark, sf))
    general = (sh.filter(F.col("token").isin("T0", "T1")).groupBy("ts")
               .agg(F.sum("count_total").alias("general_total")))
    m = B.mkt_table(spark, sf).select("token", "ts", "price")
    j = (m.join(sh.select("token", "ts", "count_total"), ["token", "ts"], "left")
         .join(general, ["ts"], "left"))
    return S.ffill(j, "token", "ts", ["general_total"]).select(
        "token", "ts", "price", "count_total", "general_total")


# ------------------------------------------------------------- J1 / S9
@register("metric_long", with_ctes(["metric_long"], "SELECT d, token, metric, value FROM metric_long"))
def q_metric_long(spark, sf):
    return B.day_metric_long(spark, sf)


METRICS = ["view", "click", "purchase", "signup", "error"]


@register("outer_metrics", with_ctes(["metric_long"], "SELECT coalesce(v.d, c.d, p.d, s.d, e.d) AS d, "
          "coalesce(v.token, c.token, p.token, s.token, e.token) AS token, "
          "v.value AS view, c.value AS click, p.value AS purchase, s.value AS signup, e.value AS error FROM "
          "(SELECT d, token, value FROM metric_long WHERE metric = 'view') v "
          "FULL JOIN (SELECT d, token, value FROM metric_long WHERE metric = 'click') c USING (d, token) "
          "FULL JOIN (SELECT d, token, value FROM metric_long WHERE metric = 'purchase') p USING (d, token) "
          "FULL JOIN (SELECT d, token, value FROM metric_long WHERE metric = 'signup') s USING (d, token) "
          "FULL JOIN (SELECT d, token, value FROM metric_long WHERE metric = 'error') e USING (d, token)"))
def q_outer_metrics(spark, sf):
    return metrics_wide(B.day_metric_long(spark, sf), ["d", "token"], "metric", "value", METRICS)


# ------------------------------------------------------------- D7 windows
@register("day_windows", with_ctes(["sent"], """SELECT w.token, w.win_start, w.win_end, count(s.event_id) AS n_items
    FROM (SELECT token, unnest(generate_series(lo, hi, INTERVAL 2 DAY))::DATE AS win_start,
                 (unnest(generate_series(lo, hi, INTERVAL 2 DAY)) + INTERVAL 1 DAY)::DATE AS win_end
          FROM (SELECT token, min(CAST(ts AS DATE)) lo, max(CAST(ts AS DATE)) hi FROM sent GROUP BY token)) w
    LEFT JOIN sent s ON s.token = w.token AND s.label IS NOT NULL
      AND CAST(s.ts AS DATE) >= w.win_start AND CAST(s.ts AS DATE) < w.win_end
    GROUP BY 1, 2, 3"""))
def q_day_windows(spark, sf):
    s = B.sent(spark, sf).withColumn("d", F.to_date("ts"))
    b = s.groupBy("token").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    w = b.select("token", "lo", F.inline(day_windows("lo", "hi", window_days=1, step_days=2)))
    # window k covers day lo + 2k only (1 day long, every 2 days): an item maps to
    # at most one window by arithmetic, so the count is an equi-join on the start
    items = (s.filter(F.col("label").isNotNull()).join(b.select("token", "lo"), ["token"])
             .withColumn("_off", F.datediff("d", "lo"))
             .filter(F.col("_off") % 2 == 0)
             .groupBy("token", F.col("d").alias("win_start")).agg(F.count(F.lit(1)).alias("n_items")))
    out = w.join(items, ["token", "win_start"], "left")
    return out.select("token", "win_start", "win_end",
                      F.coalesce(F.col("n_items"), F.lit(0)).cast("long").alias("n_items"))


# ------------------------------------------------------------- VOL
B.add_cte("vol_flag", """SELECT supplier, round(sum(volume), 2) AS total_volume, count(*) AS n_days,
    bool_or(volume BETWEEN 225000 AND 50000000) AS in_range FROM vol GROUP BY supplier""", ["vol"])


@register("any_in_range", with_ctes(["vol_flag"], "SELECT supplier, total_volume, n_days, in_range FROM vol_flag"))
def q_any_in_range(spark, sf):
    out = any_in_range(B.vol(spark, sf), "supplier", "volume", B.VOL_LO, B.VOL_HI)
    return out.select("supplier", F.round("total_volume", 2).alias("total_volume"), F.col("n_rows").alias("n_days"), "in_range")


@register("array_range", with_ctes(["vol"], f"""SELECT supplier, round(sum(volume), 2) AS total_volume,
    bool_or(volume BETWEEN {B.VOL_LO} AND {B.VOL_HI}) AS in_range FROM vol GROUP BY supplier"""))
def q_array_range(spark, sf):
    """R3 on arrays: one array of daily volumes per supplier."""
    a = B.vol(spark, sf).groupBy("supplier").agg(F.collect_list("volume").alias("volumes"))
    return a.select("supplier", F.round(sum_arr("volumes"), 2).alias("total_volume"),
                    any_in_range_arr("volumes", B.VOL_LO, B.VOL_HI).alias("in_range"))


def _listed(spark, sf):
    v = B.vol(spark, sf)
    return (v.groupBy("supplier").agg(F.max(F.col("volume").between(B.VOL_LO, B.VOL_HI)).alias("ok"))
            .filter("ok").select("supplier"))


@register("semi_listed", with_ctes(["vol_flag"], """SELECT supplier, d, volume FROM vol
    WHERE supplier IN (SELECT supplier FROM vol_flag WHERE in_range)"""))
def q_semi_listed(spark, sf):
    return semi(B.vol(spark, sf), _listed(spark, sf), "supplier")


@register("anti_listed", with_ctes(["vol_flag"], """SELECT s_suppkey AS supplier, s_name FROM supplier
    WHERE s_suppkey NOT IN (SELECT supplier FROM vol_flag WHERE in_range)"""))
def q_anti_listed(spark, sf):
    sup = B.read(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_name")
    return anti(sup, _listed(spark, sf), "supplier")


# ------------------------------------------------------------- PRED
B.add_cte("ens", """SELECT token, ts, actual, model_a, model_b, (model_a + model_b) / 2.0 AS ensemble
    FROM pred_wide""", ["pred_wide"])


@register("ensemble", with_ctes(["ens"], """SELECT token, ts, actual, model_a, model_b, ensemble FROM ens"""))
def q_ensemble(spark, sf):
    out = ensemble(B.pred(spark, sf), ["model_a", "model_b"])
    return out.select("token", "ts", "actual", "model_a", "model_b", "ensemble")


@register("error_metrics", with_ctes(["ens"], """SELECT token, model, count(*) AS n,
    round(avg(abs(prediction - actual)), 6) AS mae, round(avg((prediction - actual) * (prediction - actual)), 4) AS mse,
    round(sqrt(avg((prediction - actual) * (prediction - actual))), 4) AS rmse
    FROM (SELECT token, ts, actual, 'model_a' AS model, model_a AS prediction FROM ens
          UNION ALL SELECT token, ts, actual, 'model_b', model_b FROM ens
          UNION ALL SELECT token, ts, actual, 'ensemble', ensemble FROM ens)
    WHERE prediction IS NOT NULL AND actual IS NOT NULL GROUP BY token, model"""))
def q_error_metrics(spark, sf):
    wide = ensemble(B.pred(spark, sf), ["model_a", "model_b"])
    long = to_long(wide, ["token", "ts"], ["model_a", "model_b", "ensemble"])
    m = error_metrics(long)
    return m.select("token", "model", "n", _r("mae").alias("mae"), _r("mse", 4).alias("mse"),
                    _r("rmse", 4).alias("rmse"))


@register("coalesce_cols", with_ctes(["pred_wide", "thr"], """SELECT 'pred' AS src, token AS id, ts,
    coalesce(model_b, model_a) AS value, NULL AS author FROM pred_wide
    UNION ALL SELECT 'thr', CAST(submission_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), ts, NULL,
    coalesce(distinguished, '[deleted]') FROM thr"""))
def q_coalesce(spark, sf):
    from ..operators.series import lags, rolling_mean
    m = B.mkt_table(spark, sf).select("token", "ts", "price")
    w = rolling_mean(lags(m, "token", "ts", "price", [1], prefix="_a"), "token", "ts", ["price"], 24,
                     include_current=False, suffix="_b", scale=6)
    p = w.select(F.lit("pred").alias("src"), F.col("token").alias("id"), "ts",
                 coalesce_cols("price_b", "_a1").alias("value"),
                 F.lit(None).cast("string").alias("author"))
    t = B.thr(spark, sf).select(F.lit("thr").alias("src"),
                                F.concat_ws(":", F.col("submission_id").cast("string"),
                                            F.col("turn").cast("string")).alias("id"),
                                "ts", F.lit(None).cast("double").alias("value"),
                                coalesce_cols("distinguished", default="[deleted]").alias("author"))
    return p.unionByName(t)


# ------------------------------------------------------------- E7 flagship
B.add_cte("ft_base", """SELECT g.token, g.ts, g.price, g.volume, g.n, dh.metric AS metric,
    coalesce(sh.count_positive, 0) AS count_positive, coalesce(sh.count_negative, 0) AS count_negative,
    coalesce(sh.percentage_positive, 0) AS percentage_positive, coalesce(sh.count_total, 0) AS total_count,
    coalesce(sd.count_positive, 0) AS count_positive_news, coalesce(sd.count_negative, 0) AS count_negative_news,
    coalesce(sd.percentage_positive, 0) AS percentage_positive_news, coalesce(sd.total_count, 0) AS total_count_news
    FROM grid g LEFT JOIN day_hourly dh ON g.token = dh.token AND g.ts = dh.ts
    LEFT JOIN sent_hourly sh ON g.token = sh.token AND g.ts = sh.ts
    LEFT JOIN sent_daily sd ON g.token = sd.token AND CAST(g.ts AS DATE) = sd.date""",
          ["grid", "day_hourly", "sent_hourly", "sent_daily"])
B.add_cte("ft_keep", """SELECT token, count(price) >= 0.7 * count(*) AS k_price, count(volume) >= 0.7 * count(*) AS k_volume,
    count(n) >= 0.7 * count(*) AS k_n, count(metric) >= 0.7 * count(*) AS k_metric FROM ft_base GROUP BY token""",
          ["ft_base"])
B.add_cte("ft_masked", """SELECT b.token, b.ts,
    CASE WHEN k.k_price THEN b.price END AS price, CASE WHEN k.k_volume THEN b.volume END AS volume,
    CASE WHEN k.k_n THEN b.n END AS n, CASE WHEN k.k_metric THEN b.metric END AS metric,
    count_positive, count_negative, percentage_positive, total_count,
    count_positive_news, count_negative_news, percentage_positive_news, total_count_news
    FROM ft_base b JOIN ft_keep k ON b.token = k.token""", ["ft_base", "ft_keep"])

FT_SQL = with_ctes(["ft_masked"], """SELECT token, ts,
    coalesce(price, first_value(price IGNORE NULLS) OVER wn, last_value(price IGNORE NULLS) OVER wp) AS price,
    coalesce(volume, first_value(volume IGNORE NULLS) OVER wn, last_value(volume IGNORE NULLS) OVER wp) AS volume,
    coalesce(n, first_value(n IGNORE NULLS) OVER wn, last_value(n IGNORE NULLS) OVER wp) AS n,
    coalesce(metric, first_value(metric IGNORE NULLS) OVER wn, last_value(metric IGNORE NULLS) OVER wp) AS metric,
    count_positive, count_negative, round(percentage_positive, 6) AS percentage_positive, total_count,
    count_positive_news, count_negative_news, round(percentage_positive_news, 6) AS percentage_positive_news,
    total_count_news
    FROM ft_masked WINDOW
    wp AS (PARTITION BY token ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    wn AS (PARTITION BY token ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")


def build_feature_table(spark, sf):
    # one pass over the raw events; every input below derives from it
    base = B.base_table(spark, sf)
    sc = B.sent_counts(base)
    holes = B.day(spark, sf, base).filter(F.dayofmonth("d") % 3 != 1)
    ft = feature_table(B.mkt(spark, sf, base), holes.select("token", "d", "metric"),
                       sentiment_hourly(sc, count_col="n"), sentiment_daily(sc, count_col="n"),
                       daily_cols=["metric"])
    return ft.select("token", "ts", "price", "volume", "n", "metric",
                     "count_positive", "count_negative", _r("percentage_positive").alias("percentage_positive"),
                     "total_count", "count_positive_news", "count_negative_news",
                     _r("percentage_positive_news").alias("percentage_positive_news"), "total_count_news")


@register("feature_table", FT_SQL)
def q_feature_table(spark, sf):
    return build_feature_table(spark, sf)
