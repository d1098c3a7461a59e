"""Registered model queries (†: fitted models, rows-only checks in the driver;
exact behaviour is covered by unit tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .bindings import with_ctes
from .registry import register
from ..functions.text import clean_text
from ..operators import series as S
from ..operators.forecast import ar_forecast, assemble, gbt_forecast
from ..operators.trees import tree_forecast
from ..constants import WORD_CLASS
from ..operators.textml import hash_split, relevance_fit, relevance_filter, score_text


def _labelled_docs(spark, sf):
    d = B.read(spark, sf, "documents").select("doc_id", "text")
    lb = B.read(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return d.join(lb, "doc_id")


@register("hash_split", """SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10 < 8 AS is_train
    FROM documents""")
def q_hash_split(spark, sf):
    return hash_split(B.read(spark, sf, "documents").select("doc_id"), "doc_id")


@register("relevance_fit")
def q_relevance_fit(spark, sf):
    lab = hash_split(_labelled_docs(spark, sf), "doc_id")
    model = relevance_fit(lab.filter("is_train"), "text", "label", "svm")
    return model.transform(lab.filter(~F.col("is_train")), "doc_id").select(
        "doc_id", "label", F.col("prediction").cast("int").alias("prediction"))


@register("relevance_filter")
def q_relevance_filter(spark, sf):
    model = relevance_fit(_labelled_docs(spark, sf), "text", "label", "svm")
    docs = B.read(spark, sf, "documents").select("doc_id", "text")
    return relevance_filter(model, docs, id_col="doc_id").select("doc_id")


@register("sentiment_score")
def q_sentiment_score(spark, sf):
    lab = _labelled_docs(spark, sf).withColumn("text", clean_text("text"))
    model = relevance_fit(lab, "text", "label", "logistic")
    docs = B.read(spark, sf, "documents").select("doc_id", clean_text("text").alias("text"))
    return score_text(docs, "text", model, id_col="doc_id").select("doc_id", "label", "score")


# (term, idf, weight) of a given model; '' is the intercept
FIXED_WEIGHTS = [("", 1.0, -0.05), ("the", 1.0, 0.5), ("of", 1.25, -0.25), ("and", 1.5, 0.75), ("de", 1.75, -0.5), ("to", 2.0, 0.125),
                 ("in", 2.25, -1.0), ("click", 3.0, -2.0), ("here", 2.5, -1.5), ("der", 2.0, 0.375), ("que", 2.25, 0.625), ("und", 2.5, -0.875)]


@register("relevance_score", f"""
  WITH m(term, idf, weight) AS (VALUES {", ".join(f"('{t}', {i}::DOUBLE, {w}::DOUBLE)" for t, i, w in FIXED_WEIGHTS)}),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[{WORD_CLASS}]{{{{2,}}}}')) AS term FROM documents) GROUP BY ALL),
  s AS (SELECT doc_id, sum(tf * idf * weight) / sqrt(sum(tf * idf * tf * idf)) AS m FROM tf JOIN m USING (term) GROUP BY doc_id)
  SELECT d.doc_id, round(coalesce(m, 0) - 0.05, 9) AS margin, CAST(coalesce(m, 0) - 0.05 > 0 AS INT) AS prediction FROM documents d LEFT JOIN s USING (doc_id)
""".replace("{{", "{").replace("}}", "}"))
def q_relevance_score(spark, sf):
    """H7's scoring with a given table of weights, on every document."""
    from ..operators.textmodel import TextModel
    model = TextModel(spark.createDataFrame(FIXED_WEIGHTS, "term string, idf double, weight double"))
    out = model.transform(B.read(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return out.select("doc_id", F.round("margin", 9).alias("margin"), F.col("prediction").cast("int").alias("prediction"))


@register("assemble", with_ctes(["mkt"], """SELECT token, ts, 26 AS n_features, first_value, last_value FROM (
    SELECT token, ts, lag(price) OVER o AS first_value, CAST(n AS DOUBLE) AS last_value, count(price) OVER w AS c, volume, n
    FROM mkt WINDOW o AS (PARTITION BY token ORDER BY ts), w AS (PARTITION BY token ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    WHERE c = 24 AND volume IS NOT NULL AND n IS NOT NULL"""))
def q_assemble(spark, sf):
    m = B.mkt_table(spark, sf)
    lagged = S.lag_array(m, "token", "ts", "price", 24, out="lags")
    out = assemble(lagged, "lags", ["volume", "n", "active_addresses"], n_lags=24)
    from pyspark.ml.functions import vector_to_array
    x = vector_to_array("features")
    return out.select("token", "ts", F.size(x).alias("n_features"), F.element_at(x, 1).alias("first_value"), F.element_at(x, -1).alias("last_value"))


@register("gbt_forecast")
def q_gbt(spark, sf):
    m = B.mkt_table(spark, sf)
    return gbt_forecast(m, "token", "ts", "price", 24, exog=["volume", "n"], horizons=[1, 24],
                        split_ts="2024-01-24 00:00:00",
                        params={"max_depth": 4, "n_estimators": 10, "learning_rate": 0.1, "subsample": 0.8})


@register("ar_forecast")
def q_ar(spark, sf):
    m = B.mkt_table(spark, sf).select("token", "ts", "price")
    return ar_forecast(m, "token", "ts", "price", 24, 744)


@register("ar_forecast_scaled")
def q_ar_scaled(spark, sf):
    from ..operators.forecast import ar_forecast_scaled
    m = B.mkt_table(spark, sf).select("token", "ts", "price")
    return ar_forecast_scaled(m, "token", "ts", "price", 24, 720)


@register("ar_forecast_500")
def q_ar_500(spark, sf):
    """E2 with the lags of the original: 500 per token."""
    m = B.mkt_table(spark, sf).select("token", "ts", "price")
    return ar_forecast(m, "token", "ts", "price", 500, 31)


@register("arx_forecast")
def q_arx(spark, sf):
    """E2 with exogenous columns frozen at the last row, fitted per token."""
    m = B.mkt_table(spark, sf).select("token", "ts", "price", "volume", "n")
    return ar_forecast(m, "token", "ts", "price", 24, 744, exog=["volume", "n"])


@register("gbt_forecast_500")
def q_gbt_500(spark, sf):
    """E1 with 500 lags and the four horizons; a horizon that the data's span leaves without a
    training row has null predictions."""
    m = B.mkt_table(spark, sf)
    return gbt_forecast(m, "token", "ts", "price", 500, exog=["volume", "n"], horizons=[1, 24, 168, 720],
                        split_ts="2024-01-24 00:00:00", params={"max_depth": 4, "n_estimators": 5, "learning_rate": 0.1, "subsample": 0.8})


@register("tree_forecast")
def q_tree_forecast(spark, sf):
    """E2 on fitted trees with 500 lags: 31 steps, volume and count frozen."""
    m = B.mkt_table(spark, sf)
    return tree_forecast(m, "token", "ts", "price", 500, 31, exog=["volume", "n"],
                         params={"max_depth": 4, "n_estimators": 8, "learning_rate": 0.1}, step_interval="1 day", restart=True)


@register("tree_forecast_hourly")
def q_tree_forecast_hourly(spark, sf):
    """E2 on fitted trees, 744 hourly steps with noise: 0.025 for one token, 0.05 for the others."""
    m = B.mkt_table(spark, sf)
    return tree_forecast(m, "token", "ts", "price", 24, 744, exog=["volume", "n"], noise={"T0": 0.025}, default_noise=0.05,
                         params={"max_depth": 4, "n_estimators": 8, "learning_rate": 0.1})


FIXED_COEF = [2.0, 0.5, 0.3, 0.1]


@register("ar_recursion", with_ctes(["mkt"], """, last AS (SELECT token, list(price ORDER BY ts DESC)[1:3] AS l, max(ts) AS origin FROM mkt
    GROUP BY token HAVING count(*) >= 3),
  r AS (SELECT token, 0 AS step, l, origin, CAST(NULL AS DOUBLE) AS p FROM last
    UNION ALL SELECT token, step + 1, list_concat([2.0 + 0.5 * l[1] + 0.3 * l[2] + 0.1 * l[3]], l[1:2]), origin,
      2.0 + 0.5 * l[1] + 0.3 * l[2] + 0.1 * l[3] FROM r WHERE step < 48)
  SELECT token, step, origin + to_hours(step) AS ts, round(p, 6) AS prediction FROM r WHERE step > 0""")
    .replace("WITH ", "WITH RECURSIVE ", 1).replace("\n, last", ",\nlast"))
def q_ar_recursion(spark, sf):
    """E2's recursion with given coefficients."""
    m = B.mkt_table(spark, sf).select("token", "ts", "price")
    coef = m.select("token").distinct().withColumn("coef", F.array(*[F.lit(c) for c in FIXED_COEF]))
    out = ar_forecast(m, "token", "ts", "price", 3, 48, coef=coef)
    return out.withColumn("prediction", F.round("prediction", 6))


# (tree, node, feature, threshold, left, right, value, weight): lags 1 to 3, then volume, then the key's mean
FIXED_TREES = [(0, 0, 0, 45.0, 1, 2, 0.0, 1.0), (0, 1, -1, 0.0, -1, -1, 38.5, 1.0), (0, 2, 1, 80.0, 3, 4, 0.0, 1.0),
               (0, 3, -1, 0.0, -1, -1, 61.25, 1.0), (0, 4, -1, 0.0, -1, -1, 95.0, 1.0),
               (1, 0, 3, 60.0, 1, 2, 0.0, 0.5), (1, 1, 2, 50.0, 3, 4, 0.0, 0.5), (1, 2, -1, 0.0, -1, -1, 12.0, 0.5),
               (1, 3, -1, 0.0, -1, -1, -4.5, 0.5), (1, 4, -1, 0.0, -1, -1, 7.75, 0.5)]


@register("tree_recursion", with_ctes(["mkt"], """, last AS (SELECT token, list(price ORDER BY ts DESC)[1:3] AS l, max(ts) AS origin,
      arg_max(volume, ts) FILTER (volume IS NOT NULL) AS x FROM mkt GROUP BY token HAVING count(*) >= 3),
  r AS (SELECT token, 0 AS step, l, origin, x, CAST(NULL AS DOUBLE) AS p FROM last
    UNION ALL SELECT token, step, list_concat([p], l[1:2]), origin, x, p FROM (
      SELECT token, step + 1 AS step, l, origin, x,
        (CASE WHEN l[1] <= 45 THEN 38.5 WHEN l[2] <= 80 THEN 61.25 ELSE 95.0 END
         + 0.5 * CASE WHEN x > 60 THEN 12.0 WHEN l[3] <= 50 THEN -4.5 ELSE 7.75 END)
        * (1 + (CASE token WHEN 'T0' THEN 0.2 ELSE 0.4 END)
           * sqrt(-2 * ln((CAST('0x' || substr(md5(token || '|42|' || (step + 1) || '|1'), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))
           * cos(2 * pi() * (CAST('0x' || substr(md5(token || '|42|' || (step + 1) || '|2'), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)) AS p
      FROM r WHERE step < 744))
  SELECT token, step, origin + to_hours(step) AS ts, round(p, 6) AS prediction FROM r WHERE step > 0""")
    .replace("WITH ", "WITH RECURSIVE ", 1).replace("\n, last", ",\nlast"))
def q_tree_recursion(spark, sf):
    """E2's recursion on a given two-tree ensemble, volume frozen, seeded noise fed back."""
    from ..operators.trees import NODE_SCHEMA
    m = B.mkt_table(spark, sf).select("token", "ts", "price", "volume")
    nodes = spark.createDataFrame(FIXED_TREES, NODE_SCHEMA)
    out = tree_forecast(m, "token", "ts", "price", 3, 744, exog=["volume"], nodes=nodes, noise={"T0": 0.2}, default_noise=0.4)
    return out.withColumn("prediction", F.round("prediction", 6))


@register("arx_recursion", with_ctes(["mkt"], """, last AS (SELECT token, list(price ORDER BY ts DESC)[1:3] AS l, max(ts) AS origin,
      arg_max(volume, ts) FILTER (volume IS NOT NULL) AS x, arg_max(n, ts) FILTER (n IS NOT NULL) AS y FROM mkt GROUP BY token HAVING count(*) >= 3),
  r AS (SELECT token, 0 AS step, l, origin, x, y, CAST(NULL AS DOUBLE) AS p FROM last
    UNION ALL SELECT token, step + 1, list_concat([2.0 + 0.05 * x - 0.25 * y + 0.5 * l[1] + 0.3 * l[2] + 0.1 * l[3]], l[1:2]), origin, x, y,
      2.0 + 0.05 * x - 0.25 * y + 0.5 * l[1] + 0.3 * l[2] + 0.1 * l[3] FROM r WHERE step < 48)
  SELECT token, step, origin + to_hours(step) AS ts, round(p, 6) AS prediction FROM r WHERE step > 0""")
    .replace("WITH ", "WITH RECURSIVE ", 1).replace("\n, last", ",\nlast"))
def q_arx_recursion(spark, sf):
    """E2 with exogenous columns and given coefficients."""
    m = B.mkt_table(spark, sf).select("token", "ts", "price", "volume", "n")
    coef = m.select("token").distinct().withColumn("coef", F.array(*[F.lit(c) for c in [*FIXED_COEF, 0.05, -0.25]]))
    out = ar_forecast(m, "token", "ts", "price", 3, 48, coef=coef, exog=["volume", "n"])
    return out.withColumn("prediction", F.round("prediction", 6))


@register("forecast_metrics")
def q_forecast_metrics(spark, sf):
    """Trees and autoregression into one prediction table, their ensemble, the errors of all three."""
    from ..operators.evaluate import ensemble, error_metrics, to_long
    from ..operators.forecast import gbt_predictions, step_predictions
    m, split = B.mkt_table(spark, sf), "2024-01-24 00:00:00"
    trees = gbt_forecast(m, "token", "ts", "price", 24, exog=["volume", "n"], split_ts=split, params={"max_depth": 4, "n_estimators": 5})
    known = m.filter(F.col("ts") < F.lit(split).cast("timestamp"))
    steps = ar_forecast(known.select("token", "ts", "price"), "token", "ts", "price", 24, 168)
    table = gbt_predictions(trees, 1, "token", "ts").unionByName(step_predictions(steps, m, "token", "ts", "price"))
    wide = ensemble(table, ["gbt", "ar"])
    return error_metrics(to_long(wide, ["token", "ts"], ["gbt", "ar", "ensemble"]))
