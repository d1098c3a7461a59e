"""Model evaluation (A9, A17, E5, E6): error metrics and classification
reports as grouped aggregates over long (token, model) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.conditional import mean_of


def ensemble(preds: DataFrame, models: Sequence[str], key: str = "token", ts: str = "ts",
             out: str = "ensemble", order: Sequence[str] | None = None) -> DataFrame:
    """E5 = J7 + M2 + A19: predictions of several models side by side (only
    where every model has a row), their mean, one row per (key, time).
    ``preds`` is long: key, ts, model, prediction, actual.

    One grouped pass for all models: of a model's rows at one time the first in
    ``order`` (default: its smallest known prediction) counts, ties decided by
    prediction and actual; ``actual`` is the first model's."""
    by = list(order or []) + ["prediction", "actual"]
    rank = F.struct(*[F.struct(F.col(c).isNull().alias("f"), F.col(c).alias("v")).alias(f"o{i}") for i, c in enumerate(by)])
    row = F.struct("prediction", "actual")
    aggs = [F.min_by(row, F.when(F.col("model") == m, rank)).alias(f"_m{i}") for i, m in enumerate(models)]
    wide = preds.filter(F.col("model").isin(list(models))).groupBy(key, ts).agg(*aggs)
    for i in range(len(models)):
        wide = wide.filter(F.col(f"_m{i}").isNotNull())
    wide = wide.select(key, ts, F.col("_m0.actual").alias("actual"),
                       *[F.col(f"_m{i}.prediction").alias(m) for i, m in enumerate(models)])
    return wide.withColumn(out, mean_of(*models))


def error_metrics(preds: DataFrame, key: str = "token", model: str = "model",
                  actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Per (key, model): pairs with both values, MAE, MSE, RMSE. Groups
    without any pair are left out. One scan for all models (long input)."""
    ok = preds.filter(F.col(actual).isNotNull() & F.col(prediction).isNotNull())
    err = F.col(prediction) - F.col(actual)
    return (ok.groupBy(key, model)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
                 F.avg(err * err).alias("mse"))
            .withColumn("rmse", F.sqrt("mse")))


def to_long(wide: DataFrame, keys: Sequence[str], models: Sequence[str], actual: str = "actual") -> DataFrame:
    """Unpivot model columns into (keys, actual, model, prediction)."""
    stack = ", ".join(f"'{m}', {m}" for m in models)
    return wide.select(*keys, actual, F.expr(f"stack({len(models)}, {stack}) AS (model, prediction)"))


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """A14."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction",
                 classes: Sequence = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, plus ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows; an undefined ratio is 0. Built
    from the confusion counts of one grouped aggregate, gathered into one row
    (at most classes x classes entries) and unfolded with array functions."""
    conf = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("c"))
    cells = conf.agg(F.collect_list(F.struct(F.col(label).alias("l"), F.col(pred).alias("p"), "c")).alias("cells"))

    def total(test):
        return F.aggregate(F.filter("cells", test), F.lit(0).cast("long"), lambda a, x: a + x["c"])

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    def entry(k):
        return F.struct(F.lit(str(k)).alias("class"), total(lambda x: (x["l"] == k) & (x["p"] == k)).alias("tp"),
                        total(lambda x: (x["l"] != k) & (x["p"] == k)).alias("fp"),
                        total(lambda x: (x["l"] == k) & (x["p"] != k)).alias("fn"))

    counted = cells.select(F.array(*[entry(k) for k in classes]).alias("k"),
        total(lambda x: F.lit(True)).alias("total"))
    rated = counted.select("total", F.transform("k", lambda x: F.struct(
        x["class"].alias("class"), ratio(x["tp"], x["tp"] + x["fp"]).alias("precision"),
        ratio(x["tp"], x["tp"] + x["fn"]).alias("recall"),
        ratio(2 * x["tp"], 2 * x["tp"] + x["fp"] + x["fn"]).alias("f1"),
        (x["tp"] + x["fn"]).cast("long").alias("support"), x["tp"].alias("tp"))).alias("r"))

    def added(name, weight=None):
        term = (lambda x: x[name].cast("double")) if weight is None else (lambda x: x[name] * x[weight])
        return F.aggregate("r", F.lit(0.0), lambda a, x: a + term(x))
    n, support = F.lit(float(len(classes))), F.aggregate("r", F.lit(0).cast("long"), lambda a, x: a + x["support"])
    summary = F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 F.try_divide(added("tp"), F.col("total").cast("double")).alias("f1"), support.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), *[(added(m) / n).alias(m) for m in ("precision", "recall", "f1")], support.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"),
                 *[F.try_divide(added(m, "support"), support.cast("double")).alias(m) for m in ("precision", "recall", "f1")],
                 support.alias("support")))
    per = F.transform("r", lambda x: F.struct(*[x[c].alias(c) for c in ("class", "precision", "recall", "f1", "support")]))
    return rated.select(F.explode(F.concat(per, summary)).alias("o")).select("o.*")
