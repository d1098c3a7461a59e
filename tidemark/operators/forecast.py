"""Forecasting (E0-E3): feature assembly, boosted trees with a direct horizon,
and autoregressive recursion evaluated inside one SQL expression.

Nothing loops over tokens on the driver: models are fitted on all tokens at
once (the token's mean target is a feature for trees; AR normal equations are
Gram matrices per segment of a token's series, summed per token), and the recursion
runs per token inside ``aggregate`` (of trees: ``trees.py``). Every model's output fits one prediction table
(token, ts, model, prediction, actual), which ``ensemble`` and
``error_metrics`` take."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.conditional import noise_factors
from ..session import materialize
from .series import SEG_ROWS, lag_array, last_n, leads, segmented


def assemble(df: DataFrame, lags: str | None, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "skip", n_lags: int | None = None) -> DataFrame:
    """Lag array (if any) + the wanted columns that exist -> one ML vector.
    Rows with a null or NaN feature (or an incomplete lag array) are skipped.
    With ``n_lags`` the vector size is declared, so no job runs to find it."""
    from pyspark.ml.feature import VectorAssembler, VectorSizeHint
    from pyspark.ml.functions import array_to_vector
    have = [c for c in cols if c in df.columns]
    inputs = list(have)
    d = df
    if lags is not None:
        d = d.filter(F.col(lags).isNotNull()).withColumn("_lagv", array_to_vector(F.col(lags)))
        if n_lags is not None:
            d = VectorSizeHint(inputCol="_lagv", size=n_lags, handleInvalid="skip").transform(d)
        inputs = ["_lagv"] + inputs
    va = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid=handle_invalid)
    return va.transform(d).drop("_lagv")


# fixed values: boosted-tree parameter names mapped to Spark ML's
GBT_PARAM_MAP = {
    "max_depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate",
    "n_estimators": "maxIter", "min_child_weight": "minInstancesPerNode", "gamma": "minInfoGain",
}


def gbt_params(params: dict) -> dict:
    """Translate boosted-tree parameters; ``colsample_bytree`` becomes a
    feature subset fraction; regularisation terms have no counterpart."""
    out = {GBT_PARAM_MAP[k]: v for k, v in params.items() if k in GBT_PARAM_MAP}
    if "colsample_bytree" in params:
        out["featureSubsetStrategy"] = str(params["colsample_bytree"])
    if "maxDepth" in out:
        out["maxDepth"] = int(out["maxDepth"])
    if "maxIter" in out:
        out["maxIter"] = int(out["maxIter"])
    if "minInstancesPerNode" in out:
        out["minInstancesPerNode"] = max(1, int(out["minInstancesPerNode"]))
    return out


def gbt_forecast(df: DataFrame, key: str, ts: str, target: str, n_lags: int,
                 exog: Sequence[str] = (), horizons: Sequence[int] = (1,),
                 split_ts=None, params: dict | None = None, seed: int = 42) -> DataFrame:
    """Gradient-boosted trees, direct horizon: for each h the label is the
    target h rows ahead, features are the current target, the last ``n_lags``
    before it, the exogenous columns and the key's mean target over the training
    rows (any number of keys; unseen ones take the overall mean). Trains on rows
    whose label lies before ``split_ts`` (all rows when None) and returns (key,
    ts, horizon, label_ts, actual, prediction) for rows at or after it. Lags, leads
    and means are built and stored once for all horizons. A horizon without any
    training row has no model: its predictions are null."""
    from pyspark.ml.regression import GBTRegressor
    base = lag_array(df, key, ts, target, n_lags, out="_lags").withColumn("_now", F.struct(F.col(ts).alias("t"), F.col(target).alias("v")))
    base = leads(base, key, ts, "_now", list(horizons), prefix="_lead")
    split = None if split_ts is None else F.lit(split_ts).cast("timestamp")
    past = df if split is None else df.filter(F.col(ts) < split)
    means = past.groupBy(F.col(key).alias("_mean_key")).agg(F.avg(target).alias("_key_mean"))
    overall = past.select(F.avg(target)).scalar()
    base = (base.join(means, F.col(key).eqNullSafe(F.col("_mean_key")), "left")
            .withColumn("_key_mean", F.coalesce("_key_mean", overall)).drop("_mean_key"))
    keep = [key, ts, target, *[c for c in exog if c in df.columns], "_lags", "_key_mean", *[f"_lead{h}" for h in horizons]]
    base = materialize(base.select(*dict.fromkeys(keep)), "lagged")
    outs = []
    for h in horizons:
        d = base.withColumns({"_label": F.col(f"_lead{h}.v"), "_label_ts": F.col(f"_lead{h}.t")})
        d = assemble(d, "_lags", [target, *exog, "_key_mean"], n_lags=n_lags)
        train, test = d.filter(F.col("_label").isNotNull()), d
        if split is not None:
            train = train.filter(F.col("_label_ts") < split)
            test = d.filter(F.col(ts) >= split)
        if train.isEmpty():
            scored = test.withColumn("prediction", F.lit(None).cast("double"))
        else:
            gbt = GBTRegressor(featuresCol="features", labelCol="_label", seed=seed,
                               **gbt_params(params or {"max_depth": 4, "n_estimators": 20}))
            scored = gbt.fit(train).transform(test)
        outs.append(scored.select(
            key, ts, F.lit(h).alias("horizon"), F.col("_label_ts").alias("label_ts"), F.col("_label").alias("actual"), "prediction"))
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res


def gbt_predictions(forecast: DataFrame, horizon: int, key: str, ts: str, model: str = "gbt") -> DataFrame:
    """Rows of :func:`gbt_forecast` as the prediction table, at the time they speak of."""
    f = forecast.filter((F.col("horizon") == horizon) & F.col("label_ts").isNotNull())
    return f.select(key, F.col("label_ts").alias(ts), F.lit(model).alias("model"), "prediction", "actual")


def step_predictions(forecast: DataFrame, actuals: DataFrame, key: str, ts: str, target: str, model: str = "ar") -> DataFrame:
    """Rows of :func:`ar_forecast` as the prediction table, with the known target of that time."""
    a = actuals.select(key, F.col(ts), F.col(target).alias("actual"))
    return forecast.join(a, [key, ts]).select(key, ts, F.lit(model).alias("model"), "prediction", "actual")


def ar_fit(df: DataFrame, key: str, ts: str, c: str, p: int, ridge: float = 1e-6, exog: Sequence[str] = (),
           seg_rows: int | None = None) -> DataFrame:
    """AR(p), with ``exog`` ARX(p), per key by least squares: x = [1, lag1..lagp, exog of the
    row], y = c. Returns (key, coef ARRAY<DOUBLE>, n_train): coef[0] the intercept, coef[i] the
    weight of lag i, then those of ``exog``.

    No lag arrays are built: each (key, segment) of the series goes to one Python call as plain
    values, ``p`` rows of the segment before it as context, and the Gram matrix of [x, y] is
    summed over sliding views of them. A segment gives p + 2 + len(exog) short rows (one per row
    of the matrix), which are added up as sorted streams per (key, matrix row), so neither a task
    nor a group holds more than one sum; the key's system is solved at the end. Rows with a null
    or NaN among y, its lags or ``exog`` are left out; a key without any usable row has no model."""
    exog = list(exog)
    m = p + 2 + len(exog)
    key_type = df.schema[key].dataType
    columns = [F.col(x).cast("double").alias(f"_x{i}") for i, x in enumerate([c, *exog])]
    rows, _ = segmented(df.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), *columns), "_k", "_t", halo=p,
                        seg_rows=seg_rows or max(SEG_ROWS, 64 * m))
    rows = rows.select("_k", "_tseg", "_halo", "_pos", *[f"_x{i}" for i in range(1 + len(exog))])

    def grams(table: pa.Table) -> pa.Table:
        order = np.argsort(table["_pos"].to_numpy(), kind="stable")
        values = [pc.fill_null(table[f"_x{i}"], float("nan")).to_numpy()[order] for i in range(1 + len(exog))]
        own = ~table["_halo"].to_numpy(zero_copy_only=False)[order]
        g, n = np.zeros((m, m)), 0
        if len(own) > p:
            views = np.lib.stride_tricks.sliding_window_view(values[0], p + 1)
            fine = own[p:] & ~np.isnan(values[0])[p:]
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values[0]))])
            fine &= bad[p + 1:] == bad[: len(bad) - p - 1]
            for v in values[1:]:
                fine &= np.isfinite(v[p:])
            use = np.flatnonzero(fine)
            for at in range(0, len(use), max(1, (1 << 22) // m)):   # 32 MB of lags at a time
                i = use[at: at + max(1, (1 << 22) // m)]
                x = np.concatenate([np.ones((len(i), 1)), views[i, p - 1:: -1] if p else np.empty((len(i), 0)),
                                    *[v[p:][i, None] for v in values[1:]], views[i, p:]], axis=1)
                g += x.T @ x
            n = len(use)
        keys = pa.chunked_array([table["_k"].combine_chunks().take(pa.array(np.zeros(m if n else 0, np.int64)))])
        return pa.table({"_k": keys, "i": pa.array(np.arange(m if n else 0), pa.int32()),
                         "row": pa.array(list(g) if n else [], pa.list_(pa.float64())), "n": pa.array([n] * (m if n else 0), pa.int64())})

    def added(batches):
        """Sums of neighbouring rows with one (key, i); the last group waits for the next batch."""
        held = None
        for b in batches:
            at = b.column(1).to_numpy()
            keys = b.column(0).dictionary_encode()
            code = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, m)
            first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (code[1:] != code[:-1])]))
            for j, (s, e) in enumerate(zip(first.tolist(), [*first[1:].tolist(), len(at)])):
                k = b.column(0)[s].as_py()
                total, n = x[s:e].sum(0), int(b.column(3).to_numpy()[s:e].sum())
                if held and held[0] == k and held[1] == at[s]:
                    total, n = total + held[2], n + held[3]
                elif held:
                    yield told(held, b.column(0).type)
                held = (k, int(at[s]), total, n)
            kind = b.column(0).type
        if held:
            yield told(held, kind)

    def told(held, kind):
        k, i, total, n = held
        return pa.RecordBatch.from_arrays([pa.array([k], kind), pa.array([i], pa.int32()), pa.array([total], pa.list_(pa.float64())),
                                           pa.array([n], pa.int64())], ["_k", "i", "row", "n"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        g = np.stack(pdf.sort_values("i")["row"].to_list())
        a, b = g[:-1, :-1].copy(), g[:-1, -1]
        a += ridge * np.eye(m - 1) * max(1.0, float(np.trace(a)) / (m - 1))
        return pd.DataFrame({key: [pdf["_k"].iloc[0]], "coef": [np.linalg.solve(a, b).tolist()], "n_train": [int(pdf["n"].iloc[0])]})

    part = f"_k {key_type.simpleString()}, i int, row array<double>, n long"
    parts = rows.groupBy("_k", "_tseg").applyInArrow(grams, part)
    sums = parts.repartition("_k", "i").sortWithinPartitions("_k", "i").mapInArrow(added, part)
    return sums.groupBy("_k").applyInPandas(solve, f"`{key}` {key_type.simpleString()}, coef array<double>, n_train long")


def ar_recursion(coef: Column, lags: Column, steps: int, frozen: Column | None = None, noise: Column | None = None) -> Column:
    """H-step recursive forecast inside one expression. ``lags`` = [lag1, lag2, ...] at the
    forecast origin, ``coef`` = [intercept, w1, .., exogenous weights]. Each step predicts and
    the prediction becomes lag 1 of the next; ``frozen`` holds the exogenous values, the same at
    every step, ``noise[i]`` multiplies the i-th prediction before it is fed back."""
    p = F.size(lags)
    start = F.element_at(coef, 1)
    if frozen is not None:
        weights = F.slice(coef, p + 2, F.greatest(F.size(coef) - p - 1, F.lit(0)))
        start = start + F.aggregate(F.zip_with(weights, frozen, lambda w, x: w * x), F.lit(0.0), lambda acc, x: acc + x)

    def run(given):
        def one(state, i):
            value = F.aggregate(F.sequence(F.lit(1), p), given["base"], lambda acc, j: acc + F.element_at(coef, j + 1) * F.element_at(state, j))
            return F.concat(F.array(value if noise is None else value * F.get(given["noise"], i)), state)
        return F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), lags, one)
    given = F.struct(start.alias("base"), (F.lit(None) if noise is None else noise).alias("noise"))
    return F.reverse(F.slice(once(given, run), 1, steps))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated a single time per row: inside a loop over steps the
    optimizer would else put the expression itself in the place of the column."""
    return F.element_at(F.transform(F.array(value), use), 1)


def origins(df: DataFrame, key: str, ts: str, c: str, p: int, exog: Sequence[str] = (), restart: bool = False) -> DataFrame:
    """(key, _origin, _lags, _frozen): where each key's forecast starts. ``_lags`` are its last
    p values, newest first; with ``restart`` those before its last row. ``_frozen`` are the last
    known values of ``exog``. Keys with fewer rows, a null among the lags or an exogenous column
    without any value are left out."""
    n = p + 1 if restart else p
    tail = last_n(df.select(key, ts, c), key, ts, n)
    value = F.col(c).cast("double")
    origin = tail.groupBy(key).agg(F.max(ts).alias("_origin"), F.sort_array(F.collect_list(F.struct(F.col(ts).alias("t"), value.alias("v"))), asc=False).alias("_t"))
    lags = F.slice(F.col("_t")["v"], 2 if restart else 1, p)
    origin = origin.filter(F.size("_t") == n).select(key, "_origin", lags.alias("_lags"))
    origin = origin.filter(~F.exists("_lags", lambda x: x.isNull()))
    if not exog:
        return origin.withColumn("_frozen", F.array().cast("array<double>"))
    last = df.groupBy(F.col(key).alias("_ek")).agg(*[F.max_by(F.col(x).cast("double"), F.when(F.col(x).isNotNull(), F.col(ts))).alias(f"_e{i}") for i, x in enumerate(exog)])
    last = last.select("_ek", F.array(*[f"_e{i}" for i in range(len(exog))]).alias("_frozen")).filter(~F.exists("_frozen", lambda x: x.isNull()))
    return origin.join(last, F.col(key).eqNullSafe(F.col("_ek"))).drop("_ek")


def steps_out(start: DataFrame, key: str, ts: str, predictions: Column, step_interval: str, restart: bool = False) -> DataFrame:
    """(key, step, ts, prediction) of an array of predictions per key."""
    fc = start.select(key, "_origin", F.posexplode(predictions).alias("_i", "prediction"))
    ahead = F.col("_i") if restart else F.col("_i") + 1
    return fc.select(key, (F.col("_i") + 1).alias("step"), (F.col("_origin") + F.expr(f"INTERVAL {step_interval}") * ahead).alias(ts), "prediction")


def ar_forecast(df: DataFrame, key: str, ts: str, c: str, p: int, steps: int, step_interval: str = "1 hour",
                coef: DataFrame | None = None, exog: Sequence[str] = (), noise: dict | None = None,
                default_noise: float = 0.0, seed: int = 42, restart: bool = False) -> DataFrame:
    """Fit AR(p), with ``exog`` ARX(p), per key (or take ``coef``), then forecast ``steps``
    ahead from each key's last p rows, ``exog`` frozen at its last known values. ``noise`` and
    ``restart`` as in ``trees.tree_forecast``. Returns (key, step, ts, prediction); the state
    starts after the last known row."""
    coef = coef if coef is not None else ar_fit(df, key, ts, c, p, exog=exog)
    start = origins(df, key, ts, c, p, exog, restart).join(coef.select(key, "coef"), key)
    factors = None
    if noise or default_noise:
        start = start.withColumn("_noise", noise_factors(F.col(key), noise or {}, default_noise, steps, seed))
        factors = F.col("_noise")
    return steps_out(start, key, ts, ar_recursion(F.col("coef"), F.col("_lags"), steps, F.col("_frozen"), factors), step_interval, restart)


def ar_forecast_scaled(df: DataFrame, key: str, ts: str, c: str, p: int, steps: int,
                       step_interval: str = "1 hour", exog: Sequence[str] = ()) -> DataFrame:
    """The sequence-model forecast path: ``c`` and ``exog`` min-max scaled per key (W12),
    AR(p) or ARX(p) recursion on the scaled series for ``steps`` steps, predictions
    mapped back with the inverse scale. Returns (key, step, ts, prediction)."""
    from .series import inverse_minmax, minmax_scale
    scaled = minmax_scale(df.select(key, ts, c, *exog), key, [c, *exog], suffix="_s")
    params = scaled.groupBy(key).agg(F.first(f"{c}_min").alias(f"{c}_min"), F.first(f"{c}_max").alias(f"{c}_max"))
    values = scaled.select(key, ts, *[F.col(f"{x}_s").alias(x) for x in (c, *exog)])
    fc = ar_forecast(values, key, ts, c, p, steps, step_interval, exog=exog)
    return (fc.join(params, key)
            .withColumn("prediction", inverse_minmax("prediction", f"{c}_min", f"{c}_max"))
            .drop(f"{c}_min", f"{c}_max"))
