"""E2 on boosted trees: a fitted ensemble as a node table, walked inside SQL expressions.

A Spark ML tree ensemble becomes a DataFrame of its nodes (:func:`node_table`), the node table
one struct of arrays (:func:`pack`), and a prediction an expression over that struct and an
array of features (:func:`predict`). So the recursive forecast, whose every step needs the
model, is one ``aggregate`` per key: all keys run in parallel, nothing is looped over or scored
on the driver. The node table's size is that of the model (trees x nodes), whatever the data's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.conditional import noise_factors
from ..session import materialize
from .forecast import assemble, gbt_params, once, origins, steps_out
from .series import lag_array

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, weight double"


def node_table(model) -> DataFrame:
    """The nodes of a fitted Spark ML regression ensemble (boosted trees, forest): tree, node
    (0 is a tree's root), feature and threshold of the split (``x <= threshold`` goes left;
    feature -1 at a leaf), left and right child, value, and the tree's weight. Read from the
    model as Spark stores it, in the shared checkpoint folder. Only numeric splits are known;
    a categorical one fails when the table is read."""
    import uuid

    from pyspark.sql import SparkSession

    from ..session import ensure_checkpoint_dir
    spark = SparkSession.active()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/trees-{uuid.uuid4().hex[:12]}"
    model.save(path)
    n = F.col("nodeData")
    leaf = n["leftChild"] < 0
    numeric = leaf | (n["split"]["numCategories"] < 0)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(leaf, -1).when(numeric, n["split"]["featureIndex"]).otherwise(F.raise_error(F.lit("categorical split"))).cast("int").alias("feature"),
        F.when(leaf, 0.0).otherwise(F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("value"))
    weights = spark.createDataFrame(list(enumerate(float(w) for w in model.treeWeights)), "tree int, weight double")
    return nodes.join(F.broadcast(weights), "tree").select(*[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def pack(nodes: DataFrame) -> Column:
    """The node table as one struct (a scalar subquery, evaluated once per query): arrays of
    feature, threshold, value, left and right place of every node, root place and weight of
    every tree, and the largest number of nodes of a tree as a bound of its depth."""
    w = Window.orderBy("tree", "node")               # as many rows as the model has nodes
    placed = nodes.withColumn("at", F.row_number().over(w) - 1)
    places = placed.select("tree", F.col("node").alias("child"), F.col("at").alias("to"))
    for side in ("left", "right"):
        to = places.withColumnsRenamed({"child": side, "to": f"{side}_at"})
        placed = placed.join(to, ["tree", side], "left")
    depth = _depth(nodes)
    row = F.struct("at", "feature", "threshold", F.coalesce("left_at", "at").alias("l"), F.coalesce("right_at", "at").alias("r"), "value")
    root = F.when(F.col("node") == 0, F.struct("tree", "at", "weight"))
    all_, roots = F.array_sort(F.collect_list(row)), F.array_sort(F.collect_list(root))
    one = placed.agg(all_.alias("n"), roots.alias("t"))
    return one.select(F.struct(
        *[F.col("n")[c].alias(c) for c in ("feature", "threshold", "l", "r", "value")],
        F.col("t")["at"].alias("root"), F.col("t")["weight"].alias("weight"), F.lit(depth).alias("depth"))).scalar()


def _depth(nodes: DataFrame) -> int:
    """Levels below the roots: the tree is followed level by level on the node table, one row
    (a number) per level reaching the driver."""
    nodes = materialize(nodes, "nodes")
    level, depth = nodes.where("node = 0"), 0
    while depth < 64:
        below = level.where("feature >= 0").select("tree", F.explode(F.array("left", "right")).alias("node"))
        level = nodes.join(below, ["tree", "node"], "left_semi")
        if level.isEmpty():
            return depth
        depth += 1
    raise ValueError("trees deeper than 64 levels")


def predict(ensemble: Column, feature) -> Column:
    """Sum over the trees of weight x value of the leaf that the features lead to.
    ``feature(i)`` gives the i-th feature (from 0) as a column; a null or NaN goes right, as in Spark ML."""
    def leaf(root):
        def down(at, _):
            f = F.get(ensemble["feature"], at)
            left = F.coalesce(feature(f) <= F.get(ensemble["threshold"], at), F.lit(False))
            return F.when(f < 0, at).when(left, F.get(ensemble["l"], at)).otherwise(F.get(ensemble["r"], at))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(ensemble["depth"], F.lit(1))), root, down)

    trees = F.sequence(F.lit(0), F.size(ensemble["root"]) - 1)
    return F.aggregate(trees, F.lit(0.0), lambda total, t: total + F.get(ensemble["weight"], t)
                       * F.get(ensemble["value"], leaf(F.get(ensemble["root"], t))))


def tree_recursion(ensemble: Column, lags: Column, frozen: Column, steps: int, noise: Column | None = None) -> Column:
    """H predictions, each fed back as lag 1 of the next: features are the lags, then the
    ``frozen`` values, the same at every step. ``noise[i]`` multiplies the i-th prediction
    before it is fed back."""
    def run(given):
        p = given["p"]

        def step(state, i):
            value = predict(given["model"], lambda f: F.when(f < p, F.get(state, f)).otherwise(F.get(given["frozen"], f - p)))
            return F.concat(F.array(value if noise is None else value * F.get(given["noise"], i)), state)
        return F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), lags, step)
    given = F.struct(ensemble.alias("model"), frozen.alias("frozen"), F.size(lags).alias("p"),
                     (F.lit(None) if noise is None else noise).alias("noise"))
    return F.reverse(F.slice(once(given, run), 1, steps))


def tree_fit(df: DataFrame, key: str, ts: str, target: str, p: int, exog: Sequence[str] = (), params: dict | None = None,
             seed: int = 42):
    """Boosted trees on [lag 1..p of ``target``, ``exog`` of the row, the key's mean target] with
    the row's ``target`` as label: what the recursion needs, for all keys in one model. Returns
    the fitted Spark ML model. Rows with a missing feature are left out."""
    from pyspark.ml.regression import GBTRegressor
    means = key_means(df, key, target)
    d = lag_array(df.select(key, ts, target, *exog), key, ts, target, p, out="_lags").filter(F.col(target).isNotNull())
    d = d.join(means.withColumnRenamed(key, "_mk"), F.col(key).eqNullSafe(F.col("_mk"))).drop("_mk")
    d = assemble(d, "_lags", [*exog, "_key_mean"], n_lags=p).select("features", F.col(target).alias("_label"))
    return GBTRegressor(featuresCol="features", labelCol="_label", seed=seed,
                        **gbt_params(params or {"max_depth": 6, "n_estimators": 50, "learning_rate": 0.1})).fit(d)


def key_means(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(target).alias("_key_mean"))


def tree_forecast(df: DataFrame, key: str, ts: str, target: str, p: int, steps: int, exog: Sequence[str] = (),
                  nodes: DataFrame | None = None, params: dict | None = None, noise: dict | None = None,
                  default_noise: float = 0.0, seed: int = 42, step_interval: str = "1 hour", restart: bool = False) -> DataFrame:
    """E2 on trees: fit :func:`tree_fit` (or take a node table with the same features) and
    forecast ``steps`` ahead of each key's last row. Returns (key, step, ts, prediction).

    ``exog`` columns stay at the key's last known value. ``noise`` ({key: scale}, others
    ``default_noise``) multiplies every prediction by a seeded N(1, scale) factor before it
    becomes lag 1 of the next step (M4); without it the forecast has none. ``restart`` begins
    with the last row's own features, so that the first step predicts that row's time anew and
    ``ts`` starts there. Keys with fewer than p (restart: p + 1) known rows, or a null among
    their last ones, have no forecast."""
    if nodes is None:
        nodes = node_table(tree_fit(df, key, ts, target, p, exog, params, seed))
    start = origins(df, key, ts, target, p, exog, restart)
    start = (start.join(key_means(df, key, target).withColumnRenamed(key, "_mk"), F.col(key).eqNullSafe(F.col("_mk"))).drop("_mk")
             .withColumn("_frozen", F.concat("_frozen", F.array("_key_mean"))).withColumn("_model", pack(nodes)))
    factors = None
    if noise or default_noise:
        start = start.withColumn("_noise", noise_factors(F.col(key), noise or {}, default_noise, steps, seed))
        factors = F.col("_noise")
    return steps_out(start, key, ts, tree_recursion(F.col("_model"), F.col("_lags"), F.col("_frozen"), steps, factors), step_interval, restart)
