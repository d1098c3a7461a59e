"""URL filters: exact host and path rules first, then logistic regression on hashed
character n-grams of host and path (all DataFrame functions and Spark ML, in the JVM)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host suffix with path prefix, verdict); the longest that fits decides.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def rule_fits(rule: str, host: Column, path: Column) -> Column:
    """Host equal to the rule's or a subdomain of it, path starting with the rule's."""
    h, p = _split(rule)
    return ((host == F.lit(h)) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))


def longest_rule(host: Column, path: Column, rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does. Ties in
    length cannot both fit unless equal; of equal rules the first listed counts."""
    cases = [F.when(rule_fits(r, host, path), F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")))
             for r, v in sorted(rules, key=lambda x: -len(x[0]))]
    return F.coalesce(*cases) if cases else F.lit(None).cast("struct<rule:string,verdict:string>")


def ngrams(host: Column, path: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams of ``^host$`` and of ``path$``, marked h and p."""
    def of(text: Column, mark: str, n: int) -> Column:
        last = F.length(text) - F.lit(n - 1)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                            lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
        return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))
    h, p = F.concat(F.lit("^"), host, F.lit("$")), F.concat(path, F.lit("$"))
    return F.concat(*[of(t, m, n) for n in range(low, high + 1) for t, m in ((h, "h"), (p, "p"))])


def featurise(urls: DataFrame, features: int) -> DataFrame:
    grams = urls.withColumn("__grams", ngrams(F.col("__host"), F.col("__path")))
    return HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__x").transform(grams)


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", features: int = 1 << 12,
        max_rows: int = 2000, max_iter: int = 40, reg: float = 1e-3) -> LogisticRegressionModel | float:
    """Fit on a small labelled table (label 1 = block). The table may be large: training
    takes the ``max_rows`` distinct (host, path, label) with the smallest URL hash (a documented bound). Without
    both labels the constant share of label 1 (0.0 for an empty table) is returned."""
    rows = (labelled.where(F.col(label_col).isNotNull())
            .select(host_of(F.col(url_col)).alias("__host"), path_of(F.col(url_col)).alias("__path"),
                    F.col(label_col).cast("double").alias("__y"))
            .distinct().orderBy(F.xxhash64("__host", "__path"), "__host", "__path", "__y").limit(max_rows))
    train = featurise(rows, features).select("__x", "__y").coalesce(1).cache()
    try:
        seen = train.groupBy("__y").count().collect()
        if len(seen) < 2:
            return float(seen[0]["__y"]) if seen else 0.0
        return LogisticRegression(featuresCol="__x", labelCol="__y", maxIter=max_iter, regParam=reg,
                                  aggregationDepth=2).fit(train)
    finally:
        train.unpersist()


def judge(pages: DataFrame, model, url_col: str = "url", rules=RULES, features: int = 1 << 12,
          threshold: float = 0.5) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and block_score.

    A rule's verdict is final; the model judges the rest (block if its probability
    reaches ``threshold``). A null URL or one without ``://`` has empty host and path and
    goes to the model like any other. Repeated rows are judged alike, empty tables give
    empty results; existing columns of these five names are replaced."""
    from pyspark.ml.functions import vector_to_array
    added = ("host", "path", "rule", "verdict", "block_score")
    kept = [c for c in pages.columns if c not in added]
    u = pages.select(*[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(kept)],
                     host_of(F.col(f"`{url_col}`")).alias("__host"), path_of(F.col(f"`{url_col}`")).alias("__path"))
    if isinstance(model, float):
        u = u.withColumn("__p", F.lit(model))
    else:
        u = featurise(u, features)
        out = model.copy().setFeaturesCol("__x").setPredictionCol("__pred").setRawPredictionCol("__raw").setProbabilityCol("__prob")
        u = out.transform(u).withColumn("__p", vector_to_array("__prob")[1])
    hit = longest_rule(F.col("__host"), F.col("__path"), rules)
    u = u.withColumn("__hit", hit)
    by_model = F.when(F.col("__p") >= threshold, "block").otherwise("allow")
    return u.select(*[F.col(f"__in{i}").alias(c) for i, c in enumerate(kept)],
                    F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__hit.rule").alias("rule"),
                    F.coalesce(F.col("__hit.verdict"), by_model).alias("verdict"), F.col("__p").alias("block_score"))


def labelled_by_rules(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """A labelled URL table from the rules themselves: every URL a rule decides,
    label 1 where it blocks. Lets the model carry the rules' taste over to unruled hosts."""
    u = pages.select(F.col(url_col).alias("url"))
    hit = longest_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    return (u.withColumn("__hit", hit).where(F.col("__hit").isNotNull())
            .select("url", (F.col("__hit.verdict") == "block").cast("int").alias("label")))
