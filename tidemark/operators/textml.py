"""Text features and classifiers (H1, H3-H7).

TF-IDF in DataFrame form follows the common library defaults: lower case,
tokens of two or more word characters, raw counts, idf = ln((1+N)/(1+df)) + 1,
L2 row norm. The ML form feeds Spark ML estimators."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import WORD_CLASS
from ..session import materialize

TERM_PATTERN = f"[{WORD_CLASS}]{{2,}}"
#: Text bytes of a part that is cut into words.
PART_BYTES = 8 << 20
#: A table of terms up to this many bytes is broadcast, of a larger one its most frequent terms.
MAX_BROADCAST_BYTES = 32 << 20


def terms(c) -> Column:
    """Tokens of two or more word characters, lower case."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(col), F.lit(TERM_PATTERN), 0)


def dealt(df: DataFrame, c: str, *keys) -> DataFrame:
    """``df`` dealt out by ``keys`` into parts of about PART_BYTES of the text ``c`` (its rows
    times the mean length of the first of them), so that what a part's words need stays in
    memory whatever the input, and all later grouping by the keys happens where the rows are."""
    mean = df.limit(1000).agg(F.avg(F.octet_length(c))).first()[0] or 0.0
    # with fewer parts than shuffles have, a join by the keys would deal all rows out again
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() * mean / PART_BYTES))
    return df.repartition(parts, *keys)


def word_counts(df: DataFrame, key: str, c: str) -> DataFrame:
    """(key, term, tf) of rows that :func:`dealt` has dealt out by ``key``: counted in place. A
    text without a term gives a row with a null one."""
    # explode_outer: a plain explode has the terms cut twice, once for an inferred filter
    t = df.select(key, F.explode_outer(terms(c)).alias("term"))
    return t.groupBy(key, "term").agg(F.count("term").alias("tf"))


def row_counts(c) -> Column:
    """The (term, tf) of one text as an array: its terms in order, each with the length of its run."""
    # array(..) and transform hold a value that is used several times
    ends = lambda w: F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == F.size(w)) | (F.get(w, i - 1) != F.get(w, i)))
    runs = lambda w: F.transform(F.array(ends(w)), lambda e: F.transform(e, lambda i, k: F.struct(
        F.get(w, i - 1).alias("term"), (i - F.coalesce(F.get(e, k - 1), F.lit(0))).cast("long").alias("tf"))))[0]
    return F.transform(F.array(F.array_sort(terms(c))), lambda w: F.when(F.size(w) > 0, runs(w)))[0]


def one_each(df: DataFrame, *keys) -> bool:
    """Whether no two rows share their keys (nulls are equal)."""
    n, distinct = df.select(F.struct(*keys).alias("_k")).agg(F.count(F.lit(1)), F.count_distinct("_k")).first()
    return n == distinct


def by_frequency(table: DataFrame, step, most: int) -> tuple[DataFrame, DataFrame | None]:
    """A table with a ``term`` cut in two by ``step``, a whole number that grows with a term's
    frequency: the rows of the highest steps that together have ``most`` bytes at most, and the rest
    (None if there is none). Few terms make most of any text, so most words find theirs
    in a broadcast, and only the others are shuffled. One sum a step reaches the driver."""
    sums = table.groupBy(step.alias("step")).agg(F.sum(F.octet_length("term") + F.lit(48)).alias("size")).collect()
    size = 0
    for r in sorted(sums, key=lambda r: -r["step"]):
        size += r["size"]
        if size > most:
            return table.where(step > r["step"]), table.where(step <= r["step"])
    return table, None


def tfidf_rows(df: DataFrame, id_col: str, c: str) -> DataFrame:
    """:func:`tfidf` with one row per id, also for ids without a term: (id, items, norm), items
    being an array of (term, tf, df, raw) and tfidf = raw / norm.

    Texts are shuffled once by id, and terms are counted where they are. Document frequencies are
    stored: they are broadcast as far as :func:`by_frequency` allows, and only the rarer terms
    of a document are shuffled to theirs and back."""
    # one field, null or not: a null id is an id like the others, and joins with itself
    texts = dealt(df.select(F.struct(F.col(id_col).alias("id")).alias("_k"), F.col(c).alias("_c")), "_c", "_k")
    tf = word_counts(texts, "_k", "_c")
    # of one text per id, the terms are known without the others of the id
    once = df.select(F.explode(F.array_distinct(terms(c))).alias("term")) if one_each(df, id_col) else tf.where(F.col("term").isNotNull())
    dfreq = materialize(once.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")
    # N as a scalar subquery: evaluated once, no join
    n_docs = df.select(F.count_distinct(id_col)).scalar()
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    item = F.struct("term", "tf", "df", (F.col("tf") * idf).alias("raw"))
    common, rare = by_frequency(dfreq, F.floor(F.log2("df") * 8), MAX_BROADCAST_BYTES)
    found = tf.join(F.broadcast(common), "term", "left")
    out = found.groupBy("_k").agg(F.collect_list(F.when(F.col("df").isNotNull(), item)).alias("items"))
    if rare is not None:
        left = found.where(F.col("df").isNull() & F.col("term").isNotNull()).select("_k", "term", "tf").join(rare, "term")
        more = left.groupBy("_k").agg(F.collect_list(item).alias("more"))
        out = out.join(more, "_k", "left").withColumn("items", F.when(F.col("more").isNull(), F.col("items")).otherwise(F.concat("items", "more")))
    norm = F.sqrt(F.aggregate("items", F.lit(0.0), lambda a, x: a + x["raw"] * x["raw"]))
    return out.select(F.col("_k.id").alias(id_col), "items", norm.alias("norm"))


def tfidf(df: DataFrame, id_col: str, c: str) -> DataFrame:
    """H4: long (id, term, tf, df, tfidf) with the L2 norm per id: the rows of
    :func:`tfidf_rows`, an id's terms being bounded by its text."""
    x = tfidf_rows(df, id_col, c).select(id_col, "norm", F.inline("items"))
    return x.select(id_col, "term", "tf", "df", (F.col("raw") / F.col("norm")).alias("tfidf"))


def hash_split(df: DataFrame, id_col: str, seed: int = 42, train_tenths: int = 8,
               out: str = "is_train") -> DataFrame:
    """H6: deterministic 80/20 split by a hash of the id (stable under
    repartitioning and recomputation, unlike randomSplit): the first eight hex
    digits of md5("id|seed"), so any engine can repeat it. A null id counts as ''."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{seed}"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return df.withColumn(out, number % 10 < train_tenths)


def labelled_corpus(pos: DataFrame, neg: DataFrame, text: str = "text", label: str = "label",
                    origin: str = "origin") -> DataFrame:
    """H3 + U1: union of two sources with class 1 / 0; null text dropped."""
    a = pos.withColumn(label, F.lit(1)).withColumn(origin, F.lit("positive_source"))
    b = neg.withColumn(label, F.lit(0)).withColumn(origin, F.lit("negative_source"))
    return a.unionByName(b, allowMissingColumns=True).na.drop(subset=[text])


def fit_text_model(train: DataFrame, text: str = "text", label: str = "label", classifier: str = "svm",
                   max_iter: int = 50):
    """H4 + H5 as Spark ML stages: tokens -> counts -> weights -> L2 norm ->
    LinearSVC (or LogisticRegression when a probability is needed), fitted.

    The weights are those of :func:`tfidf`: Spark's IDF leaves out the ``+ 1`` of
    ln((1+N)/(1+df)) + 1, so its fitted vector is raised by one. The vocabulary is
    every term of ``train``, none is cut; like the coefficients of any linear
    model it is held by the driver."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, RegexTokenizer
    from pyspark.ml.linalg import Vectors
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=TERM_PATTERN, gaps=False,
                         toLowercase=True)
    cv = CountVectorizer(inputCol="_tok", outputCol="_tf", vocabSize=(1 << 31) - 1)
    counts = Pipeline(stages=[tok, cv]).fit(train)
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(counts.transform(train)).idf
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol="_tf", outputCol="_idf")
    nrm = Normalizer(inputCol="_idf", outputCol="features", p=2.0)
    make = LinearSVC if classifier == "svm" else LogisticRegression
    weighted = PipelineModel([*counts.stages, weigh, nrm])
    clf = make(featuresCol="features", labelCol=label, maxIter=max_iter).fit(weighted.transform(train))
    return PipelineModel([*weighted.stages, clf])


class text_pipeline:
    """The same stages as an estimator: ``text_pipeline(...).fit(train)``."""

    def __init__(self, text: str = "text", label: str = "label", classifier: str = "svm", max_iter: int = 50):
        self.options = dict(text=text, label=label, classifier=classifier, max_iter=max_iter)

    def fit(self, train: DataFrame):
        return fit_text_model(train, **self.options)


def relevance_fit(train: DataFrame, text: str = "text", label: str = "label", classifier: str = "svm"):
    """H5: a linear model on labelled text as a table of terms and weights (``textmodel``): a
    support vector machine; ``classifier="logistic"`` calibrates it to probabilities."""
    from .textmodel import linear_fit
    return linear_fit(train, text, label, calibrate=classifier == "logistic")


def relevance_filter(model, df: DataFrame, keep: int = 1, pred: str = "prediction", id_col: str | None = None) -> DataFrame:
    """H7: score rows and keep those predicted ``keep``. ``id_col`` names the id of a table with
    one text per id, so that only ids travel back to the rows."""
    scored = model.transform(df, id_col) if id_col else model.transform(df)
    return scored.filter(F.col(pred) == keep)


def score_text(df: DataFrame, c: str, scorer, out_label: str = "label",
               out_score: str = "score", batch_fn: Callable | None = None,
               schema: str | None = None, id_col: str | None = None) -> DataFrame:
    """H1: (label, score) per text.

    ``scorer`` is a calibrated ``textmodel.TextModel``, or a fitted Spark ML
    PipelineModel whose last stage gives a ``probability`` (label = the likelier
    class mapped to -1/1, score = its probability),
    or ``None`` with ``batch_fn``: a function of a pandas Series of texts that
    returns a DataFrame with ``label`` and ``score``; it runs in
    ``mapInPandas`` on Arrow batches, loaded once per task."""
    from .textmodel import TextModel
    if isinstance(scorer, TextModel):
        scored = TextModel(scorer.weights, c, scorer.scale).transform(df, id_col)
        p = F.col("probability")
        out = scored.withColumn(out_label, F.when(p > 0.5, F.lit(1)).otherwise(F.lit(-1))).withColumn(out_score, F.greatest(p, 1.0 - p))
        return out.drop(*[x for x in ("margin", "prediction", "probability") if x not in df.columns])
    if scorer is not None:
        scored = scorer.transform(df)
        prob = F.col("probability")
        from pyspark.ml.functions import vector_to_array
        arr = vector_to_array(prob)
        best = F.array_position(arr, F.array_max(arr)) - 1
        out = scored.withColumn(out_label, F.when(best == 1, F.lit(1)).otherwise(F.lit(-1))) \
            .withColumn(out_score, F.array_max(arr))
        drop = [x for x in scored.columns if x not in df.columns]
        return out.drop(*drop)
    if batch_fn is None:
        raise ValueError("give a fitted model or a batch function")
    in_cols = df.columns
    out_schema = schema or (df.schema.simpleString()[7:-1] + f",{out_label}:int,{out_score}:double")

    def run(batches):
        for pdf in batches:
            res = batch_fn(pdf[c])
            pdf = pdf.copy()
            pdf[out_label] = res["label"].astype("int32").values
            pdf[out_score] = res["score"].astype("float64").values
            yield pdf[in_cols + [out_label, out_score]]
    return df.mapInPandas(run, out_schema)
