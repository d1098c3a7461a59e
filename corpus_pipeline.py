"""A training corpus from `documents`: STAGES run one after another, each on all rows its
predecessor kept.

1. quality     rows that the quality classifier rejects go
2. line_dedup  lines within two edits of an earlier line go, short ones if equal to one
3. near_dedup  of each group of near-duplicate documents one stays
4. mix         sources are cut or repeated to their target weights
5. tokens      texts become piece ids"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, line_dedup, mixing, quality_classifier, unigram
from tidemark.llm.common import store
from tidemark.llm.queries import table

#: A document stays if its score reaches this.
LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled rows of ``docs``, then keep the rows that score well. Without any
    labelled row there is no model, and all rows stay."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    if not model.weights.any():
        return docs
    names = docs.columns
    scored = quality_classifier.score(docs.withColumn("__text", F.col("text")), model, text_col="__text", score_col="__score")
    return scored.where(F.col("__score") >= LEAST_QUALITY).select(*names)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.clean(docs, short_repeats=True)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = unigram.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup), ("mix", mix), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
