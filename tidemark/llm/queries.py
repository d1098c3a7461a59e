"""Queries opN_<name>: each operator over its whole table, and their DuckDB SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.oracles import ORACLE_SQL  # noqa: F401


#: Arrow batches of whole texts, token sets and the like stay this small on both sides of a Python
#: task (Spark's own bounds, 10,000 rows and 64 MB, are set for narrow rows).
ARROW_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2048"}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application (as ``--py-files`` would), so
    that tasks can import it wherever the driver found it, and bound the session's Arrow batches."""
    import shutil
    import tempfile
    from pathlib import Path

    import tidemark
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        for name, value in ARROW_BATCH.items():
            spark.conf.set(name, value)
        root = Path(tidemark.__file__).parent
        if root.is_dir():
            archive = shutil.make_archive(f"{tempfile.mkdtemp()}/tidemark-package", "zip", root.parent, root.name)
            sc.addPyFile(archive)
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import line_dedup
    return line_dedup.report(table(spark, sf_dir, "documents"), short_repeats=True)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import quality_classifier
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = lambda d: F.coalesce(F.crc32(d["doc_id"].cast("string")) % 4 == 2, F.lit(False))
    model = quality_classifier.fit(docs, labels.where(~held_out(labels)))
    out = quality_classifier.score(docs.select("doc_id", held_out(docs).alias("held_out"), "text"), model)
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import quality_rules
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import jaccard_join
    return jaccard_join.report(table(spark, sf_dir, "documents"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import vector_dedup
    return vector_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import url_filters
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filters.fit(url_filters.labelled_by_rules(pages))
    return url_filters.judge(pages, model).drop("url")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_pieces, a digest of the ids, and whether decoding gives the text back."""
    import public_tokenizers
    from tidemark.llm import unigram
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = unigram.encode(docs, path, decoded_col="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import mixing
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sizes(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    import public_tokenizers
    from tidemark.llm import token_store
    from tidemark.session import ensure_checkpoint_dir
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex[:12]}"
    token_store.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read(spark, folder, docs)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import substring_dedup
    return substring_dedup.report(table(spark, sf_dir, "documents")).drop("spans")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes as digests."""
    import public_tokenizers
    from tidemark.llm import byte_bpe
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary, packed=True, decoded_col="decoded")
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import importance
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import fim
    from tidemark.llm.common import store
    framed = store(fim.frames(table(spark, sf_dir, "documents")), "frames")
    return fim.transform(framed).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_quality_classifier, op3_quality_rules, op4_ngram_jaccard_join, op5_vector_dedup,
                            op6_url_filters, op7_sentencepiece,
                            op8_mixing, op9_token_store, op10_substring_dedup, op11_byte_bpe, op12_importance_resampling,
                            op13_fill_in_middle)
}

