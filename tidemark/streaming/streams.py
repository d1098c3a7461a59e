"""Streams (X1-X3).

* X1: new tweet files -> keyword filter -> Parquet sink (only new files are
  read; the checkpoint remembers which).
* X2: incremental ingest that stores each item once: a watermark bounds the
  state of ``dropDuplicatesWithinWatermark``.
* X3: hourly label counts per token in event-time windows; append mode emits
  a window once the watermark passes its end; later rows are dropped.

A run's checkpoint lives inside its sink unless given, so the two always agree
on what has been stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.keywords import find_keywords


def _raw_tweets(spark, path: str, max_files_per_trigger: int | None) -> DataFrame:
    from ..schemas import TWEET_ANY
    r = (spark.readStream.schema(TWEET_ANY).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path)


def tweet_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """X1 source: new JSON-lines tweet files (either layout, compressed or not)
    under ``path`` (a directory or glob) as a stream of (tweet_id, author_id,
    created_at, text); lines without an id are left out, lines that are not
    JSON go to :func:`reject_stream`."""
    raw = _raw_tweets(spark, path, max_files_per_trigger)
    return raw.select(
        F.coalesce(F.col("data.id"), F.col("id")).alias("tweet_id"),
        F.coalesce(F.col("data.author_id"), F.col("user.id")).alias("author_id"),
        F.coalesce(F.col("data.created_at"), F.col("created_at")).alias("created_at"),
        F.coalesce(F.col("data.text"), F.col("text")).alias("text")).filter(F.col("tweet_id").isNotNull())


def reject_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """X1 rejects (S6): the lines of new files that are not JSON, as (line, source_file)."""
    raw = _raw_tweets(spark, path, max_files_per_trigger)
    return raw.select("id", F.col("_corrupt_record").alias("line"), F.col("_metadata.file_path").alias("source_file")).filter(
        F.col("line").isNotNull() & F.col("id").isNull()).select("line", "source_file")


def keyword_filter_stream(stream: DataFrame, text: str, keywords) -> DataFrame:
    """X1 transform: rows of a stream whose text has a keyword (T6 rules)."""
    return find_keywords(stream, text, keywords).filter(F.size("words_found") > 0)


def dedup_stream(stream: DataFrame, id_cols: Sequence[str] | str, ts: str, delay: str) -> DataFrame:
    """Each id once, as long as repeats arrive within ``delay`` of event time."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(ids)


def hourly_label_counts(stream: DataFrame, ts: str = "ts", key: str = "token", label: str = "label",
                        delay: str = "1 hour", size: str = "1 hour") -> DataFrame:
    """Tumbling event-time windows x token: negative / positive / total
    counts (the batch A1 pivot in streaming form)."""
    s = stream.filter(F.col(key).isNotNull() & F.col(label).isin(-1, 1)).withWatermark(ts, delay)
    return (s.groupBy(F.window(F.col(ts), size).alias("w"), F.col(key))
            .agg(F.count(F.when(F.col(label) == -1, 1)).alias("count_negative"),
                 F.count(F.when(F.col(label) == 1, 1)).alias("count_positive"))
            .select(F.col("w.start").alias(ts), key, "count_negative", "count_positive",
                    (F.col("count_negative") + F.col("count_positive")).alias("count_total")))


def run_available_now(df: DataFrame, path: str, name: str = "", mode: str = "append",
                      checkpoint: str | None = None, fmt: str = "parquet") -> str:
    """Run a streaming DataFrame over everything available now into ``path``
    and stop; returns the checkpoint used. The default checkpoint is the folder
    ``_checkpoint`` of the sink (readers skip it), so a rerun, also by another
    session, stores only new input and never skips a batch. ``name`` names the query."""
    ck = checkpoint or f"{path.rstrip('/')}/_checkpoint"
    w = df.writeStream.queryName(name) if name else df.writeStream
    q = (w.format(fmt).outputMode(mode).option("checkpointLocation", ck)
         .trigger(availableNow=True).start(path))
    q.awaitTermination()
    return ck
