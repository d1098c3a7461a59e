"""X3 with late rows: hourly label counts that become right however late a row comes.

An event-time window in append mode drops rows behind the watermark. Here each batch of a stream
stores the counts that its own rows add, late or not, in a folder of its own:

  parts/writer=<w>/batch=<n>/   counts per (window, key) of that batch
  folded/generation=<g>/        sums of all parts folded so far
  ledger/generation=<g>/        (writer, batch) of those parts; written last

A window's counts are the newest generation plus the parts that its ledger does not name. A
replayed batch replaces its own part, and a part that is already folded is not added again, so
repeats and crashes at any point change nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.writers import _stored

COUNTS = ("count_negative", "count_positive")


def _partial(rows: DataFrame, ts: str, key: str, label: str, size: str) -> DataFrame:
    counted = rows.filter(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col(label).isin(-1, 1))
    return (counted.groupBy(F.window(F.col(ts), size).alias("w"), F.col(key))
            .agg(*[F.count(F.when(F.col(label) == v, 1)).alias(c) for v, c in zip((-1, 1), COUNTS)])
            .select(F.col("w.start").alias(ts), key, *COUNTS))


def store_counts(batch: DataFrame, batch_id: int, path: str, ts: str = "ts", key: str = "token", label: str = "label",
                 size: str = "1 hour", writer: str = "main") -> None:
    """Store what the rows of ``batch`` add to each window. Rows without a key or a time, and
    labels other than -1 and 1, count nowhere; an empty batch adds nothing."""
    _partial(batch, ts, key, label, size).write.mode("overwrite").parquet(f"{path}/parts/writer={writer}/batch={int(batch_id)}")


def run_counts(stream: DataFrame, path: str, writer: str = "main", checkpoint: str | None = None, **columns) -> str:
    """Count everything a stream has available now and stop; returns the checkpoint used
    (``_checkpoint/<writer>`` of the store unless given). No watermark: no state is kept."""
    ck = checkpoint or f"{path.rstrip('/')}/_checkpoint/{writer}"
    q = (stream.writeStream.foreachBatch(lambda b, n: store_counts(b, n, path, writer=writer, **columns))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return ck


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None, int | None]:
    """(parts that are not folded, (writer, batch) of the folded ones, newest generation)."""
    parts = spark.read.parquet(f"{path}/parts").withColumn("writer", F.col("writer").cast("string"))
    ledger = _stored(spark, f"{path}/ledger", "parquet")
    newest = None if ledger is None else ledger.agg(F.max("generation")).first()[0]
    if newest is None:
        return parts, None, None
    done = ledger.where(F.col("generation") == newest).select(F.col("writer").cast("string").alias("writer"), "batch")
    return parts.join(done, ["writer", "batch"], "left_anti"), done, newest


def _summed(spark: SparkSession, path: str, parts: DataFrame, newest: int | None, ts: str, key: str) -> DataFrame:
    rows = parts.select(ts, key, *COUNTS)
    if newest is not None:
        rows = rows.unionByName(spark.read.parquet(f"{path}/folded").where(F.col("generation") == newest).select(ts, key, *COUNTS))
    return rows.groupBy(ts, key).agg(*[F.sum(c).alias(c) for c in COUNTS])


def read_counts(spark: SparkSession, path: str, ts: str = "ts", key: str = "token") -> DataFrame:
    """(ts, key, count_negative, count_positive, count_total) of all rows stored so far: equal to
    the batch pivot (A1) over the same rows, in whatever order and batches they came."""
    parts, _, newest = _parts(spark, path)
    return _summed(spark, path, parts, newest, ts, key).withColumn("count_total", F.col(COUNTS[0]) + F.col(COUNTS[1]))


def fold_counts(spark: SparkSession, path: str, ts: str = "ts", key: str = "token") -> int:
    """Merge the parts into a new generation, so that readers add up few files; returns its
    number. Run it from one place at a time. Parts and older generations stay as they are (a
    reader may be using them). What is folded is named before it is summed, so a part that comes
    meanwhile is left for the next time; the ledger (one file, a row a batch) makes it count."""
    parts, done, newest = _parts(spark, path)
    to = 0 if newest is None else newest + 1
    parts.select("writer", "batch").distinct().write.mode("overwrite").parquet(f"{path}/naming/generation={to}")
    named = spark.read.parquet(f"{path}/naming/generation={to}")
    _summed(spark, path, parts.join(named, ["writer", "batch"], "left_semi"), newest, ts, key).write.mode("overwrite").parquet(f"{path}/folded/generation={to}")
    named = named if done is None else named.unionByName(done)
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/generation={to}")
    return to
