"""X2/K3 without a time limit: each id is stored once, however late a repeat comes.

Every batch of every writer has a folder of its own, and a ledger beside it holds the ids it
stored, in hash buckets:

  rows/writer=<w>/batch=<n>/            the rows
  ids/writer=<w>/batch=<n>/bucket=<k>/  their ids

A batch stores the ids that no other batch has in the ledger. Its folders are replaced as a
whole, so a replayed batch (the engine repeats one after a failure, with the same number) leaves
the same rows once. Two writers that run at the same time may both store an id before either sees
the other's ledger; :func:`read_once` settles those: the smaller (batch, writer) owns the id."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import unique_by
from ..sources.writers import _stored


def _ids(id_cols: Sequence[str] | str) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def _same(n: int) -> Column:
    return reduce(and_, [F.col(f"_id{i}").eqNullSafe(F.col(f"_old{i}")) for i in range(n)])


def store_once(batch: DataFrame, batch_id: int, path: str, id_cols: Sequence[str] | str, writer: str = "main",
               buckets: int = 16) -> None:
    """Store the rows of ``batch`` whose id no other batch under ``path`` has stored, each id
    once (the row that sorts first). Null ids count as one id. An empty batch stores nothing.
    Columns must not be named writer or batch, which the folders add."""
    ids, spark = _ids(id_cols), batch.sparkSession
    if {"writer", "batch"} & set(batch.columns):
        raise ValueError("writer and batch are columns of the store")
    here = f"writer={writer}/batch={int(batch_id)}"
    new = unique_by(batch, ids, [])
    key = lambda d: d.withColumns({f"_id{i}": F.col(c) for i, c in enumerate(ids)}).withColumn(
        "bucket", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in ids]), F.lit(buckets)).cast("int"))
    ledger = _stored(spark, f"{path}/ids", "parquet")
    if ledger is not None:
        others = ledger.where((F.col("writer").cast("string") != writer) | (F.col("batch") != int(batch_id)))
        others = others.select(F.col("bucket").alias("_b"), *[F.col(f"_id{i}").alias(f"_old{i}") for i in range(len(ids))])
        new = key(new).join(others, (F.col("bucket") == F.col("_b")) & _same(len(ids)), "left_anti")
    new.select(*batch.columns).write.mode("overwrite").parquet(f"{path}/rows/{here}")
    # the ledger tells what was stored, not what a second evaluation would give
    stored = key(spark.read.schema(batch.schema).parquet(f"{path}/rows/{here}"))
    (stored.select("bucket", *[f"_id{i}" for i in range(len(ids))]).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/ids/{here}"))


def run_once(stream: DataFrame, path: str, id_cols: Sequence[str] | str, writer: str = "main", checkpoint: str | None = None) -> str:
    """Run a stream over everything available now into the store and stop; returns the
    checkpoint used (``_checkpoint/<writer>`` of the store unless given)."""
    ck = checkpoint or f"{path.rstrip('/')}/_checkpoint/{writer}"
    q = (stream.writeStream.foreachBatch(lambda b, n: store_once(b, n, path, id_cols, writer))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return ck


def read_once(spark: SparkSession, path: str, id_cols: Sequence[str] | str) -> DataFrame:
    """The rows of the store, each id once. Only ids are grouped; ids that two writers stored
    at the same time are the only rows joined."""
    ids = _ids(id_cols)
    names = [f"_id{i}" for i in range(len(ids))]
    ledger = spark.read.parquet(f"{path}/ids").withColumn("writer", F.col("writer").cast("string"))
    twice = (ledger.groupBy(*names).agg(F.min(F.struct("batch", "writer")).alias("_own"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select(F.col("_own"), *[F.col(n).alias(f"_old{i}") for i, n in enumerate(names)]))
    rows = spark.read.parquet(f"{path}/rows").withColumn("writer", F.col("writer").cast("string"))
    rows = rows.withColumns({f"_id{i}": F.col(c) for i, c in enumerate(ids)})
    other = F.struct("batch", "writer") != F.col("_own")
    return rows.join(twice, _same(len(ids)) & other, "left_anti").drop("writer", "batch", *names)
