"""X3 with late rows: stored counts against the batch pivot."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidemark.operators.rollup import label_pivot
from tidemark.streaming import fold_counts, read_counts, run_counts, store_counts

SCHEMA = "ts timestamp, token string, label int"


def _rows(n, seed, hours):
    r, t0 = random.Random(seed), dt.datetime(2024, 1, 1)
    return [(t0 + dt.timedelta(minutes=r.randrange(60 * hours)), r.choice(["BTC", "ETH", None]), r.choice([-1, 0, 1, None])) for _ in range(n)]


def _sorted(df):
    return sorted(map(tuple, df.select("ts", "token", "count_negative", "count_positive", "count_total").collect()), key=str)


def _batch_counts(df):
    return _sorted(label_pivot(df.withColumn("ts", F.date_trunc("hour", "ts"))))


def test_late_rows_replays_and_folding(spark, tmpdir_fresh):
    batches = [spark.createDataFrame(_rows(200, 1, 48), SCHEMA), spark.createDataFrame(_rows(100, 2, 3), SCHEMA),
               spark.createDataFrame([], SCHEMA), spark.createDataFrame([(None, "BTC", 1)] + _rows(50, 3, 1), SCHEMA)]
    store_counts(batches[0], 0, tmpdir_fresh)
    assert _sorted(read_counts(spark, tmpdir_fresh)) == _batch_counts(batches[0])
    assert fold_counts(spark, tmpdir_fresh) == 0
    store_counts(batches[0], 0, tmpdir_fresh)                  # replayed after it was folded
    store_counts(batches[1], 1, tmpdir_fresh)                  # hours that were stored long ago
    store_counts(batches[1], 1, tmpdir_fresh)
    store_counts(batches[2], 2, tmpdir_fresh)
    store_counts(batches[3], 0, tmpdir_fresh, writer="second")
    every = batches[0].union(batches[1]).union(batches[3])
    assert _sorted(read_counts(spark, tmpdir_fresh)) == _batch_counts(every)
    assert fold_counts(spark, tmpdir_fresh) == 1 and fold_counts(spark, tmpdir_fresh) == 2
    assert _sorted(read_counts(spark, tmpdir_fresh)) == _batch_counts(every)


def test_a_crash_while_folding_changes_nothing(spark, tmpdir_fresh):
    """Sums without their ledger do not count; the next fold replaces them."""
    rows = spark.createDataFrame(_rows(80, 5, 5), SCHEMA)
    store_counts(rows, 0, tmpdir_fresh)
    (read_counts(spark, tmpdir_fresh).drop("count_total").write.parquet(os.path.join(tmpdir_fresh, "folded", "generation=0")))
    assert _sorted(read_counts(spark, tmpdir_fresh)) == _batch_counts(rows)
    fold_counts(spark, tmpdir_fresh)
    assert _sorted(read_counts(spark, tmpdir_fresh)) == _batch_counts(rows)


def test_stream_counts_equal_the_batch(spark, tmpdir_fresh):
    src, out = os.path.join(tmpdir_fresh, "src"), os.path.join(tmpdir_fresh, "out")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(src)
    spark.createDataFrame(_rows(150, 7, 72), SCHEMA).write.parquet(src)
    run_counts(stream(), out)
    spark.createDataFrame(_rows(60, 8, 2), SCHEMA).write.mode("append").parquet(src)      # far behind any watermark
    run_counts(stream(), out)
    run_counts(stream(), out)
    assert _sorted(read_counts(spark, out)) == _batch_counts(spark.read.parquet(src))
