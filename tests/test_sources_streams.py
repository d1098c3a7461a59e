"""Readers, writers and streams in fresh temporary folders."""

import bz2
import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F

from tidemark.operators.rollup import label_pivot
from tidemark.sources import append_new, read_csv, read_tweets, write_partitions
from tidemark.streaming import dedup_stream, hourly_label_counts, keyword_filter_stream, run_available_now


def test_read_tweets_both_layouts(spark, tmpdir_fresh):
    day = os.path.join(tmpdir_fresh, "day=01")
    os.makedirs(os.path.join(day, "00"))
    v2 = json.dumps({"data": {"id": "1", "author_id": "a", "created_at": "2024-01-01T00:00:00Z", "text": "btc up"}})
    v1 = json.dumps({"id": "2", "created_at": "x", "text": "eth", "user": {"id": "u"}})
    v1_nouser = json.dumps({"id": "3", "created_at": "x", "text": "ada"})
    no_id = json.dumps({"data": {"text": "no id"}})
    with bz2.open(os.path.join(day, "00", "a.json.bz2"), "wt") as f:
        f.write("\n".join([v2, "{broken", no_id]) + "\n")
    with gzip.open(os.path.join(day, "00", "b.json.gz"), "wt") as f:
        f.write("\n".join([v1, v1_nouser]) + "\n")
    tweets, rejects = read_tweets(spark, tmpdir_fresh)
    rows = {r["tweet_id"]: r for r in tweets.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"]["author_id"] == "a" and rows["2"]["author_id"] == "u" and rows["3"]["author_id"] is None
    assert rejects.count() == 1


def test_read_csv_multiline(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "c.csv")
    with open(p, "w") as f:
        f.write('id,body\n1,"line one\nline ""two"""\n2,plain\n')
    df = read_csv(spark, p, "id long, body string")
    rows = {r["id"]: r["body"] for r in df.collect()}
    assert rows == {1: 'line one\nline "two"', 2: "plain"}


def test_partition_overwrite_is_rerun_safe(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "t")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "token string, v int")
    write_partitions(df, out, ["token"])
    write_partitions(df.filter("token = 'A'"), out, ["token"])
    assert spark.read.parquet(out).count() == 2


def test_append_new_skips_stored_ids(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "a")
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "id int, t string")
    append_new(df, out, "id")
    append_new(spark.createDataFrame([(2, "y"), (3, "z")], "id int, t string"), out, "id")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def _write_events(spark, path, rows):
    spark.createDataFrame(rows, "ts timestamp, token string, label int, id long").write.mode("append").parquet(path)


def test_stream_hourly_counts_equal_batch_closed_windows(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=h, minutes=m), tok, 1 if (h + m) % 3 else -1, h * 100 + m)
            for h in range(17) for tok in ("A", "B", "C") for m in (5, 35)]
    _write_events(spark, src, rows)
    schema = "ts timestamp, token string, label int, id long"
    stream = spark.readStream.schema(schema).parquet(src)
    out = os.path.join(tmpdir_fresh, "out")
    ck = run_available_now(hourly_label_counts(stream, delay="1 hour"), out, "x3")
    got = spark.read.parquet(out)
    assert got.count() == 45          # 17 hours x 3 tokens = 51 cells, 6 still open
    batch = label_pivot(spark.read.parquet(src).withColumn("ts", F.date_trunc("hour", "ts")))
    closed = batch.filter(F.col("ts") < F.lit(t0 + dt.timedelta(hours=15)))
    assert sorted(map(tuple, got.select(*batch.columns).collect())) == sorted(map(tuple, closed.collect()))
    # restart from the checkpoint with no new input adds nothing
    run_available_now(hourly_label_counts(spark.readStream.schema(schema).parquet(src), delay="1 hour"),
                      out, "x3", checkpoint=ck)
    assert spark.read.parquet(out).count() == 45


def test_stream_dedup_and_keyword_filter(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t0, "BTC moon"), (1, t0, "BTC moon"), (2, t0, "nothing"), (3, t0, "eth!")],
                          "id long, ts timestamp, text string").write.parquet(src)
    stream = spark.readStream.schema("id long, ts timestamp, text string").parquet(src)
    q = keyword_filter_stream(dedup_stream(stream, "id", "ts", "1 hour"), "text", ["btc", "eth"])
    out = os.path.join(tmpdir_fresh, "out")
    run_available_now(q.select("id", "word_found"), out, "x1")
    assert sorted((r["id"], r["word_found"]) for r in spark.read.parquet(out).collect()) == [(1, "btc"), (3, "eth")]


def test_read_metrics_long_table(spark, tmpdir_fresh):
    from tidemark.sources import read_metrics
    for tok, met, rows in [("BTC", "mvrv", [("2024-01-01T00:00:00Z", 1.5)]),
                           ("ETH", "sopr", [("2024-01-01T00:00:00Z", 0.9), ("2024-01-01T01:00:00Z", 1.1)])]:
        d = os.path.join(tmpdir_fresh, f"token={tok}", f"metric={met}")
        os.makedirs(d)
        with open(os.path.join(d, "part.csv"), "w") as f:
            f.write("t,value\n" + "".join(f"{t},{v}\n" for t, v in rows))
    for _ in range(2):  # a second call must see the same schema
        out = read_metrics(spark, tmpdir_fresh, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        assert out.columns == ["ts", "token", "metric", "value"]
        assert sorted((r["token"], r["metric"], r["value"]) for r in out.collect()) == [
            ("BTC", "mvrv", 1.5), ("ETH", "sopr", 0.9), ("ETH", "sopr", 1.1)]


def test_read_price_history_and_write_by_token(spark, tmpdir_fresh):
    from tidemark.sources import read_price_history, write_by_token
    src = os.path.join(tmpdir_fresh, "hist")
    os.makedirs(src)
    for sym, vols in [("BTC", [1.0, 2.0]), ("ETH", [3.0])]:
        doc = {"Data": {"Data": [{"time": 1704067200 + 86400 * i, "volumeto": v, "close": 10.0 + i}
                                 for i, v in enumerate(vols)]}}
        with open(os.path.join(src, f"{sym}.json"), "w") as f:
            json.dump(doc, f, indent=2)
    h = read_price_history(spark, src)
    assert sorted((r["symbol"], r["volume"]) for r in h.collect()) == [("BTC", 1.0), ("BTC", 2.0), ("ETH", 3.0)]
    out = os.path.join(tmpdir_fresh, "by_token")
    write_by_token(h.withColumnRenamed("symbol", "token"), out)
    assert sorted(os.listdir(out))[:2] == ["_SUCCESS", "token=BTC"] or "token=BTC" in os.listdir(out)
    assert spark.read.parquet(out).filter("token = 'ETH'").count() == 1


def test_write_predictions_rerun_safe(spark, tmpdir_fresh):
    import datetime as dt
    from tidemark.sources import write_predictions
    out = os.path.join(tmpdir_fresh, "preds")
    p = spark.createDataFrame([("BTC", dt.datetime(2024, 1, 1), 1.0)], "token string, ts timestamp, prediction double")
    write_predictions(p, out, "gbt")
    write_predictions(p, out, "gbt")
    write_predictions(p, out, "ar")
    got = spark.read.parquet(out)
    assert got.count() == 2 and sorted(r["model"] for r in got.collect()) == ["ar", "gbt"]


def test_tweet_stream_new_files_only(spark, tmpdir_fresh):
    from tidemark.streaming import keyword_filter_stream, tweet_stream
    src = os.path.join(tmpdir_fresh, "in")
    os.makedirs(src)

    def land(name, lines):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(json.dumps(x) for x in lines) + "\n")
    land("a.json", [{"data": {"id": "1", "author_id": "a", "created_at": "t", "text": "BTC to the moon"}},
                    {"id": "2", "created_at": "t", "text": "nothing here", "user": {"id": "u"}}])
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck")
    q = keyword_filter_stream(tweet_stream(spark, src), "text", ["btc", "eth"]).select("tweet_id", "word_found")
    run_available_now(q, out, "x1", checkpoint=ck)
    land("b.json", [{"id": "3", "created_at": "t", "text": "ETH!", "user": {"id": "v"}}])
    q2 = keyword_filter_stream(tweet_stream(spark, src), "text", ["btc", "eth"]).select("tweet_id", "word_found")
    run_available_now(q2, out, "x1", checkpoint=ck)
    got = sorted((r["tweet_id"], r["word_found"]) for r in spark.read.parquet(out).collect())
    assert got == [("1", "btc"), ("3", "eth")]


def test_stream_update_mode_and_late_rows(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    t0 = dt.datetime(2024, 1, 1)
    schema = "ts timestamp, token string, label int, id long"
    rows = [(t0 + dt.timedelta(hours=h, minutes=10), tok, 1 if h % 2 else -1, h)
            for h in range(6) for tok in ("A", "B")]
    _write_events(spark, src, rows)
    batch = label_pivot(spark.read.parquet(src).withColumn("ts", F.date_trunc("hour", "ts")))
    # update mode: every window so far, equal to the batch pivot
    seen = []
    q = (hourly_label_counts(spark.readStream.schema(schema).parquet(src), delay="1 hour")
         .writeStream.outputMode("update")
         .foreachBatch(lambda b, _: seen.extend(map(tuple, b.select(*batch.columns).collect())))
         .option("checkpointLocation", os.path.join(tmpdir_fresh, "ck_u"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(seen) == sorted(map(tuple, batch.collect()))
    # append mode, then a row for hour 0 arrives after the watermark passed it
    out, ck = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ck_a")
    run_available_now(hourly_label_counts(spark.readStream.schema(schema).parquet(src), delay="1 hour"),
                      out, "x3late", checkpoint=ck)
    before = spark.read.parquet(out).count()
    _write_events(spark, src, [(t0 + dt.timedelta(minutes=20), "A", 1, 999)])
    run_available_now(hourly_label_counts(spark.readStream.schema(schema).parquet(src), delay="1 hour"),
                      out, "x3late", checkpoint=ck)
    got = {(r["ts"], r["token"]): r["count_total"] for r in spark.read.parquet(out).collect()}
    assert len(got) == before and got[(t0, "A")] == 1     # the late row was dropped


def test_rerun_with_defaults_stores_only_new_files(spark, tmpdir_fresh):
    from tidemark.streaming import keyword_filter_stream, run_available_now
    src, out = tmpdir_fresh + "/in", tmpdir_fresh + "/out"
    for i in (1, 2):
        spark.createDataFrame([(i, "btc")], "id int, t string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("id int, t string").parquet(src)
        run_available_now(keyword_filter_stream(stream, "t", ["btc"]).select("id"), out)
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(1, i + 1))


def test_stream_rejects(spark, tmpdir_fresh):
    import os
    from tidemark.streaming import run_available_now
    from tidemark.streaming.streams import reject_stream
    src, out = tmpdir_fresh + "/in", tmpdir_fresh + "/out"
    os.makedirs(src)
    with open(src + "/a.json", "w") as f:
        f.write('{"id": "1", "text": "x"}\nnot json\n')
    run_available_now(reject_stream(spark, src), out)
    assert [r["line"] for r in spark.read.parquet(out).collect()] == ["not json"]


def test_append_new_null_ids_and_real_errors(spark, tmpdir_fresh):
    import pytest
    from tidemark.sources.writers import append_new
    path = tmpdir_fresh + "/t"
    df = spark.createDataFrame([(None, "n"), (1, "b"), (1, "a")], "id int, v string")
    for _ in range(3):
        append_new(df, path, "id")
    assert sorted(map(str, spark.read.parquet(path).collect())) == ["Row(id=1, v='a')", "Row(id=None, v='n')"]
    with pytest.raises(Exception):
        append_new(df, path, "id", fmt="no_such_format")


def test_write_by_token_splits_a_hot_token(spark, tmpdir_fresh):
    from pyspark.sql import functions as F
    from tidemark.sources.writers import write_by_token
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5)).alias("token"), "id")
    write_by_token(df, tmpdir_fresh + "/w")
    assert spark.read.parquet(tmpdir_fresh + "/w").groupBy("token").count().count() == 3


def test_tweet_days_are_pruned_by_path(spark, tmpdir_fresh):
    import gzip
    import os
    from tidemark.sources.readers import read_tweets
    for d in ("2021/05/01", "2021/05/02", "2021/05/03"):
        os.makedirs(f"{tmpdir_fresh}/in/{d}")
        with gzip.open(f"{tmpdir_fresh}/in/{d}/a.json.gz", "wt") as f:
            f.write('{"id": "%s", "text": "x"}\n' % d)
    tweets, _ = read_tweets(spark, tmpdir_fresh + "/in", days=("2021-05-02", "2021-05-03"))
    got = {(r["tweet_id"], str(r["day"])) for r in tweets.collect()}
    assert got == {("2021/05/02", "2021-05-02"), ("2021/05/03", "2021-05-03")}
    assert len(read_tweets(spark, tmpdir_fresh + "/in")[0].collect()) == 3
    node = [x for x in tweets._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert node and "file_path" in node[0]
