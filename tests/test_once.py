"""The id ledger of X2/K3 and the rejects of S7."""

import json
import os



def _batch(spark, rows):
    return spark.createDataFrame(rows, "id string, ts timestamp, v int")


def _times(*hours):
    import datetime as dt
    return [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in hours]


def test_late_repeat_replay_and_two_writers(spark, tmpdir_fresh):
    from tidemark.streaming import read_once, store_once
    t = _times(0, 1, 5000)
    store_once(_batch(spark, [("a", t[0], 1), ("a", t[0], 1), ("b", t[1], 2), (None, t[1], 3)]), 0, tmpdir_fresh, "id")
    late = _batch(spark, [("a", t[2], 9), ("c", t[2], 4), (None, t[2], 9)])        # repeats long after any watermark
    store_once(late, 1, tmpdir_fresh, "id")
    store_once(late, 1, tmpdir_fresh, "id")                                        # the engine repeats the batch
    store_once(_batch(spark, []), 2, tmpdir_fresh, "id")
    got = lambda: sorted((r["id"] or "", r["v"]) for r in read_once(spark, tmpdir_fresh, "id").collect())
    assert got() == [("", 3), ("a", 1), ("b", 2), ("c", 4)]
    assert spark.read.parquet(f"{tmpdir_fresh}/rows").count() == 4


def test_writers_at_the_same_time(spark, tmpdir_fresh):
    """Both writers look at the ledger before either has written; the store is read once per id."""
    from tidemark.streaming import read_once, store_once
    t = _times(0)
    mine, other = os.path.join(tmpdir_fresh, "x"), os.path.join(tmpdir_fresh, "y")
    store_once(_batch(spark, [("a", t[0], 1), ("b", t[0], 1)]), 0, mine, "id", "one")
    store_once(_batch(spark, [("b", t[0], 2), ("c", t[0], 2)]), 0, other, "id", "two")
    for kind in ("rows", "ids"):                                                  # as if written side by side
        os.rename(f"{other}/{kind}/writer=two", f"{mine}/{kind}/writer=two")
    out = read_once(spark, mine, "id")
    assert out.columns == ["id", "ts", "v"]
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [("a", 1), ("b", 1), ("c", 2)]
    store_once(_batch(spark, [("c", t[0], 7), ("d", t[0], 7)]), 1, mine, "id", "one")
    assert sorted((r["id"], r["v"]) for r in read_once(spark, mine, "id").collect()) == [("a", 1), ("b", 1), ("c", 2), ("d", 7)]


def test_stream_stores_each_id_once(spark, tmpdir_fresh):
    from tidemark.streaming import read_once, run_once
    src, out = os.path.join(tmpdir_fresh, "src"), os.path.join(tmpdir_fresh, "out")
    _batch(spark, [("a", _times(0)[0], 1), ("b", _times(1)[0], 2)]).write.parquet(src)
    stream = lambda: spark.readStream.schema("id string, ts timestamp, v int").parquet(src)
    run_once(stream(), out, "id")
    _batch(spark, [("a", _times(9000)[0], 5), ("c", _times(9000)[0], 6)]).write.mode("append").parquet(src)
    run_once(stream(), out, "id")
    run_once(stream(), out, "id")
    assert sorted((r["id"], r["v"]) for r in read_once(spark, out, "id").collect()) == [("a", 1), ("b", 2), ("c", 6)]


def test_price_history_rejects(spark, tmpdir_fresh):
    from tidemark.sources import read_price_histories
    files = {"BTC": json.dumps({"Data": {"Data": [{"time": 1704067200, "volumeto": 1.5, "close": 10}, {"volumeto": 2.0}]}}, indent=1),
             "ETH": '{"Data": {"Data": [', "XRP": json.dumps({"Response": "Error"}), "ADA": json.dumps({"Data": {"Data": []}}), "DOT": ""}
    for name, text in files.items():
        with open(os.path.join(tmpdir_fresh, f"{name}.json"), "w") as f:
            f.write(text)
    prices, rejects = read_price_histories(spark, tmpdir_fresh)
    assert [(r["symbol"], r["volume"], r["close"]) for r in prices.collect()] == [("BTC", 1.5, 10.0)]
    got = {(os.path.basename(r["source_file"]).split(".")[0], r["reason"], r["n"]) for r in rejects.collect()}
    assert got >= {("BTC", "no time", 1), ("ETH", "not json", 1), ("XRP", "no data", 1)} and not any(x[0] == "ADA" for x in got)
