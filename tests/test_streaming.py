"""Streams give the batch answer; Kafka adapters build the right options."""

from pyspark.sql import functions as F

from tradelake import scratch_dir
from tradelake.sources import kafka
from tradelake.sources.messages import events_as_messages
from tradelake.streaming import decode_trades, read_minute_price_runs, stream_minute_price_runs, stream_trades
from tradelake.operators import minute_price_runs

SF = "/root/testdata/sf0.001"


def _messages(spark):
    folder = scratch_dir(spark, "msgs")
    events_as_messages(spark, SF).select("value").write.text(folder)
    return folder


def test_stream_clean_equals_batch(spark):
    folder = _messages(spark)
    lake = scratch_dir(spark, "lake")
    q = stream_trades(spark.readStream.schema("value string").text(folder), lake, scratch_dir(spark, "ck"),
                      raw=True, batch_size=100, trigger={"availableNow": True})
    q.awaitTermination()
    streamed = spark.read.parquet(lake).select("symbol", "price", "quantity", "timestamp")
    batch = decode_trades(spark.read.text(folder), raw=True).clean
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    per_file = spark.read.parquet(lake).groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 100


def test_stream_rerun_adds_nothing(spark):
    folder = _messages(spark)
    lake, ck = scratch_dir(spark, "lake"), scratch_dir(spark, "ck")
    for _ in range(2):
        stream_trades(spark.readStream.schema("value string").text(folder), lake, ck, raw=True,
                      trigger={"availableNow": True}).awaitTermination()
    batch = decode_trades(spark.read.text(folder), raw=True).clean
    assert spark.read.parquet(lake).count() == batch.count()


def _late_files(spark):
    """Five text files; the third holds trades an hour older than the second."""
    folder = scratch_dir(spark, "late")
    times = [1704067200000, 1704070800000, 1704067230000, 1704070860000, 1704074400000]
    for i, t in enumerate(times):
        rows = [(f'{{"s":"btc","p":"{10 + i}","q":"1","T":{t + k}}}',) for k in range(2)]
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(folder)
    return folder


def _one_file_a_batch(spark, folder):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(folder)


def test_minute_streams_lose_no_late_trade(spark):
    from tradelake.operators import minute_ohlcv
    from tradelake.streaming import read_minute_ohlcv, stream_minute_ohlcv

    folder = _late_files(spark)
    batch = decode_trades(spark.read.text(folder), raw=True).clean
    trades = decode_trades(_one_file_a_batch(spark, folder), raw=True).clean
    runs, bars = scratch_dir(spark, "runs"), scratch_dir(spark, "bars")
    now = {"availableNow": True}
    stream_minute_price_runs(trades, runs, scratch_dir(spark, "ck"), trigger=now).awaitTermination()
    stream_minute_ohlcv(trades, bars, scratch_dir(spark, "ck"), trigger=now).awaitTermination()
    assert spark.read.parquet(runs).select("batch").distinct().count() == 5
    key = lambda r: tuple(str(v) for v in r)
    got = read_minute_price_runs(spark, runs)
    assert got.agg(F.sum("n")).first()[0] == 10
    want = minute_price_runs(batch).select(*got.columns)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    got = read_minute_ohlcv(spark, bars)
    assert sorted(map(key, got.collect())) == sorted(map(key, minute_ohlcv(batch).select(*got.columns).collect()))


def test_a_batch_that_runs_again_overwrites_itself(spark):
    """The sink's own commit is lost after the write: the batch is planned again under its name."""
    import os

    folder, out, ck = _late_files(spark), scratch_dir(spark, "again"), scratch_dir(spark, "ck")
    now = {"availableNow": True}

    def run():
        trades = decode_trades(_one_file_a_batch(spark, folder), raw=True).clean
        stream_minute_price_runs(trades, out, ck, trigger=now).awaitTermination()

    run()
    commits = os.path.join(ck.removeprefix("file:"), "commits")
    for name in ("4", ".4.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    run()
    assert read_minute_price_runs(spark, out).agg(F.sum("n")).first()[0] == 10


def test_kafka_options():
    opts = kafka.source_options(servers="b:9092", topic="btc_trades", max_offsets_per_trigger=1000)
    assert opts["subscribe"] == "btc_trades" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "1000" and opts["kafka.bootstrap.servers"] == "b:9092"
    sink = kafka.sink_options(topic="btc_trades", checkpoint="/c")
    assert sink == {"kafka.bootstrap.servers": "localhost:9092", "topic": "btc_trades", "checkpointLocation": "/c"}


def test_for_each_batch_callback(spark):
    from tradelake.streaming import for_each_batch

    folder = _messages(spark)
    seen = []
    q = for_each_batch(spark.readStream.schema("value string").text(folder),
                       lambda df, bid: seen.append((bid, df.count())), scratch_dir(spark, "ck"),
                       raw=True, trigger={"availableNow": True})
    q.awaitTermination()
    assert sum(n for _, n in seen) == decode_trades(spark.read.text(folder), raw=True).clean.count()


def test_stream_rejects_match_batch(spark):
    from tradelake.streaming import stream_rejects

    folder = scratch_dir(spark, "msgs")
    bad = spark.createDataFrame([('{"s":"x","p":"0","q":"1","T":1704067200000}',), ("notjson",), ("[1]",)], "value string")
    events_as_messages(spark, SF).select("value").unionByName(bad).write.text(folder)
    out = scratch_dir(spark, "rej")
    stream_rejects(spark.readStream.schema("value string").text(folder), out, scratch_dir(spark, "ck"),
                   raw=True, trigger={"availableNow": True}).awaitTermination()
    got = {r.reject_reason: r.n for r in spark.read.parquet(out).groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    batch = decode_trades(spark.read.text(folder), raw=True).rejects
    want = {r.reject_reason: r.n for r in batch.groupBy("reject_reason").agg(F.count("*").alias("n")).collect()}
    assert got == want and got["malformed_json"] == 1 and got["not_an_object"] == 1


def test_dedupe_stream_keeps_late_rows(spark):
    import pytest

    from tradelake.operators.dedupe import dedupe_trades, new_rows
    from tradelake.operators.trades import FIELDS
    from tradelake.streaming import dedupe_stream, deduped

    folder = _late_files(spark)
    spark.read.text(folder).coalesce(1).write.mode("append").text(folder)  # every message again
    out = scratch_dir(spark, "dedupe")
    trades = decode_trades(_one_file_a_batch(spark, folder), raw=True).clean
    dedupe_stream(trades, out, scratch_dir(spark, "ck"), FIELDS, {"availableNow": True}).awaitTermination()
    batch = decode_trades(spark.read.text(folder), raw=True).clean
    distinct = dedupe_trades(batch, FIELDS)
    assert deduped(spark, out).count() == distinct.count() == batch.count() // 2 == 10
    assert new_rows(batch, distinct, FIELDS).count() == 0
    with pytest.raises(ValueError):
        dedupe_stream(trades, out, "x", ("symbol",))


def _lake(spark, day, rows):
    lake = scratch_dir(spark, "lake")
    stamp = f"2025-11-{day:02d} 00:00:00"
    spark.range(rows).selectExpr("'A' symbol", "double(id + 1) price", "1d quantity", f"timestamp'{stamp}' timestamp").coalesce(1).write.parquet(lake)
    return lake


def test_load_streams_share_a_table(spark):
    from tradelake.plans import ensure_tables, fact_view, ledger_view, load_batch
    from tradelake.streaming import load_stream

    table = "t_streams.trades"
    ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    one, two, three = (_lake(spark, 5, 10) for _ in range(3))
    load_batch(spark, one + "/*.parquet", table).collect()
    now = {"availableNow": True}
    for lake in (one, two, three):
        load_stream(spark, lake, table, scratch_dir(spark, "ck"), trigger=now).awaitTermination()
    load_stream(spark, two, table, scratch_dir(spark, "ck"), trigger=now).awaitTermination()  # a fresh checkpoint
    assert fact_view(spark, table).count() == 30
    assert ledger_view(spark, table).count() == 3
    assert load_batch(spark, three + "/*.parquet", table).first().files_loaded == 0


def test_repeated_json_keys_take_the_last_value(spark):
    rows = [('{"s":"a","p":"1","p":"2","q":"1","T":1704067200000}',)]
    split = decode_trades(spark.createDataFrame(rows, "value string"), raw=True)
    assert [r.price for r in split.clean.collect()] == [2.0] and split.rejects.count() == 0
