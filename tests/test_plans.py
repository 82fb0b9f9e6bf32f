"""The executed plans are the ones meant."""

import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tradelake import scratch_dir
from tradelake.operators import minute_ohlcv, minute_prices
from tradelake.operators.files import pending_files
from tradelake.plans import ensure_tables, rows_to_add
from tradelake.plans.writer import LAKE_PARTITIONS, with_lake_partitions

SCHEMA = "symbol string, price double, quantity double, timestamp timestamp"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _trades(spark):
    return spark.range(1000).select(
        F.lit("A").alias("symbol"), F.rand(1).alias("price"), F.rand(2).alias("quantity"),
        F.timestamp_millis(F.col("id") * 7_000_000).alias("timestamp"),
    )


def test_ohlcv_uses_hash_aggregates(spark):
    plan = _plan(minute_ohlcv(_trades(spark)))
    assert "SortAggregate" not in plan and "Sort " not in plan and "HashAggregate" in plan


def test_minute_prices_needs_two_exchanges_and_no_join(spark):
    plan = _plan(minute_prices(_trades(spark)))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_pending_files_reads_the_ledger_once_and_as_it_is(spark):
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    ledger = spark.createDataFrame([("a", "loaded"), ("a", "loaded"), ("b", "pending")], "file_name string, status string")
    pending = pending_files(files, ledger)
    assert "Aggregate" not in _plan(pending) and [r.path for r in pending.collect()] == ["b"]


def test_write_deals_constant_folders_evenly(spark, tmp_dir):
    from tradelake.plans import write_trades

    seen = []
    df = _trades(spark)
    for as_of, keyed in ((None, False), ("2026-04-04", False), (F.col("timestamp"), True)):
        staged = with_lake_partitions(df, as_of).hint("rebalance", *(LAKE_PARTITIONS if keyed else ()))
        seen.append("hashpartitioning" in _plan(staged))
        write_trades(df, f"{tmp_dir}/lake", as_of=as_of, mode="overwrite")
        assert spark.read.parquet(f"{tmp_dir}/lake").count() == 1000
    assert seen == [False, False, True]


def _data_files(path):
    return [os.path.join(folder, f) for folder, _, files in os.walk(path) for f in files if f.startswith("part-")]


def test_batch_files_are_full_though_several_tasks_write_a_day(spark, tmp_dir):
    from tradelake.plans import write_trades

    day = F.when(F.col("id") % 50 != 0, F.timestamp_seconds(F.floor(F.col("id") / 1500) * 86_400))  # some have no time
    df = spark.range(0, 4000, 1, 3).select(F.lit("A").alias("symbol"), F.col("id").cast("double").alias("price"), F.lit(1.0).alias("quantity"), day.alias("timestamp"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1000")  # a day is above what one task is meant to read
    try:
        for name, as_of in (("own", F.col("timestamp")), ("one", "2026-04-04")):
            write_trades(df, f"{tmp_dir}/{name}", batch_size=7, as_of=as_of)
            back = spark.read.parquet(f"{tmp_dir}/{name}")
            files = back.groupBy(*LAKE_PARTITIONS, F.col("_metadata.file_name")).count()
            got = {r.day: (r.n, r.files, r.most) for r in files.groupBy("day").agg(F.sum("count").alias("n"), F.count("*").alias("files"), F.max("count").alias("most")).collect()}
            rows = {1: 1470, 2: 1470, 3: 980, None: 80} if name == "own" else {4: 4000}
            assert got == {d: (n, -(-n // 7), 7) for d, n in rows.items()}
            assert sorted(r.price for r in back.select("price").collect()) == [float(k) for k in range(4000)]
            tasks = {re.match(r"part-(\d+)", os.path.basename(f)).group(1) for f in _data_files(f"{tmp_dir}/{name}")}
            assert len(tasks) >= 4  # days are shared
    finally:
        spark.conf.unset(size)


def test_batch_files_have_checksums_in_their_pages_and_none_beside(spark, tmp_dir):
    from tradelake.plans import write_trades

    write_trades(_trades(spark), f"{tmp_dir}/lake", batch_size=1000, as_of="2026-04-04")
    write_trades(_trades(spark), f"{tmp_dir}/lake", batch_size=1000, as_of="2026-04-04")  # appended
    assert spark.read.parquet(f"{tmp_dir}/lake").count() == 2000
    assert not [f for _, _, files in os.walk(f"{tmp_dir}/lake") for f in files if f.endswith(".crc")]
    first, second = sorted(_data_files(f"{tmp_dir}/lake"))
    assert pq.ParquetFile(first, page_checksum_verification=True).read().num_rows == 1000
    column = pq.ParquetFile(second).metadata.row_group(0).column(1)
    with open(second, "r+b") as f:
        f.seek(column.data_page_offset + column.total_compressed_size // 2)
        byte = f.read(1)
        f.seek(-1, os.SEEK_CUR)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(OSError, match="CRC"):
        pq.ParquetFile(second, page_checksum_verification=True).read()


def test_small_folders_share_a_writing_task_and_large_ones_have_several():
    from tradelake.plans.writer import MOST_FILES, file_tasks

    assert file_tasks([], 100, 4) == ([], 1)
    days = [((2024, 1, d), 10) for d in range(1, 9)] + [((2024, 2, 1), 1000), ((None, None, None), 5)]
    plan, tasks = file_tasks(days, 100, 4)  # 1,085 files, at most 272 a task
    assert [(first, files) for _, first, files in plan] == [(0, 10)] * 8 + [(1, 250), (5, 5)] and tasks == 6
    assert file_tasks(days[:8], 100, 1000)[1] == 2  # not a task for each ten files
    assert file_tasks([((2024, 1, 1), 9)], 1_000_000, 1) == ([((2024, 1, 1), 0, 3)], 3)  # 4,000,000 rows a task
    assert file_tasks([((2024, 1, 1), 10 * MOST_FILES)], 1, 1)[1] == 10


def test_merge_reads_only_the_staged_days(spark):
    table = "t_merge.btc_trades"
    ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    staged = _trades(spark).where(F.col("timestamp") < "1970-01-03")
    plan = _plan(rows_to_add(spark, staged, table, ("symbol", "timestamp")))
    assert re.search(r"PartitionFilters: \[[^\]]*trade_date[^\]]*1970-01-02", plan)
    assert rows_to_add(spark, staged, table, ("symbol", "timestamp")).count() == staged.count()


def test_merge_works_the_staged_trades_out_once(spark):
    table = "t_merge_once.btc_trades"
    ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(symbol):
        seen.add(1)
        return symbol

    staged = _trades(spark).select(counted("symbol").alias("symbol"), "price", "quantity", "timestamp")
    both = staged.unionByName(staged.where(F.col("price") < 2))
    assert rows_to_add(spark, both, table, ("symbol", "timestamp")).count() == 1000
    assert seen.value == 2000


def test_each_half_is_chosen_before_it_is_decoded(spark, monkeypatch):
    from tradelake import workloads

    plans, write = [], workloads._one_file_a_day
    monkeypatch.setattr(workloads, "_one_file_a_day", lambda rows, lake: (plans.append(_plan(rows)), write(rows, lake))[1])
    workloads.q_two_streams(spark, "/root/testdata/sf0.001").collect()
    assert len(plans) == 2
    for plan in plans:  # the chosen rows come from below the generator that the rules end in
        assert plan.rindex("event_id") > plan.rindex("Generate") and re.search(r"Filter .*event_id", plan[plan.rindex("Generate"):])
