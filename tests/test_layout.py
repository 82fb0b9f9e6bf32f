"""Task packing of days, pruned listings, ledger snapshots, roll-ups and week dates."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tradelake.functions.timestamps import iso_text_to_ms
from tradelake.operators.files import open_steps, pattern_steps
from tradelake.plans.layout import by_day, pack_days


def test_small_days_share_tasks_and_large_ones_are_split():
    rows = {dt.date(2024, 1, d): 10 for d in range(1, 21)} | {dt.date(2024, 2, 1): 1000, None: 3}
    plan, tasks = pack_days(rows, 1 << 20, slots=4, file_bytes=300 << 20)
    by = {p.day: p for p in plan}
    assert by[dt.date(2024, 2, 1)].tasks == 4 and all(p.tasks == 1 for d, p in by.items() if d != dt.date(2024, 2, 1))
    used = [p.first + k for p in plan for k in range(p.tasks)]
    assert set(used) == set(range(tasks)) and tasks < len(used)
    hot = by[dt.date(2024, 2, 1)]
    assert all(used.count(hot.first + k) == 1 for k in range(4))
    assert pack_days({}, 1.0, 4) == ([], 1)


def test_rows_go_where_the_plan_says(spark):
    days = {dt.date(2024, 1, 1): 900, dt.date(2024, 1, 2): 5, None: 2}
    rows = [(d, k) for d, n in days.items() for k in range(n)]
    df = spark.createDataFrame(rows, "trade_date date, k int").repartition(3)
    out = by_day(df, days, 1.0, file_bytes=300).withColumn("task", F.spark_partition_id())
    tasks = {r.trade_date: r.n for r in out.groupBy("trade_date").agg(F.countDistinct("task").alias("n")).collect()}
    assert tasks == {dt.date(2024, 1, 1): 3, dt.date(2024, 1, 2): 1, None: 1} and out.count() == 907


@pytest.mark.parametrize(
    "pattern, folder, may",
    [
        ("/a/b?/c/*.x", "/a/b1/", True), ("/a/b?/c/*.x", "/a/b12/", False), ("/a/b?/c/*.x", "/a/b1/d/", False), ("/a/[xy]z/*", "/a/yz/", True),
        ("/a/[!xy]z/*", "/a/yz/", False), ("/a/*/c", "/a/q/r/", True), ("/a/year=*/m", "/a/other/", False), ("/a/year=*/m", "/a/year=1/deep/er/", True),
    ],
)
def test_folders_that_cannot_match(pattern, folder, may):
    assert bool(open_steps(pattern_steps(pattern), folder)) == may


def test_a_listing_looks_into_matching_folders_only(spark, tmp_dir):
    from tradelake.operators.files import match_files
    from tradelake.sources.listing import list_files, list_prefix, pattern_roots

    for y in (2023, 2024, 2025):
        for m in (1, 2, 10):
            os.makedirs(f"{tmp_dir}/lake/y={y}/m={m}/deep")
            for f in ("a.parquet", "deep/b.parquet"):
                with open(f"{tmp_dir}/lake/y={y}/m={m}/{f}", "w") as out:
                    out.write("x")
    for pattern in ("y=202[45]/m=?/*.parquet", "y=2024/m=1*", "y=202?/m=2/a.parquet", "*/m=10/*", "y=*"):
        pattern = f"{tmp_dir}/lake/{pattern}"
        whole = {r.path for r in match_files(list_prefix(spark, f"{tmp_dir}/lake"), pattern).collect()}
        assert {r.path for r in list_files(spark, pattern).collect()} == whole and whole
    _, looked = pattern_roots(spark, f"{tmp_dir}/lake/y=202[45]/m=?/*.parquet")
    assert len(looked) == 3 and not any("2023" in f for f in looked)


def test_week_dates_as_python_reads_them(spark):
    texts = ["2024-W01-1", "2024W011", "2020-W53-7", "2021-W53-1", "2024-W00-1", "2024-W01", "2015W53", "2024-W01-8", "2024-W011", "2024W01-1",
             "2026-W31-4T05:06:07.5Z", "2026W314 050607+0530", "2024-w01-1", "2024-01-01", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", iso_text_to_ms(F.col("t")).alias("ms")).collect()
    for r in got:
        try:
            at = dt.datetime.fromisoformat(r.t)
            at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
            assert r.ms == int(at.timestamp() * 1000), r.t
        except (ValueError, TypeError):
            assert r.ms is None, r.t


def test_parts_rolled_up_twice_give_the_same_sums(spark, tmp_dir):
    from tradelake.streaming import read_minute_price_runs, roll_up_minute_price_runs

    path = tmp_dir + "/parts"

    def part(k, n):
        df = spark.createDataFrame([(1, "A", 2.0, n), (k, "B", 3.0, 1)], "minute long, symbol string, price double, n long")
        df.withColumn("batch", F.lit(f"q-{k:012d}")).write.mode("append").partitionBy("batch").parquet(path)

    def rows():
        return sorted(tuple(r) for r in read_minute_price_runs(spark, path).select("minute", "symbol", "price", "n").collect())

    for k in range(3):
        part(k, k + 1)
    before = rows()
    assert roll_up_minute_price_runs(spark, path) == 2 and rows() == before
    assert roll_up_minute_price_runs(spark, path) == 0 and rows() == before
    part(3, 10)
    part(4, 10)
    before = rows()
    assert roll_up_minute_price_runs(spark, path) == 3 + 0 or rows() == before
    assert rows() == before and spark.read.parquet(path).select("batch").distinct().count() == 2
