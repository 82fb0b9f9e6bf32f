"""Minute buckets: a minute's list is dealt into sorted chunks; nothing is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradelake.operators import expand_runs, minute_ohlcv, minute_prices, minute_totals


def _trades(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = []
    # a hot minute: 40 distinct prices, some repeated; a quiet minute: 2 trades
    for i in range(60):
        rows.append(("BTC", float(i % 40), 1.0, base + dt.timedelta(seconds=i % 60)))
    rows.append(("BTC", 5.0, 2.0, base + dt.timedelta(minutes=1, seconds=1)))
    rows.append(("BTC", 3.0, 1.0, base + dt.timedelta(minutes=1, seconds=2)))
    return spark.createDataFrame(rows, "symbol string, price double, quantity double, timestamp timestamp")


@pytest.mark.parametrize("chunks", [1, 5, 16])
def test_chunks_are_sorted_and_whole(spark, chunks):
    out = minute_prices(_trades(spark), chunks=chunks).collect()
    assert {r.chunk for r in out} <= set(range(chunks))
    for r in out:
        prices = [p.price for p in r.prices]
        assert prices == sorted(prices) and len(prices) == r.n_prices and sum(p.n for p in r.prices) == r.n_trades
    hot = [r for r in out if r.minute == 28401120]
    assert sorted(p.price for r in hot for p in r.prices for _ in range(p.n)) == sorted(float(i % 40) for i in range(60))
    totals = {r.minute: r.n_trades for r in minute_totals(_trades(spark)).collect()}
    assert totals == {28401120: 60, 28401121: 2}


def test_expand_runs(spark):
    row = minute_prices(_trades(spark), chunks=1).where(F.col("minute") == 28401121).select(expand_runs("prices").alias("p")).first()
    assert row.p == [3.0, 5.0]


def test_ohlcv_order(spark):
    r = minute_ohlcv(_trades(spark)).where(F.col("minute") == 28401121).first()
    assert (r.n_trades, r.open, r.close, r.high, r.low, r.volume) == (2, 5.0, 3.0, 5.0, 3.0, 3.0)
    assert abs(r.vwap - (5.0 * 2 + 3.0) / 3.0) < 1e-12


def test_ohlcv_ties_in_an_instant(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("A", 3.0, 1.0, at), ("A", 2.0, 9.0, at), ("A", 7.0, 1.0, at), ("A", 2.5, 1.0, at)]
    r = minute_ohlcv(spark.createDataFrame(rows, "symbol string, price double, quantity double, timestamp timestamp")).first()
    assert (r.open, r.close, r.low, r.high, r.n_trades) == (2.0, 7.0, 2.0, 7.0, 4)
