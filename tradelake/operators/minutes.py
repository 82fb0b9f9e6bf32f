"""One-minute buckets of clean trades.

The reference keys a map by ``timestamp // 60000`` and means to collect each
minute's prices into a list. A plain ``collect_list`` per minute would put every
trade of a busy minute into one array in one task, so the list is built in
steps that keep every group bounded:

1. ``minute_price_runs``: ``(minute, symbol, price) -> n`` with map-side partial
   aggregation. Repeated ticks collapse before the shuffle, and a hot minute is
   spread over its distinct prices.
2. ``minute_prices``: each minute's runs are dealt into ``chunks`` price-sorted
   arrays of ``(price, n)`` runs by a hash of the price (the run-length form of the
   sorted price list). The number of chunks is a constant of the call, whatever the
   size of a minute; a hot minute's list is spread over that many tasks.
   ``minute_totals`` has the sums over a whole minute.

``expand_runs`` turns a chunk's runs back into the flat sorted list when it is
known to be small. ``minute_ohlcv`` (open/high/low/close, volume, VWAP) is the
natural use of the buckets; all its aggregates combine partially.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import MINUTE_MS, minute_bucket

DEFAULT_CHUNKS = 16


def with_minute(trades: DataFrame, ts: str = "timestamp", out: str = "minute") -> DataFrame:
    return trades.withColumn(out, minute_bucket(F.unix_millis(F.col(ts))))


def minute_price_runs(trades: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """``minute, *by, price, n``: how many trades of each price in each minute."""
    keys = ["minute", *by, "price"]
    return with_minute(trades).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def minute_totals(trades: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """``minute, *by, n_trades``."""
    return with_minute(trades).groupBy("minute", *by).agg(F.count(F.lit(1)).alias("n_trades"))


def minute_prices(trades: DataFrame, by: tuple[str, ...] = ("symbol",), chunks: int = DEFAULT_CHUNKS) -> DataFrame:
    """``minute, *by, chunk, n_trades, n_prices, prices``, all of the chunk.

    ``prices`` is ``array<struct<price double, n bigint>>`` sorted by price; the union
    of a minute's chunks is its whole list. Chunks without prices give no row.
    """
    if chunks < 1:
        raise ValueError("chunks must be positive")
    dealt = minute_price_runs(trades, by).withColumn("chunk", F.pmod(F.xxhash64("price"), F.lit(chunks)).cast("int"))
    return dealt.groupBy("minute", *by, "chunk").agg(
        F.sum("n").alias("n_trades"),
        F.count(F.lit(1)).alias("n_prices"),
        F.sort_array(F.collect_list(F.struct(F.col("price"), F.col("n")))).alias("prices"),
    )


def expand_runs(prices: Column | str) -> Column:
    """Flat sorted price list from ``(price, n)`` runs; only for lists known to be small."""
    c = F.col(prices) if isinstance(prices, str) else prices
    return F.flatten(F.transform(c, lambda r: F.array_repeat(r["price"], r["n"].cast("int"))))


def minute_bars(trades: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """``minute, *by, n_trades, first_at, open, high, low, last_at, close, volume, turnover``.

    Trades of one instant are summed up first: the open is the smallest price of the
    first instant and the close the largest of the last one, so both steps are hash
    aggregates over plain numbers (an order by a struct would sort all trades).
    """
    instants = with_minute(trades).groupBy("minute", *by, "timestamp").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("turnover"),
    )
    return instants.groupBy("minute", *by).agg(
        F.sum("n").alias("n_trades"),
        F.min("timestamp").alias("first_at"),
        F.min_by("low", "timestamp").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("timestamp").alias("last_at"),
        F.max_by("high", "timestamp").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("turnover").alias("turnover"),
    )


def minute_ohlcv(trades: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """``minute, *by, n_trades, open, high, low, close, volume, vwap, window_start``."""
    return minute_bars(trades, by).select(
        "minute", *by, "n_trades", "open", "high", "low", "close", "volume",
        (F.col("turnover") / F.col("volume")).alias("vwap"),
        F.timestamp_millis(F.col("minute") * F.lit(MINUTE_MS)).alias("window_start"),
    )
