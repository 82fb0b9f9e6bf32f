"""Structured Streaming forms of ingest, minute buckets, de-duplication and load."""

from .dedupe import dedupe_stream, deduped
from .ingest import decode_trades, for_each_batch, stream_outcomes, stream_rejects, stream_trades
from .load import lake_stream, load_stream
from .minutes import (
    read_minute_ohlcv,
    read_minute_price_runs,
    roll_up_minute_ohlcv,
    roll_up_minute_price_runs,
    stream_minute_ohlcv,
    stream_minute_price_runs,
)

__all__ = [
    "decode_trades", "dedupe_stream", "deduped", "for_each_batch", "stream_outcomes", "stream_rejects", "stream_trades", "lake_stream",
    "load_stream", "read_minute_ohlcv", "read_minute_price_runs", "roll_up_minute_ohlcv", "roll_up_minute_price_runs", "stream_minute_ohlcv", "stream_minute_price_runs",
]
