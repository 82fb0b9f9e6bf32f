"""DataFrame-in, DataFrame-out operators."""

from .exchange import from_exchange, to_canonical_json
from .minutes import expand_runs, minute_bars, minute_ohlcv, minute_price_runs, minute_prices, minute_totals, with_minute
from .trades import Split, clean_trades, is_valid_trade, message_fields, reject_counts, split_trades, trade_outcomes, with_reject_reason

__all__ = [
    "from_exchange", "to_canonical_json", "expand_runs", "minute_bars", "minute_ohlcv", "minute_totals", "minute_price_runs",
    "minute_prices", "with_minute", "Split", "clean_trades", "is_valid_trade", "message_fields",
    "reject_counts", "split_trades", "trade_outcomes", "with_reject_reason",
]
