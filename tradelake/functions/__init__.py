"""Column expressions: every row rule is a Catalyst expression, no UDF."""

from .json import decode_json, encode_json, field, kind
from .numbers import is_positive, text_to_double, to_double
from .symbols import normalize_symbol
from .timestamps import (
    epoch_ms_wide,
    in_range,
    iso_text_to_ms,
    minute_bucket,
    ms_to_timestamp,
    parse_epoch_ms,
    processing_partitions,
    trade_date,
)

__all__ = [
    "decode_json", "encode_json", "field", "kind", "is_positive", "text_to_double", "to_double",
    "normalize_symbol", "epoch_ms_wide", "in_range", "iso_text_to_ms", "minute_bucket",
    "ms_to_timestamp", "parse_epoch_ms", "processing_partitions", "trade_date",
]
