"""Stream messages to the lake.

``readStream`` (Kafka, or text files for tests) -> decode -> validate/clean ->
Parquet file sink partitioned by processing-time ``year/month/day``. The file
sink's commit log in ``checkpoint`` makes the output exactly-once: a restart
re-plans uncommitted batches and readers of ``path`` see committed files only.
Unlike the reference's buffer, nothing is held in memory between batches and the
last partial batch is written too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.json import Codec, decode_json
from ..operators.exchange import from_exchange
from ..operators.trades import message_fields, split_trades, trade_outcomes
from ..plans.writer import LAKE_PARTITIONS, with_lake_partitions


def decode_trades(messages: DataFrame, raw: bool = False, keep: tuple[str, ...] = (), codec: Codec = F.try_parse_json):
    """Text messages (column ``value``) -> ``Split`` of clean trades and rejects.

    ``raw=True`` for exchange messages (``s, p, q, T``), else canonical events."""
    decoded = decode_json(messages, codec=codec)
    fields = from_exchange(decoded) if raw else message_fields(decoded)
    return split_trades(fields, keep=keep)


def _start(df: DataFrame, path: str, checkpoint: str, trigger: dict | None, options: dict,
           partitions: tuple[str, ...]) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    for k, v in options.items():
        writer = writer.option(k, v)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return writer.start(path)


def stream_trades(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    raw: bool = False,
    batch_size: int | None = None,
    as_of=None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the clean-trades stream into the lake at ``path``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (``{"availableNow": True}``
    processes what is there and stops)."""
    clean = with_lake_partitions(decode_trades(messages, raw).clean, as_of)
    options = {"maxRecordsPerFile": int(batch_size)} if batch_size else {}
    return _start(clean, path, checkpoint, trigger, options, LAKE_PARTITIONS)


def for_each_batch(messages: DataFrame, fn, checkpoint: str, *, raw: bool = False,
                   trigger: dict | None = None) -> StreamingQuery:
    """Call ``fn(clean_trades, batch_id)`` for every micro-batch of clean trades.

    The reference plugs a per-message callback into its socket client; here the
    callback gets a whole micro-batch as a DataFrame (use ``DataFrame.transform``
    for pure logic). ``fn`` should be idempotent per ``batch_id``: a batch is
    replayed after a failure.
    """
    clean = decode_trades(messages, raw).clean
    writer = clean.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def stream_outcomes(messages: DataFrame, path: str, checkpoint: str, *, raw: bool = False,
                    trigger: dict | None = None) -> StreamingQuery:
    """Clean trades and reject rows of a stream in one query, so each message is read and judged
    once; ``plans.writer.read_outcomes`` gives both."""
    decoded = decode_json(messages)
    fields = from_exchange(decoded) if raw else message_fields(decoded)
    return _start(trade_outcomes(fields), path, checkpoint, trigger, {}, ("outcome",))


def stream_rejects(messages: DataFrame, path: str, checkpoint: str, *, raw: bool = False,
                   trigger: dict | None = None) -> StreamingQuery:
    """Reject rows (``value, reject_reason``) of the same stream, as their own query."""
    return _start(decode_trades(messages, raw).rejects, path, checkpoint, trigger, {}, ())
