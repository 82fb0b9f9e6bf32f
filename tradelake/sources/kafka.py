"""Kafka adapters.

Thin on purpose: all logic takes any DataFrame with a ``value`` column. Progress
lives in the query's checkpoint, not in a consumer group. Needs the
spark-sql-kafka package on the classpath (not bundled here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.json import encode_json

# The reference's topic and broker address.
DEFAULT_TOPIC = "btc_trades"
DEFAULT_SERVERS = "localhost:9092"


def source_options(servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC,
                   starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def sink_options(servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC, checkpoint: str | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    return opts


def kafka_source(spark: SparkSession, **kwargs) -> DataFrame:
    """Stream of ``value`` (text), ``partition``, ``offset``, ``kafka_ts``."""
    return (
        spark.readStream.format("kafka").options(**source_options(**kwargs)).load()
        .selectExpr("CAST(value AS STRING) AS value", "partition", "offset", "timestamp AS kafka_ts")
    )


def kafka_sink(df: DataFrame, checkpoint: str, cols: list[str] | None = None, **kwargs) -> StreamingQuery:
    """Encode rows as JSON and send them (at-least-once, as Kafka sinks are)."""
    return encode_json(df, cols).writeStream.format("kafka").options(**sink_options(checkpoint=checkpoint, **kwargs)).start()
