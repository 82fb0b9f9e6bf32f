"""Streaming de-duplication without loss.

Each micro-batch keeps the first row of a key that the output does not hold yet and
appends it under ``trade_date`` and a partition named after the batch. What is already
there is read for the days of the batch only, so late rows are compared like any others
and none is dropped for being late; a batch that is run again overwrites its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timestamps import trade_date
from ..operators.dedupe import new_rows
from ..operators.trades import FIELDS
from .batches import batch_name

DEDUPED_SCHEMA = "symbol string, price double, quantity double, timestamp timestamp, trade_date date, batch string"


def deduped(spark: SparkSession, path: str) -> DataFrame:
    """The rows kept so far."""
    return spark.read.schema(DEDUPED_SCHEMA).parquet(path).select(*FIELDS)


def dedupe_stream(trades: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...], trigger: dict | None = None) -> StreamingQuery:
    """Start the stream of rows with a new key into ``path``. ``keys`` must hold ``timestamp``,
    as only rows of the same day are compared."""
    if "timestamp" not in keys:
        raise ValueError("keys must hold timestamp")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_name(spark, checkpoint, batch_id)
        rows = batch.select(*FIELDS).withColumn("trade_date", trade_date("timestamp"))
        low, high = rows.agg(F.min("trade_date"), F.max("trade_date")).first()
        if low is None:
            return
        try:
            there = spark.read.schema(DEDUPED_SCHEMA).parquet(path)
        except Exception as exc:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            there = spark.createDataFrame([], DEDUPED_SCHEMA)
        there = there.where(F.col("trade_date").between(low, high) & (F.col("batch") != name))
        (
            new_rows(rows, there, keys).withColumn("batch", F.lit(name))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trade_date", "batch").parquet(path)
        )

    writer = trades.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
