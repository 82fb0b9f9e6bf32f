"""Streaming one-minute buckets.

The consumer this follows keeps every minute for ever, so no trade may be lost for
coming late and no minute withheld until the stream goes on. Each micro-batch is
aggregated on its own and written to a partition named after the batch (a batch that is
run again overwrites its own partition); reading sums the parts of a minute. There is no
watermark and no state between batches. A folder belongs to one stream.

``roll_up_*`` merges the parts of ended batches into one, so that reads grow with the minutes and
not with the batches ever run. The merged part is written first and counts only when one append
to the list beside the folder (``<path>-rolled``: merged part, part it replaces) is in; from then
on the old parts don't. Old folders are deleted afterwards, by a later run if need be.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.minutes import minute_bars, minute_price_runs
from .batches import batch_name


def _write_parts(trades: DataFrame, path: str, checkpoint: str, part, trigger: dict | None) -> StreamingQuery:
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch.sparkSession, checkpoint, batch_id)
        (
            part(batch).withColumn("batch", F.lit(name))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
        )

    writer = trades.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


ROLLED_SCHEMA = "merged string, part string"
MERGED = "merged-"


def _rolled(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(ROLLED_SCHEMA).parquet(path.rstrip("/") + "-rolled")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], ROLLED_SCHEMA)


def visible_parts(spark: SparkSession, path: str) -> DataFrame:
    """The rows that count: of batches not merged yet, and of merged parts that are listed and not merged again."""
    rows, rolled = spark.read.parquet(path), _rolled(spark, path)
    listed = rolled.select(F.col("merged").alias("batch")).distinct()
    left = rows.join(rolled.select(F.col("part").alias("batch")), "batch", "left_anti")
    finished = left.where(F.col("batch").startswith(MERGED)).join(listed, "batch", "left_semi")
    return left.where(~F.col("batch").startswith(MERGED)).unionByName(finished)


def _delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _roll_up(spark: SparkSession, path: str, merge) -> int:
    """Merge the parts of all ended batches; returns how many there were.

    The newest batch is left: it may be run again and write its part anew."""
    path = path.rstrip("/")
    rows = visible_parts(spark, path)
    names = sorted(r.batch for r in rows.select("batch").distinct().collect())  # one a batch since the last roll-up
    batches = [n for n in names if not n.startswith(MERGED)]
    newest = max(batches, key=lambda n: n.rsplit("-", 1)[1], default=None)
    parts = [n for n in names if n != newest]
    if len(parts) > 1:
        name = f"{MERGED}{uuid.uuid4().hex}"
        out = merge(rows.where(F.col("batch").isin(parts))).withColumn("batch", F.lit(name))
        out.write.mode("append").partitionBy("batch").parquet(path)
        listed = spark.createDataFrame([(name, p) for p in parts], ROLLED_SCHEMA)
        listed.coalesce(1).write.mode("append").parquet(path + "-rolled")
    there = {r.batch for r in spark.read.parquet(path).select("batch").distinct().collect()}
    replaced = {r.part for r in _rolled(spark, path).collect()}
    _delete(spark, [f"{path}/batch={n}" for n in sorted(there & replaced)])
    return len(parts) if len(parts) > 1 else 0


def stream_minute_price_runs(trades: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ("symbol",),
                             trigger: dict | None = None) -> StreamingQuery:
    """Start the stream of ``minute, *by, price, n`` parts into ``path``."""
    return _write_parts(trades, path, checkpoint, lambda df: minute_price_runs(df, by), trigger)


def read_minute_price_runs(spark: SparkSession, path: str, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """``minute, *by, price, n`` over all batches so far."""
    return _sum_runs(visible_parts(spark, path), by)


def _sum_runs(parts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return parts.groupBy("minute", *by, "price").agg(F.sum("n").alias("n"))


def roll_up_minute_price_runs(spark: SparkSession, path: str, by: tuple[str, ...] = ("symbol",)) -> int:
    return _roll_up(spark, path, lambda parts: _sum_runs(parts, by))


def stream_minute_ohlcv(trades: DataFrame, path: str, checkpoint: str, by: tuple[str, ...] = ("symbol",),
                        trigger: dict | None = None) -> StreamingQuery:
    """Start the stream of minute bars into ``path``."""
    return _write_parts(trades, path, checkpoint, lambda df: minute_bars(df, by), trigger)


def _merge_bars(parts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    first, last = F.min(F.struct("first_at", "open")), F.max(F.struct("last_at", "close"))
    return (
        parts.groupBy("minute", *by)
        .agg(
            F.sum("n_trades").alias("n_trades"),
            first.alias("first"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            last.alias("last"),
            F.sum("volume").alias("volume"),
            F.sum("turnover").alias("turnover"),
        )
        .select(
            "minute", *by, "n_trades", F.col("first.first_at").alias("first_at"), F.col("first.open").alias("open"), "high", "low",
            F.col("last.last_at").alias("last_at"), F.col("last.close").alias("close"), "volume", "turnover",
        )
    )


def roll_up_minute_ohlcv(spark: SparkSession, path: str, by: tuple[str, ...] = ("symbol",)) -> int:
    return _roll_up(spark, path, lambda parts: _merge_bars(parts, by))


def read_minute_ohlcv(spark: SparkSession, path: str, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Open/high/low/close, volume and VWAP per minute over all batches so far."""
    return _merge_bars(visible_parts(spark, path), by).select(
        "minute", *by, "n_trades", "open", "high", "low", "close", "volume", (F.col("turnover") / F.col("volume")).alias("vwap")
    )
