"""Streaming form of the incremental load (T5).

A Parquet file stream over the lake finds new files (its checkpoint remembers
which it has seen). Files that the ledger lists as loaded by anything else, such as
a batch load or another stream, are left out (a left anti join, as in the batch
loader). The rest of a micro-batch is written to the fact table with dynamic
partition overwrite and a ``load_id`` made of the query's id and the batch number,
so that a batch that is run again after a failure overwrites its own partitions,
and no other stream's; its ledger rows are written once. The stream reads lake files
written by this package (TIMESTAMP micros); mixed physical layouts need the batch
loader.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timestamps import trade_date
from ..operators.files import loaded_names
from ..plans.layout import by_day
from ..plans.ledger import file_day, ledger_rows, record
from ..plans.loader import dynamic_overwrite
from ..plans.tables import FACT_COLUMNS, require_ledger, resolve_names
from ..session import shared_root
from ..sources.trade_files import plain_path
from .batches import batch_name

_BYTES_A_ROW = 40
LAKE_SCHEMA = "symbol string, price double, quantity double, timestamp timestamp"


def lake_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files under ``root`` (recursively) as a stream of trades plus ``file_name``."""
    reader = spark.readStream.schema(LAKE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(root).select(*FACT_COLUMNS, plain_path(F.col("_metadata.file_path")).alias("file_name"))


def load_stream(spark: SparkSession, root: str, table: str, checkpoint: str, *, name: str = "stream",
                trigger: dict | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    names = resolve_names(spark, table)
    require_ledger(spark, names)
    shared_root(spark)  # lineage cuts go to the shared checkpoint folder

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load_id = f"{name}-{batch_name(spark, checkpoint, batch_id)}"
        batch = batch.persist()
        try:
            # The batch's file days: only these folders of the ledger's snapshot are read.
            days = [r[0] for r in batch.select(file_day(F.col("file_name"))).distinct().collect()]
            led = ledger_rows(spark, names, days)
            if not led.where((F.col("load_id") == load_id) & (F.col("status") == "loaded")).isEmpty():
                return  # the batch ended before, and only its commit was lost
            others = loaded_names(led.select(plain_path(F.col("file_name")).alias("file_name"), "status"))
            new = batch.join(others, "file_name", "left_anti")
            rows = new.select(*FACT_COLUMNS).withColumn("trade_date", trade_date("timestamp")).withColumn("load_id", F.lit(load_id))
            counted = new.groupBy("file_name", trade_date("timestamp").alias("trade_date")).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
            by_date = {r.trade_date: r["n"] for r in counted.groupBy("trade_date").agg(F.sum("n").alias("n")).collect()}  # one row a day
            with dynamic_overwrite(spark):
                by_day(rows, by_date, _BYTES_A_ROW).write.insertInto(names.fact, overwrite=True)
            files = counted.groupBy(F.col("file_name").alias("path")).agg(F.sum("n").alias("rows"))
            record(spark, names, files, load_id, "loaded", _dt.datetime.now(_dt.timezone.utc))
        finally:
            batch.unpersist()

    return (
        lake_stream(spark, root, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
