"""Names of micro-batches that stay the same when a batch is run again."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """The query's id, which its checkpoint keeps, and the batch number. Another stream,
    or the same one from a new checkpoint, never shares a name with this one."""
    meta = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return f"{json.loads(meta)['id']}-{batch_id:012d}"
