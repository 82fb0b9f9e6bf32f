"""Partitioned Parquet lake writer.

Layout ``<root>/year=Y/month=M/day=D/part-*.parquet`` with unpadded integers,
from processing time by default (as the reference's consumer does). Spark names
files with a job UUID, so names never collide (S6). ``batch_size`` caps rows per
file: a folder of n rows gets ``ceil(n / batch_size)`` files in a write, of which
all but one are full, however many tasks write it (``deal_files``).

At scale prefer a large ``batch_size`` (or none): the reference's 100-row files
are a per-message consumer artefact, and small files make every later listing
and scan slower.
"""

from __future__ import annotations

import datetime as _dt
import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.timestamps import processing_partitions

LAKE_PARTITIONS = ("year", "month", "day")
#: Files and rows of a task at most, and those it should have before a folder is shared by several tasks: the driver
#: moves a folder that one task wrote at once, the files of a shared one singly.
MOST_FILES, MOST_ROWS = 16_384, 4_000_000
FEWEST_FILES, FEWEST_ROWS = 64, 100_000
#: Hadoop's local file system starts processes to set the permissions of each file and of a ``.crc`` file beside it,
#: which is most of the work for a small file. Batch files get no ``.crc`` file (other file systems write none
#: either); the pages of Parquet hold checksums of their own.
NO_SIDE_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def with_lake_partitions(df: DataFrame, as_of: Column | _dt.datetime | str | None = None) -> DataFrame:
    return df.select(*df.columns, *processing_partitions(as_of))


def file_tasks(files_by_folder: list[tuple[tuple, int]], batch_size: int, slots: int) -> tuple[list[tuple[tuple, int, int]], int]:
    """``(folder, its first task, its files a task)`` and the number of tasks. Neighbouring small folders share
    a task up to an even share of all files for ``slots`` tasks; a folder above that share has several."""
    share = math.ceil(sum(n for _, n in files_by_folder) / max(1, slots))
    share = max(1, min(MOST_FILES, MOST_ROWS // batch_size, max(min(FEWEST_FILES, FEWEST_ROWS // batch_size), share)))
    out, task, held = [], 0, 0
    for folder, n in files_by_folder:
        if held and held + n > share:
            task, held = task + 1, 0
        own = math.ceil(n / share)
        out.append((folder, task, math.ceil(n / own)))
        if own > 1:
            task, held = task + own, 0
        else:
            held += n
    return out, max(1, task + (held > 0))


def deal_files(staged: DataFrame, batch_size: int) -> DataFrame:
    """Persisted ``staged`` (sorted by folder within its partitions, ``_at`` their row numbers) dealt to the tasks that
    write it, each with whole files of ``batch_size`` rows. Rows are numbered within a folder from the counts of each
    partition's rows of it, so no folder passes through one task; only the files of each folder reach the driver."""
    spark, folder = staged.sparkSession, [F.col(c) for c in LAKE_PARTITIONS]
    part = F.shiftright("_at", 33)
    earlier = Window.partitionBy(*folder).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged.groupBy(part.alias("_part"), *folder).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_start"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    sizes = runs.groupBy(*folder).agg(F.sum("_n").alias("n")).orderBy(*folder).collect()
    files = [(tuple(r)[:-1], math.ceil(r.n / batch_size)) for r in sizes]
    plan, tasks = file_tasks(files, batch_size, 2 * spark.sparkContext.defaultParallelism)
    schema = ", ".join(f"_{c} int" for c in LAKE_PARTITIONS) + ", _first int, _files int"
    dealt = spark.createDataFrame([(*f, first, n) for f, first, n in plan], schema)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LAKE_PARTITIONS])
    runs = runs.join(dealt, same).select("_part", *[f"_{c}" for c in LAKE_PARTITIONS], "_start", "_before", "_first", "_files")
    task = F.expr(f"_first + (_before + _at - _start) div (_files * {batch_size}L)")
    # Left: were a lost partition computed again in another order, its rows might make a file more but none would be lost.
    placed = staged.join(runs, (part == F.col("_part")) & same, "left")
    placed = placed.withColumn("_task", F.least(F.coalesce(task, F.lit(0)), F.lit(tasks - 1)).cast("int"))
    return placed.repartitionById(tasks, F.col("_task")).select(*[c for c in staged.columns if c != "_at"])


def write_trades(
    df: DataFrame,
    path: str,
    batch_size: int | None = None,
    as_of: Column | _dt.datetime | str | None = None,
    mode: str = "append",
) -> None:
    """Append clean trades under ``path`` partitioned by year/month/day of ``as_of``
    (processing time when None; a column such as ``col("timestamp")`` for backfills)."""
    if batch_size is not None and int(batch_size) <= 0:
        raise ValueError("batch_size must be a positive integer")
    staged = with_lake_partitions(df, as_of)
    if batch_size:
        numbered = staged.sortWithinPartitions(*LAKE_PARTITIONS).withColumn("_at", F.monotonically_increasing_id())
        numbered = numbered.persist(StorageLevel.DISK_ONLY)
        try:
            dealt = deal_files(numbered, int(batch_size))
            writer = dealt.write.mode(mode).partitionBy(*LAKE_PARTITIONS).options(**NO_SIDE_FILES)
            writer.option("maxRecordsPerFile", int(batch_size)).parquet(path)
        finally:
            numbered.unpersist()
        return
    # AQE splits a big folder into advisory-size tasks and packs small folders together.
    # With one instant for all rows the folder columns are constants, which would send
    # every row to one hash bucket: deal such rows out evenly instead.
    folders = LAKE_PARTITIONS if isinstance(as_of, Column) else ()
    staged.hint("rebalance", *folders).write.mode(mode).partitionBy(*LAKE_PARTITIONS).parquet(path)


def write_outcomes(outcomes: DataFrame, path: str, mode: str = "append") -> None:
    """``operators.trade_outcomes`` in one pass, a folder for each outcome; no exchange."""
    outcomes.write.mode(mode).partitionBy("outcome").parquet(path)


def read_outcomes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The clean trades and the reject rows of ``write_outcomes`` (or of ``stream_outcomes``), each from its own folder."""
    rows = spark.read.parquet(path)
    own = ("symbol", "price", "quantity", "timestamp")
    clean = rows.where(F.col("outcome") == "clean").drop("value", "reject_reason", "outcome")
    return clean, rows.where(F.col("outcome") == "reject").drop(*own, "outcome")
