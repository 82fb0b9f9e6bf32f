"""Compaction of the fact table: one load id per trade day.

Loads leave a partition per ``(trade_date, load_id)``; frequent loads leave many small
ones. ``compact_days`` writes the rows of a day's partitions again under one new load id
and drops the old partitions. It goes by ledger entries whose ``file_name`` is
``<day>/<old load id>`` and whose ``load_id`` is the new one:

    compacting  before rows are written   (found alone later: the new partitions go)
    compacted   the new partitions count  (found without ``settled``: the old ones go)
    settled     nothing is left to do

Readers through ``fact_rows`` switch from old to new partitions with the one append of
``compacted`` and never see a row twice. Partitions of loads that are not finished stay
as they are. One writer per table is assumed, as in the loader.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import by_day
from .ledger import append, ledger_tail, open_loads
from .tables import FACT_COLUMNS, TableNames, require_ledger, resolve_names

_OPEN, _DONE, _SETTLED = "compacting", "compacted", "settled"
_DROPS_PER_STATEMENT = 200
_BYTES_A_ROW = 40


def _unsettled(tail: DataFrame) -> DataFrame:
    """``load_id, trade_date, old, done`` of each partition an unsettled compaction replaces."""
    rows = tail.where(F.col("status").isin(_OPEN, _DONE, _SETTLED))
    settled = rows.where(F.col("status") == _SETTLED).select("load_id")
    still = rows.join(settled, "load_id", "left_anti")
    day, old = F.split("file_name", "/", 2)[0], F.split("file_name", "/", 2)[1]
    by_partition = still.groupBy("load_id", day.alias("trade_date"), old.alias("old")).agg(F.max((F.col("status") == _DONE).cast("int")).alias("done"))
    state = by_partition.groupBy("load_id").agg(F.max("done").alias("switched"))  # all or none: one append
    return by_partition.drop("done").join(state, "load_id")


def _spare(unsettled: DataFrame) -> DataFrame:
    """``load_id`` (the compaction) and ``trade_date, spare``: the partitions that hold rows a second time."""
    own = F.when(F.col("switched") == 1, F.col("old")).otherwise(F.col("load_id"))
    return unsettled.select("load_id", "trade_date", own.alias("spare")).distinct()


def hidden_partitions(spark: SparkSession, names: TableNames) -> DataFrame | None:
    """``trade_date, load_id`` of partitions that hold rows a second time just now; None if there are none."""
    if not spark.catalog.tableExists(f"{names.catalog}.{names.namespace}.{names.ledger}"):
        return None
    spare = _spare(_unsettled(ledger_tail(spark, names)))
    if spare.isEmpty():
        return None
    return spare.select(F.col("trade_date").cast("date").alias("trade_date"), F.col("spare").alias("load_id"))


def _record(spark: SparkSession, names: TableNames, partitions: DataFrame, load_id: str, status: str) -> None:
    now = _dt.datetime.now(_dt.timezone.utc)
    append(spark, names, partitions.select(
        F.concat_ws("/", F.col("trade_date").cast("string"), "load_id").alias("file_name"),
        F.lit(now).cast("timestamp").alias("loaded_at"),
        F.lit(load_id).alias("load_id"),
        F.lit(status).alias("status"),
    ))


def _drop(spark: SparkSession, names: TableNames, partitions: DataFrame) -> None:
    """Drop partitions (``trade_date, spare``), a few hundred a statement; the driver holds no more at a time."""
    rows = partitions.select("trade_date", "spare").toLocalIterator()
    while some := list(islice(rows, _DROPS_PER_STATEMENT)):
        specs = ", ".join(f"PARTITION (trade_date = '{d}', load_id = '{i}')" for d, i in some)
        spark.sql(f"ALTER TABLE {names.fact} DROP IF EXISTS {specs}")


def partitions(spark: SparkSession, names: TableNames) -> DataFrame:
    """``trade_date, load_id`` of every partition, from the catalog."""
    text = F.col("partition")
    return spark.sql(f"SHOW PARTITIONS {names.fact}").select(
        F.regexp_extract(text, "trade_date=([0-9-]+)", 1).alias("trade_date"), F.regexp_extract(text, "load_id=([^/]+)", 1).alias("load_id")
    ).where("trade_date <> ''")


def settle(spark: SparkSession, names: TableNames, tail: DataFrame | None = None) -> int:
    """Finish or undo compactions that were interrupted; returns how many there were."""
    spare = _spare(_unsettled(ledger_tail(spark, names) if tail is None else tail))
    ids = [r.load_id for r in spare.select("load_id").distinct().collect()]  # one a compaction that was cut short
    if ids:
        _drop(spark, names, spare.checkpoint(eager=True))
        for load_id in ids:
            _record(spark, names, spark.createDataFrame([("", load_id)], "trade_date string, load_id string"), load_id, _SETTLED)
    return len(ids)


def compact_days(spark: SparkSession, table: str, before: str | None = None, ledger_name: str = "loaded_files") -> int:
    """Give every day (before ``before``, if given) with several partitions a single one.

    Returns the number of partitions replaced. Rows stay the same.
    """
    from .loader import dynamic_overwrite

    names = resolve_names(spark, table, ledger_name)
    require_ledger(spark, names)
    settle(spark, names)
    closed = partitions(spark, names).join(open_loads(ledger_tail(spark, names)), "load_id", "left_anti")
    if before is not None:
        closed = closed.where(F.col("trade_date") < before)
    several = closed.groupBy("trade_date").agg(F.count("load_id").alias("n")).where("n > 1").select("trade_date")
    old = closed.join(several, "trade_date").select("trade_date", "load_id").checkpoint(eager=True)
    count = old.count()
    if not count:
        return 0
    load_id = f"compact-{uuid.uuid4().hex}"
    _record(spark, names, old, load_id, _OPEN)
    chosen = old.select(F.col("trade_date").cast("date").alias("trade_date"), "load_id")
    rows = spark.table(names.fact).join(chosen, ["trade_date", "load_id"], "left_semi")
    out = rows.select(*FACT_COLUMNS, "trade_date").withColumn("load_id", F.lit(load_id))
    days = {r.trade_date: r["n"] for r in rows.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a day
    with dynamic_overwrite(spark):
        by_day(out, days, _BYTES_A_ROW).write.insertInto(names.fact, overwrite=True)
    _record(spark, names, old, load_id, _DONE)
    settle(spark, names)
    return count
