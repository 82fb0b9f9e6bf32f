"""The file ledger as a snapshot and a short tail.

Rows are appended to the tail. ``compact_ledger`` copies the names of all loaded files into a
snapshot with a folder for each file day (the ``year=/month=/day=`` of the file's path), and
switches to it with one append, which also carries over what is still open: pending loads and
unsettled compactions. Both parts are partitions of the one ledger table:

    part=tail      gen=n  day=-            appended rows since snapshot n
    part=snapshot  gen=n  day=2024-1-31    loaded files of that day, as of the switch

The current generation is the highest that has a tail; older partitions are dropped after the
switch, by a later run if need be. So the state of loads is read from the tail alone, and the
files of a listing are looked up in the snapshot folders of their own days only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import DEFAULT_LEDGER, LEDGER_COLUMNS, TableNames, require_ledger, resolve_names

NO_DAY, OTHER = "-", "other"
#: A run that finds more finished loads than this in the tail moves them to the snapshot.
TAIL_LOADS = 32


def file_day(path: Column) -> Column:
    """The folder day of a lake file, or ``other``."""
    found = F.regexp_extract
    pattern = r"year=(\d+)/month=(\d+)/day=(\d+)/"
    day = F.concat_ws("-", *[found(path, pattern, k) for k in (1, 2, 3)])
    return F.when(day == "--", OTHER).otherwise(day)


def _partitions(spark: SparkSession, names: TableNames) -> list[tuple[str, int, str]]:
    """``part, gen, day`` of the ledger's partitions, from the catalog (about one a file day)."""
    rows = spark.sql(f"SHOW PARTITIONS {names.ledger_table}").collect()
    parts = [dict(kv.split("=", 1) for kv in r[0].split("/")) for r in rows]
    return [(p["part"], int(p["gen"]), p["day"]) for p in parts]


def generation(spark: SparkSession, names: TableNames) -> int:
    return max((gen for part, gen, _ in _partitions(spark, names) if part == "tail"), default=0)


def _rows(spark: SparkSession, names: TableNames, part: str) -> DataFrame:
    gen = generation(spark, names)
    return spark.table(names.ledger_table).where((F.col("part") == part) & (F.col("gen") == gen))


def ledger_tail(spark: SparkSession, names: TableNames) -> DataFrame:
    """Rows since the snapshot, and everything that is still open."""
    return _rows(spark, names, "tail").select(*LEDGER_COLUMNS)


def ledger_snapshot(spark: SparkSession, names: TableNames, days: list[str] | None = None) -> DataFrame:
    """Loaded files of the snapshot, of some file days if given."""
    rows = _rows(spark, names, "snapshot")
    return (rows if days is None else rows.where(F.col("day").isin(days))).select(*LEDGER_COLUMNS)


def ledger_rows(spark: SparkSession, names: TableNames, days: list[str] | None = None) -> DataFrame:
    return ledger_snapshot(spark, names, days).unionByName(ledger_tail(spark, names))


def ledger_view(spark: SparkSession, table: str, ledger_name: str = DEFAULT_LEDGER) -> DataFrame:
    """``file_name, loaded_at`` of loaded files (the reference's ledger)."""
    rows = ledger_rows(spark, resolve_names(spark, table, ledger_name))
    return rows.where(F.col("status") == "loaded").select("file_name", "loaded_at")


def already_loaded(spark: SparkSession, table: str, ledger_name: str = DEFAULT_LEDGER) -> DataFrame:
    """Distinct names of loaded files. A failing read is an error, never "empty"."""
    return ledger_view(spark, table, ledger_name).select("file_name").distinct()


def is_loaded(spark: SparkSession, table: str, file_name: str, ledger_name: str = DEFAULT_LEDGER) -> bool:
    """Point lookup of one file, in its own day's folder and the tail (a pushed-down equality filter)."""
    names = resolve_names(spark, table, ledger_name)
    day = spark.range(1).select(file_day(F.lit(file_name))).first()[0]
    rows = ledger_rows(spark, names, [day]).where((F.col("status") == "loaded") & (F.col("file_name") == file_name))
    return not rows.limit(1).isEmpty()


def append(spark: SparkSession, names: TableNames, rows: DataFrame, gen: int | None = None) -> None:
    """Append rows with the ledger's columns (``n_rows`` may be missing) to the tail."""
    if "n_rows" not in rows.columns:
        rows = rows.withColumn("n_rows", F.lit(None).cast("bigint"))
    gen = generation(spark, names) if gen is None else gen
    (
        rows.where(F.col("file_name").isNotNull())
        .select(*LEDGER_COLUMNS, F.lit("tail").alias("part"), F.lit(gen).cast("bigint").alias("gen"), F.lit(NO_DAY).alias("day"))
        .hint("rebalance")
        .write.insertInto(names.ledger_table)
    )


def record(spark: SparkSession, names: TableNames, files: DataFrame, load_id: str, status: str, at: _dt.datetime) -> None:
    """One row a file (``path``, and its ``rows`` where they are known) of a load."""
    n_rows = F.col("rows") if "rows" in files.columns else F.lit(None)
    append(spark, names, files.select(
        F.col("path").alias("file_name"), F.lit(at).cast("timestamp").alias("loaded_at"), F.lit(load_id).alias("load_id"),
        F.lit(status).alias("status"), n_rows.cast("bigint").alias("n_rows"),
    ))


def open_loads(rows: DataFrame) -> DataFrame:
    """``load_id`` of loads that were begun and neither finished nor given up."""
    ended = rows.where(F.col("status").isin("loaded", "failed")).select("load_id")
    return rows.where(F.col("status") == "pending").join(ended, "load_id", "left_anti").select("load_id").distinct()


def _drop_before(spark: SparkSession, names: TableNames, gen: int) -> None:
    old = [p for p in _partitions(spark, names) if p[1] < gen]
    for a in range(0, len(old), 200):
        specs = ", ".join(f"PARTITION (part = '{p}', gen = {g}, day = '{d}')" for p, g, d in old[a : a + 200])
        spark.sql(f"ALTER TABLE {names.ledger_table} DROP IF EXISTS {specs}")


def compact_ledger(spark: SparkSession, table: str, ledger_name: str = DEFAULT_LEDGER) -> int:
    """Move all finished loads into a new snapshot; returns how many files it lists.

    A crash before the switch leaves the old state and a snapshot nobody reads (the next run
    writes over it); one after the switch leaves old partitions nobody reads."""
    from .loader import dynamic_overwrite

    names = resolve_names(spark, table, ledger_name)
    require_ledger(spark, names)
    gen = generation(spark, names) + 1
    tail = ledger_tail(spark, names)
    loaded = F.col("status") == "loaded"
    listed = ledger_snapshot(spark, names).unionByName(tail).where(loaded)
    snapshot = listed.select(
        *LEDGER_COLUMNS, F.lit("snapshot").alias("part"), F.lit(gen).cast("bigint").alias("gen"), file_day(F.col("file_name")).alias("day")
    )
    with dynamic_overwrite(spark):
        snapshot.hint("rebalance", "day").write.insertInto(names.ledger_table, overwrite=True)
    # Open: pending loads, and compactions of the table that are not settled.
    settled = tail.where(F.col("status") == "settled").select("load_id")
    compactions = tail.where(F.col("status").isin("compacting", "compacted")).join(settled, "load_id", "left_anti")
    pending = tail.where(F.col("status") == "pending").join(open_loads(tail), "load_id", "left_semi")
    switch = spark.createDataFrame(
        [("-", _dt.datetime.now(_dt.timezone.utc), f"snapshot-{gen}", "snapshot", None)],
        "file_name string, loaded_at timestamp, load_id string, status string, n_rows bigint",
    )
    append(spark, names, pending.unionByName(compactions).unionByName(switch), gen)
    _drop_before(spark, names, gen)
    return ledger_snapshot(spark, names).count()
