"""Incremental, exactly-once load of lake files into the fact table.

Per run:

1. resolve the table and its ledger (S24); the ledger must exist (S19) unless
   ``create=True``;
2. finish loads a previous run left half done (ledger ``pending`` rows without
   ``loaded`` or ``failed`` rows): they are re-run with their own ``load_id`` and
   file list, which overwrites exactly the partitions they may have written. If a file
   of such a load cannot be read (any more) and no partition of the load is there, nothing
   was written: the load is given up (``failed`` rows of the bad files end it) and its other
   files are new again. If there are partitions, they are left as they are, the load
   stays pending, and the file is reported;
3. list files matching the pattern (S7-S10), optionally limit (L1), and drop
   files already loaded, or held by a load that is still pending, with left anti
   joins on the ledger (J1); the ledger's tail is read once, and of its snapshot the days
   of the listing;
4. read each pending file's footer (distributed) to group files by physical
   layout; unreadable files are reported as failed, are not recorded as loaded, and
   are tried again next run (S13);
5. record ``pending`` rows; count the rows of each file and day in one narrow pass; write
   the rows, each day by as many tasks as its rows need (``plans.layout``), to the load's own
   ``(trade_date, load_id)`` partitions. If reading fails, the files' data is
   read in a distributed check; damaged files are reported and left out, and the rest is
   written under the same ``load_id``;
6. compare the counts (S25): rows of each file by its footer and by the scan, rows of each
   day by the scan and in the table. If all agree, record ``loaded`` rows with each file's
   rows (S12, S17, S18); else the load stays pending, and the next run writes it again.

All new files are one load and become visible together. ``max_files_per_load`` splits
them into several loads of about that many files, each visible on its own: a later one
may fail after an earlier one is in.

A crash between any two steps leaves either nothing visible (Spark's commit
protocol), or a pending load that the next run completes without duplicating
rows. One writer per table is assumed.

``load_batch`` returns one metrics row (S25): files found / skipped / loaded /
failed, rows loaded, number of loads, recovered, abandoned and unreconciled loads, a
five-path preview, and the paths of failed files.
"""

from __future__ import annotations

import datetime as _dt
import math
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import trade_date
from ..operators.files import limit_files, pending_files
from ..session import ensure_utc, shared_root
from ..sources.listing import list_files, preview
from ..sources.trade_files import classify_files, damaged_files, plain_path, read_classified, unparseable_files
from .compact import partitions, settle
from .layout import by_day
from .ledger import TAIL_LOADS, compact_ledger, file_day, ledger_snapshot, ledger_tail, open_loads, record
from .tables import DEFAULT_LEDGER, FACT_COLUMNS, TableNames, ensure_tables, require_ledger, resolve_names

METRICS_SCHEMA = (
    "files_found bigint, files_skipped bigint, files_loaded bigint, files_failed bigint, "
    "rows_loaded bigint, loads bigint, recovered_loads bigint, abandoned_loads bigint, unreconciled_loads bigint, "
    "preview array<string>, failed array<string>"
)
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Bytes a row takes where no footer says so.
_BYTES_A_ROW = 40


@contextmanager
def _setting(spark: SparkSession, values: dict[str, str]):
    """Session settings for an (eager) write, restored right after."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def dynamic_overwrite(spark: SparkSession):
    """insertInto ignores the writer option, so the session setting is needed.

    It also decides that an overwrite replaces the written partitions only."""
    return _setting(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"})


def _days_in_table(spark: SparkSession, names: TableNames, load_id: str) -> dict:
    """Rows of each day in the load's partitions (from footers; one row a day)."""
    tasks = str(4 * spark.sparkContext.defaultParallelism)
    with _setting(spark, {LISTING_TASKS: tasks}):  # else one listing task a partition
        mine = spark.table(names.fact).where(F.col("load_id") == load_id)
        return {r.trade_date: r["n"] for r in mine.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n")).collect()}


def _insert(spark: SparkSession, names: TableNames, classified, load_id: str, again: bool = False) -> tuple[DataFrame | None, int, list[str]]:
    """Write the files' rows to the load's own ``(trade_date, load_id)`` partitions.

    A new load has none, so its files are appended; ``again`` overwrites what a run that was
    cut short may have left (a dynamic overwrite has to move partition by partition).
    Returns the rows of each file (``path, rows``), all rows, and where the counts differ."""
    trades = read_classified(spark, classified, with_file=True).trades
    if trades is None:
        return None, 0, []
    staged = trades.withColumn("trade_date", trade_date("timestamp"))
    counted = staged.groupBy("file_name", "trade_date").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    days = {r.trade_date: r["n"] for r in counted.groupBy("trade_date").agg(F.sum("n").alias("n")).collect()}  # one row a day

    footers = spark.createDataFrame([(r.path, plain_path(r.path), r.rows) for r in classified], "path string, file_name string, footer bigint")
    scanned = counted.groupBy("file_name").agg(F.sum("n").alias("rows"))
    files = footers.join(scanned, "file_name", "left").select("path", "footer", F.coalesce("rows", F.lit(0)).alias("rows")).checkpoint(eager=True)
    wrong = [f"{r.path}: {r.footer} rows by its footer, {r.rows} read" for r in files.where(~F.col("footer").eqNullSafe(F.col("rows"))).collect()]

    total = sum(days.values())
    size = sum(r.bytes or 0 for r in classified)
    out = staged.select(*FACT_COLUMNS, "trade_date", F.lit(load_id).alias("load_id"))
    with dynamic_overwrite(spark):
        by_day(out, days, size / total if total and size else _BYTES_A_ROW).write.insertInto(names.fact, overwrite=again)
    there = _days_in_table(spark, names, load_id)
    wrong += [f"{d}: {days.get(d, 0)} rows read, {there.get(d, 0)} in the table" for d in {*days, *there} if days.get(d) != there.get(d)]
    return files.select("path", "rows"), total, wrong


def _without(classified, failed: list[tuple[str, str]]):
    gone = {p for p, _ in failed}
    return [r for r in classified if r.path not in gone]


def _write_rows(spark: SparkSession, names: TableNames, classified, load_id: str):
    """As ``_insert``, and the ``(path, error)`` of files left out because they cannot be read."""
    failed = unparseable_files(spark, classified)
    classified = _without(classified, failed)
    try:
        return *_insert(spark, names, classified, load_id), failed
    except Exception:
        damaged = damaged_files(spark, [r.path for r in classified])
        if not damaged:
            raise
    failed += damaged
    return *_insert(spark, names, _without(classified, damaged), load_id, again=True), failed


def recover(spark: SparkSession, names: TableNames, tail: DataFrame | None = None) -> tuple[int, int, list[tuple[str, str]]]:
    """Complete loads that recorded ``pending`` rows only.

    Returns how many were completed, how many were given up because nothing of them had been
    written, and the files that stand in the way of the others."""
    tail = ledger_tail(spark, names) if tail is None else tail
    begun = tail.where(F.col("status") == "pending")
    done, abandoned, failed = 0, 0, []
    for load_id in sorted(r.load_id for r in open_loads(tail).collect()):
        files = begun.where(F.col("load_id") == load_id)
        at = files.agg(F.max("loaded_at")).first()[0]
        listing = files.select(F.col("file_name").alias("path")).distinct().checkpoint(eager=True)
        classified = classify_files(listing).collect()
        bad = [(r.path, r.error) for r in classified if r.error] or unparseable_files(spark, classified)
        written = wrong = None
        if not bad:
            try:
                written, _, wrong = _insert(spark, names, classified, load_id, again=True)
            except Exception:
                bad = damaged_files(spark, [r.path for r in classified])
                if not bad:
                    raise
        if bad and partitions(spark, names).where(F.col("load_id") == load_id).isEmpty():
            record(spark, names, spark.createDataFrame(bad, "path string, error string").select("path"), load_id, "failed", at)
            abandoned += 1
        elif bad:  # what the load has written stays, and so does the load
            failed += bad
        elif not wrong:
            record(spark, names, listing if written is None else written, load_id, "loaded", at)
            done += 1
    return done, abandoned, failed


def load_batch(
    spark: SparkSession,
    pattern: str,
    table: str,
    *,
    limit: int | None = None,
    limit_after_filter: bool = False,
    create: bool = False,
    ledger_name: str = DEFAULT_LEDGER,
    run_ts: _dt.datetime | None = None,
    max_files_per_load: int | None = None,
) -> DataFrame:
    """Load files matching ``pattern`` that the ledger does not list yet; return metrics.

    ``limit`` keeps the first N listed files *before* the ledger filter, as the
    reference does (so repeated runs with the same N make no progress);
    ``limit_after_filter=True`` applies it to the pending files instead.
    """
    ensure_utc(spark)
    shared_root(spark)  # lineage cuts below go to the shared checkpoint folder
    names = ensure_tables(spark, table, ledger_name=ledger_name) if create else resolve_names(spark, table, ledger_name)
    require_ledger(spark, names)
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc)
    tail = ledger_tail(spark, names).checkpoint(eager=True)
    settled = settle(spark, names, tail)
    recovered, abandoned, failed = recover(spark, names, tail)
    if settled or recovered or abandoned:
        tail = ledger_tail(spark, names).checkpoint(eager=True)

    # The listing is used several times below (counts, preview, anti join): cut it
    # once into the shared checkpoint folder instead of re-scanning file metadata.
    listed = list_files(spark, pattern).checkpoint(eager=True)
    found = listed.count()
    considered = listed if limit_after_filter else limit_files(listed, limit)
    # One name a file day: only these folders of the ledger's snapshot are read.
    days = [r[0] for r in considered.select(file_day(F.col("path"))).distinct().collect()]
    led = ledger_snapshot(spark, names, days).unionByName(tail)
    held = tail.where(F.col("status") == "pending").join(open_loads(tail), "load_id", "left_semi").select(F.col("file_name").alias("path"))
    pending = pending_files(considered, led).join(held, "path", "left_anti")
    n_considered = considered.count() if limit and not limit_after_filter else found
    n_unloaded = None
    if limit_after_filter and limit:
        n_unloaded = pending.count()  # before any ledger write of this run
        pending = limit_files(pending, limit)
    preview_paths = preview(considered)

    # Footer classification runs once (a Python task per partition); the result is
    # cut from its lineage so that later steps do not re-read footers.
    classified = classify_files(pending.select("path").checkpoint(eager=True)).checkpoint(eager=True)
    n_pending = classified.count()
    chunks = max(1, math.ceil(n_pending / max(1, max_files_per_load))) if max_files_per_load else 1
    classified = classified.withColumn("chunk", F.pmod(F.xxhash64("path"), F.lit(chunks)))
    failed += [(r.path, r.error) for r in classified.where(F.col("error").isNotNull()).collect()]

    rows_total = loaded_files = loads = unreconciled = 0
    stamp = run_ts.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    for c in range(chunks if n_pending else 0):
        good = classified.where((F.col("chunk") == c) & F.col("error").isNull())
        # One entry a file: a scan of chosen files is planned from their paths.
        chunk_rows = good.select("path", "signature", "rows", "bytes", "error").collect()
        if not chunk_rows:
            continue
        load_id = f"{stamp}-{c:05d}"
        record(spark, names, good.select("path"), load_id, "pending", run_ts)
        files, rows, wrong, left_out = _write_rows(spark, names, chunk_rows, load_id)
        failed += left_out
        loads += 1
        if wrong:  # stays pending: the next run writes and compares it again
            unreconciled += 1
            continue
        if left_out:
            record(spark, names, spark.createDataFrame(left_out, "path string, error string").select("path"), load_id, "failed", run_ts)
        if files is not None:
            record(spark, names, files, load_id, "loaded", run_ts)
        rows_total += rows
        loaded_files += len(chunk_rows) - len(left_out)

    if tail.where(F.col("status") == "loaded").select("load_id").distinct().count() + loads > TAIL_LOADS:
        compact_ledger(spark, table, ledger_name)
    skipped = n_considered - (n_pending if n_unloaded is None else n_unloaded)
    metrics = [(found, skipped, loaded_files, len(failed), rows_total, loads, recovered, abandoned, unreconciled, preview_paths, sorted(p for p, _ in failed))]
    return spark.createDataFrame(metrics, METRICS_SCHEMA)
