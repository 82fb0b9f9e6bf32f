"""Loader protocol: incremental, idempotent, crash-safe; mixed Parquet layouts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tradelake import scratch_dir
from tradelake.plans import ensure_tables, fact_view, ledger_view, load_batch
from tradelake.plans.tables import LedgerMissing, resolve_names
from tradelake.sources.listing import NoMatchingFiles
from tradelake.sources.trade_files import read_trades

UTC = dt.timezone.utc


def _write_pyarrow_files(folder, kinds):
    import pyarrow as pa
    import pyarrow.parquet as pq

    base = dt.datetime(2026, 4, 4, 12, 0, 0, 123000, tzinfo=UTC)
    micros = int(base.timestamp()) * 1_000_000 + 123000
    paths = []
    for i, kind in enumerate(kinds):
        if kind == "ns":
            col = pa.array([micros * 1000], pa.timestamp("ns", tz="UTC"))
        elif kind == "us":
            col = pa.array([micros], pa.timestamp("us", tz="UTC"))
        elif kind == "us_local":
            col = pa.array([micros], pa.timestamp("us"))
        elif kind == "ms_int":
            col = pa.array([micros // 1000], pa.int64())
        elif kind == "text":
            col = pa.array(["2026-04-04T12:00:00.123Z"])
        else:
            raise ValueError(kind)
        t = pa.table({"symbol": ["BTCUSDT"], "price": [42000.5 + i], "quantity": [0.01], "timestamp": col})
        day = os.path.join(folder, "btc_trades", "year=2026", "month=4", "day=4")
        os.makedirs(day, exist_ok=True)
        path = os.path.join(day, f"btc_trades_{i + 1}.parquet")
        pq.write_table(t, path)
        paths.append(path)
    return paths, base


def test_mixed_timestamp_layouts_read_to_same_instant(spark, tmp_dir):
    kinds = ["ns", "us", "us_local", "ms_int", "text"]
    paths, base = _write_pyarrow_files(tmp_dir, kinds)
    read = read_trades(spark, paths)
    assert not read.failed
    got = {r.price: r.timestamp.replace(tzinfo=UTC) for r in read.trades.collect()}
    assert len(got) == len(kinds)
    assert set(got.values()) == {base}


def _day_file(folder, day, rows, name="part-0"):
    """One file of ``rows`` trades of a day, price counting up."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    start = int(dt.datetime(2025, 11, day, tzinfo=UTC).timestamp() * 1_000_000)
    path = os.path.join(folder, "trades", f"day={day}", f"{name}.parquet")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    stamps = pa.array([start + i * 1_000_000 for i in range(rows)], pa.timestamp("us", tz="UTC"))
    pq.write_table(pa.table({"symbol": ["ETHUSDT"] * rows, "price": [float(i + 1) for i in range(rows)], "quantity": [0.5] * rows, "timestamp": stamps}), path)
    return path


def _damage(path):
    data = bytearray(open(path, "rb").read())
    data[4:120] = b"\xff" * 116
    open(path, "wb").write(bytes(data))


def _table(spark, name):
    return ensure_tables(spark, f"{name}.trades", location=scratch_dir(spark, "wh")), f"{name}.trades"


def _rows_by_day(spark, table):
    return {r.d: r.n for r in fact_view(spark, table).groupBy(F.dayofmonth("timestamp").alias("d")).agg(F.count("*").alias("n")).collect()}


def test_each_run_adds_the_days_that_came_since(spark, tmp_dir):
    _, table = _table(spark, "t_days")
    pattern = tmp_dir + "/trades/*/*.parquet"
    sizes = {3: 7, 4: 1, 9: 12}
    for day, n in sizes.items():
        _day_file(tmp_dir, day, n)
        m = load_batch(spark, pattern, table).first()
        assert (m.files_loaded, m.rows_loaded, m.files_skipped) == (1, n, len(_rows_by_day(spark, table)) - 1)
    _day_file(tmp_dir, 9, 5, "part-1")
    assert load_batch(spark, pattern, table).first().rows_loaded == 5
    assert load_batch(spark, pattern, table).first().files_loaded == 0
    assert _rows_by_day(spark, table) == {3: 7, 4: 1, 9: 17}
    assert ledger_view(spark, table).select("file_name").distinct().count() == 4


def test_damaged_pages_stop_no_other_file(spark, tmp_dir):
    _, table = _table(spark, "t_damaged")
    pattern = tmp_dir + "/trades/*/*.parquet"
    _day_file(tmp_dir, 1, 10)
    bad = _day_file(tmp_dir, 2, 10)
    _damage(bad)
    m = load_batch(spark, pattern, table).first()
    assert (m.files_loaded, m.files_failed, m.rows_loaded) == (1, 1, 10) and m.failed[0].endswith("day=2/part-0.parquet")
    _day_file(tmp_dir, 3, 4)
    m = load_batch(spark, pattern, table).first()
    assert (m.files_loaded, m.files_failed, m.rows_loaded) == (1, 1, 4)
    _day_file(tmp_dir, 2, 10)  # mended
    assert load_batch(spark, pattern, table).first().files_loaded == 1
    assert _rows_by_day(spark, table) == {1: 10, 2: 10, 3: 4}


def test_only_damaged_files(spark, tmp_dir):
    _, table = _table(spark, "t_only_damaged")
    _damage(_day_file(tmp_dir, 1, 10))
    for _ in range(2):
        m = load_batch(spark, tmp_dir + "/trades/*/*.parquet", table).first()
        assert (m.files_loaded, m.files_failed, m.recovered_loads) == (0, 1, 0)
    assert fact_view(spark, table).count() == 0


def _forget_loaded(spark, names):
    led = spark.table(names.ledger_table)
    begun = led.where(F.col("status") == "pending").collect()
    spark.sql(f"TRUNCATE TABLE {names.ledger_table}")
    spark.createDataFrame(begun, led.schema).write.insertInto(names.ledger_table)


@pytest.mark.parametrize("how", ["damaged", "missing"])
def test_recovery_never_loses_rows(spark, tmp_dir, how):
    names, table = _table(spark, f"t_recover_{how}")
    pattern = tmp_dir + "/trades/*/*.parquet"
    _day_file(tmp_dir, 1, 10)
    other = _day_file(tmp_dir, 2, 10)
    load_batch(spark, pattern, table).collect()
    _forget_loaded(spark, names)
    if how == "damaged":
        _damage(other)
    else:
        os.remove(other)
    _day_file(tmp_dir, 3, 5)
    m = load_batch(spark, pattern, table).first()
    assert (m.recovered_loads, m.files_failed, m.files_loaded) == (0, 1, 1)
    assert _rows_by_day(spark, table) == {1: 10, 2: 10, 3: 5}
    _day_file(tmp_dir, 2, 10)
    m = load_batch(spark, pattern, table).first()
    assert (m.recovered_loads, m.files_failed) == (1, 0)
    assert _rows_by_day(spark, table) == {1: 10, 2: 10, 3: 5} and ledger_view(spark, table).count() == 3


def test_text_timestamps_that_do_not_parse_fail_their_file(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    _, table = _table(spark, "t_text")
    _day_file(tmp_dir, 1, 2)
    for name, texts in (("good", ["2025-11-01T00:00:00Z", None]), ("bad", ["2025-11-01T00:00:00Z", "notatime"])):
        path = os.path.join(tmp_dir, "trades", "day=1", name + ".parquet")
        pq.write_table(pa.table({"symbol": ["A", "A"], "price": [1.0, 2.0], "quantity": [1.0, 1.0], "timestamp": texts}), path)
    m = load_batch(spark, tmp_dir + "/trades/*/*.parquet", table).first()
    assert (m.files_loaded, m.files_failed, m.rows_loaded) == (2, 1, 4) and m.failed[0].endswith("bad.parquet")


def test_several_loads_a_run(spark, tmp_dir):
    """Splitting a run makes several commits; the rows are the same."""
    _, table = _table(spark, "t_split")
    for day in range(1, 9):
        _day_file(tmp_dir, day, day)
    m = load_batch(spark, tmp_dir + "/trades/*/*.parquet", table, max_files_per_load=2).first()
    assert m.loads > 1 and m.files_loaded == 8
    assert _rows_by_day(spark, table) == {d: d for d in range(1, 9)}


def test_nanos_need_their_setting(spark, tmp_dir):
    paths, _ = _write_pyarrow_files(tmp_dir, ["ns"])
    key = "spark.sql.legacy.parquet.nanosAsLong"
    spark.conf.set(key, "false")
    try:
        with pytest.raises(RuntimeError, match="nanosAsLong"):
            read_trades(spark, paths)
    finally:
        spark.conf.set(key, "true")


def test_compaction_survives_a_crash_at_any_step(spark, tmp_dir, monkeypatch):
    from tradelake.plans import compact, compact_days

    pattern = tmp_dir + "/trades/*/*.parquet"
    for step in ("_OPEN", "insert", "_DONE", "none"):
        names, table = _table(spark, f"t_compact_{step.strip('_').lower()}")
        for k in range(2):
            for day in (1, 2):
                _day_file(tmp_dir, day, 3 + k, f"f{step}-{k}")
            load_batch(spark, pattern, table).collect()
        before = _rows_by_day(spark, table)
        record = compact._record

        def crash(spark, names, partitions, load_id, status, step=step, record=record):
            if (step, status) in (("insert", "compacted"), ("_OPEN", "compacting")):
                raise KeyboardInterrupt
            record(spark, names, partitions, load_id, status)
            if (step, status) == ("_DONE", "compacted"):
                raise KeyboardInterrupt

        if step != "none":
            monkeypatch.setattr(compact, "_record", crash)
            with pytest.raises(KeyboardInterrupt):
                compact_days(spark, table)
            monkeypatch.setattr(compact, "_record", record)
        assert _rows_by_day(spark, table) == before
        compact_days(spark, table)
        assert _rows_by_day(spark, table) == before
        ids = spark.table(names.fact).groupBy("trade_date").agg(F.countDistinct("load_id").alias("n"))
        assert {r.n for r in ids.collect()} == {1}
        assert load_batch(spark, pattern, table).first().files_loaded == 0


def test_load_is_exactly_once_after_crash(spark, tmp_dir):
    """A load that wrote its rows but died before recording them is completed, not duplicated."""
    paths, _ = _write_pyarrow_files(tmp_dir, ["us", "ns", "ms_int"])
    table = "t_crash.btc_trades"
    names = ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    pattern = tmp_dir + "/btc_trades/*/*/*/*.parquet"
    load_batch(spark, pattern, table).collect()
    # Simulate the crash: drop the "loaded" rows of that load from the ledger.
    led = spark.table(names.ledger_table)
    pending_only = led.where(F.col("status") == "pending").collect()
    spark.sql(f"TRUNCATE TABLE {names.ledger_table}")
    spark.createDataFrame(pending_only, led.schema).write.insertInto(names.ledger_table)
    m = load_batch(spark, pattern, table).first()
    assert m.recovered_loads == 1 and m.files_loaded == 0
    assert fact_view(spark, table).count() == 3
    assert ledger_view(spark, table).count() == 3


def test_unreadable_file_is_reported_and_retried(spark, tmp_dir):
    paths, _ = _write_pyarrow_files(tmp_dir, ["us"])
    bad = os.path.join(os.path.dirname(paths[0]), "broken.parquet")
    with open(bad, "wb") as fh:
        fh.write(b"not parquet at all")
    table = "t_bad.btc_trades"
    ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    pattern = tmp_dir + "/btc_trades/year=*/month=*/day=*/*.parquet"
    m = load_batch(spark, pattern, table).first()
    assert (m.files_loaded, m.files_failed, m.rows_loaded) == (1, 1, 1)
    again = load_batch(spark, pattern, table).first()
    assert (again.files_skipped, again.files_failed) == (1, 1)


def test_missing_ledger_and_no_match(spark, tmp_dir):
    _write_pyarrow_files(tmp_dir, ["us"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_noledger LOCATION '{scratch_dir(spark, 'wh')}'")
    with pytest.raises(LedgerMissing):
        load_batch(spark, tmp_dir + "/btc_trades/*/*/*/*.parquet", "t_noledger.btc_trades")
    ensure_tables(spark, "t_nomatch.btc_trades", location=scratch_dir(spark, "wh"))
    with pytest.raises(NoMatchingFiles):
        load_batch(spark, tmp_dir + "/btc_trades/*/*/*/*.csv", "t_nomatch.btc_trades")


def test_limit_before_filter_makes_no_progress(spark, tmp_dir):
    _write_pyarrow_files(tmp_dir, ["us", "us", "us"])
    table = "t_limit.btc_trades"
    ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    pattern = tmp_dir + "/btc_trades/*/*/*/*.parquet"
    assert load_batch(spark, pattern, table, limit=1).first().files_loaded == 1
    assert load_batch(spark, pattern, table, limit=1).first().files_loaded == 0
    m = load_batch(spark, pattern, table, limit=1, limit_after_filter=True).first()
    assert (m.files_found, m.files_skipped, m.files_loaded) == (3, 1, 1)


def test_trades_between_prunes_partitions(spark, tmp_dir):
    from tradelake.plans import trades_between

    _write_pyarrow_files(tmp_dir, ["us", "ns"])
    table = "t_between.btc_trades"
    ensure_tables(spark, table, location=scratch_dir(spark, "wh"))
    load_batch(spark, tmp_dir + "/btc_trades/*/*/*/*.parquet", table).collect()
    q = trades_between(spark, table, "2026-04-04 00:00:00", "2026-04-05 00:00:00")
    assert q.count() == 2
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan
    assert trades_between(spark, table, "2026-04-05 00:00:00", "2026-04-06 00:00:00").count() == 0


def test_resolve_names_current_catalog(spark):
    n = resolve_names(spark, "ds1.tbl1")
    assert (n.catalog, n.namespace, n.ledger) == ("spark_catalog", "ds1", "loaded_files")
