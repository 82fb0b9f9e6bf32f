"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Queries (each timed end to end, result fully materialised):
  clean_lineitem  lineitem as raw JSON trade messages -> decode -> validate/clean (600k rows at sf0.1)
  clean_events    the same on events
  minute_prices   events -> clean -> sorted per-minute price runs
  minute_ohlcv    events -> clean -> per-minute OHLCV
  write_lake      clean lineitem -> Parquet lake (year/month/day of processing time)
  load_batch      lake -> fact table (trade_date partitions) through the ledger
  load_again      the same load again: must find 0 new files
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from tradelake import get_session, scratch_dir  # noqa: E402
from tradelake.functions.json import decode_json  # noqa: E402
from tradelake.operators import from_exchange, minute_ohlcv, minute_prices, split_trades  # noqa: E402
from tradelake.plans import ensure_tables, load_batch, write_trades  # noqa: E402
from tradelake.sources.messages import events_as_messages, lineitem_as_messages, spread  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        f"local[{cpus}]",
        "tradelake-bench",
        {"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)), "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def clean_of(messages):
        return split_trades(from_exchange(decode_json(messages))).clean

    # Warm-up: JVM, Python workers and codegen caches (not timed).
    clean_of(events_as_messages(spark, sf_dir)).limit(10).collect()

    # The test tables are single-row-group files (one scan task); spread the
    # messages over the cores before parsing, as a many-partition topic would be.
    width = int(cpus) * 2
    li_clean = clean_of(spread(lineitem_as_messages(spark, sf_dir), width))
    ev_clean = clean_of(spread(events_as_messages(spark, sf_dir), width))
    timed("clean_lineitem", lambda: li_clean.write.format("noop").mode("overwrite").save())
    timed("clean_events", lambda: ev_clean.write.format("noop").mode("overwrite").save())
    timed("minute_prices", lambda: minute_prices(ev_clean).write.format("noop").mode("overwrite").save())
    timed("minute_ohlcv", lambda: minute_ohlcv(ev_clean).write.format("noop").mode("overwrite").save())

    lake = scratch_dir(spark, "bench-lake") + "/btc_trades"
    timed("write_lake", lambda: write_trades(li_clean, lake))  # processing-time layout, as the consumer writes
    db = "bench_" + scratch_dir(spark, "x").rsplit("-", 1)[1]
    ensure_tables(spark, f"{db}.btc_trades", location=scratch_dir(spark, "bench-wh"))
    first = timed("load_batch", lambda: load_batch(spark, lake + "/year=*/month=*/day=*/*.parquet", f"{db}.btc_trades").first())
    second = timed("load_again", lambda: load_batch(spark, lake + "/year=*/month=*/day=*/*.parquet", f"{db}.btc_trades").first())
    rows["lineitem_clean"] = li_clean.count()
    rows["files_loaded"] = first.files_loaded
    rows["rows_loaded"] = first.rows_loaded
    rows["second_run_files"] = second.files_loaded

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "rows_per_sec": {
            "clean_lineitem": round(rows["lineitem_clean"] / times["clean_lineitem"]) if times["clean_lineitem"] else None,
            "load_batch": round(rows["rows_loaded"] / times["load_batch"]) if times["load_batch"] else None,
        },
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
