"""Registered queries over the driver's test tables, each with an equivalent DuckDB SQL.

Every query reads ``events`` or ``lineitem`` (shaped into trade messages, see
``sources.messages``) or files Spark writes from them, so its work grows with the
tables. Queries that write use a new folder under the session's shared root per
call. Output columns are aliased identically on both sides; integers are BIGINT,
summed doubles are rounded to DECIMAL.

Shapes of test data (one per ``event_id % k``) are used to give every row one of
several textual or physical forms; every row is processed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType

from .functions import json as J
from .functions.json import decode_json, encode_json
from .functions.numbers import text_to_double
from .functions.symbols import normalize_symbol
from .functions.timestamps import minute_bucket, parse_epoch_ms
from .operators.exchange import from_exchange, to_canonical_json
from .operators.files import limit_files, pending_files
from .operators.minutes import minute_ohlcv, minute_price_runs, minute_prices
from .operators.trades import FIELDS, is_valid_trade, reject_counts, split_trades, trade_outcomes
from .plans.compact import compact_days
from .plans.ledger import compact_ledger, is_loaded, ledger_rows, ledger_view, record
from .plans.loader import load_batch
from .plans.tables import ensure_tables, fact_view, resolve_names, rows_to_add, trades_between
from .plans.writer import LAKE_PARTITIONS, read_outcomes, with_lake_partitions, write_outcomes, write_trades
from .session import ensure_utc, scratch_dir
from .sources.listing import exists_any, list_files, preview
from .sources.messages import events_as_messages, lineitem_as_messages, read_table, spread
from .sources.trade_files import classify_files, read_trades
from .streaming.dedupe import dedupe_stream, deduped
from .streaming.ingest import for_each_batch, stream_outcomes, stream_trades
from .streaming.load import load_stream
from .streaming.minutes import (
    read_minute_ohlcv,
    read_minute_price_runs,
    roll_up_minute_ohlcv,
    roll_up_minute_price_runs,
    stream_minute_ohlcv,
    stream_minute_price_runs,
)

Query = Callable[[SparkSession, str], DataFrame]
TRADE_COLS = ("symbol", "price", "quantity", "timestamp")

# ---------------------------------------------------------------- helpers (Spark)


def _decoded_events(spark: SparkSession, sf: str) -> DataFrame:
    return from_exchange(decode_json(events_as_messages(spark, sf)))


def _clean_events(spark: SparkSession, sf: str, keep=("event_id",)) -> DataFrame:
    return split_trades(_decoded_events(spark, sf), keep=keep).clean


def _dec(c: Column, scale: int = 4) -> Column:
    return F.round(c, scale).cast(f"decimal(18,{scale})")


def _part(path: Column, key: str) -> Column:
    return F.regexp_extract(path, f"{key}=(\\d+)", 1).cast("bigint")


def _event_lake(spark: SparkSession, sf: str) -> str:
    """Lake of clean events partitioned by the trade's own day (a backfill layout)."""
    lake = scratch_dir(spark, "lake") + "/btc_trades"
    write_trades(_clean_events(spark, sf, keep=()), lake, as_of=F.col("timestamp"))
    return lake


def _one_file_a_day(trades: DataFrame, lake: str) -> str:
    """Append trades to a lake in which every day has exactly one file, whatever its size."""
    days = with_lake_partitions(trades, F.col("timestamp")).repartition(*LAKE_PARTITIONS)
    days.write.mode("append").partitionBy(*LAKE_PARTITIONS).parquet(lake)
    return lake


def _per_day(trades: DataFrame, *more: Column) -> DataFrame:
    t = F.col("timestamp")
    days = trades.groupBy(F.year(t).cast("bigint").alias("year"), F.month(t).cast("bigint").alias("month"), F.dayofmonth(t).cast("bigint").alias("day"))
    return days.agg(F.count(F.lit(1)).alias("n_rows"), _dec(F.sum("quantity")).alias("quantity")).select("*", *more)


def _number(value: int, name: str) -> Column:
    return F.lit(value).cast("bigint").alias(name)


def _write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(data)
    out.close()


def _damaged(spark: SparkSession, path: str) -> bytes:
    """A file's bytes with a sound footer and its first pages overwritten."""
    data = bytearray(spark.read.format("binaryFile").load(path).first().content)
    data[4:200] = b"\xff" * 196
    return bytes(data)


def _fresh_table(spark: SparkSession) -> str:
    db = "tl_" + scratch_dir(spark, "x").rsplit("-", 1)[1]
    ensure_tables(spark, f"{db}.btc_trades", location=scratch_dir(spark, "warehouse"))
    return f"{db}.btc_trades"


def _days(df: DataFrame, path_col: str = "file_name") -> DataFrame:
    p = F.col(path_col)
    return df.select(_part(p, "year").alias("year"), _part(p, "month").alias("month"), _part(p, "day").alias("day"))


# ---------------------------------------------------------------- helpers (SQL)

EV = """
WITH ev AS (
  SELECT event_id, upper(event_type) AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         date_trunc('millisecond', ts) AS "timestamp", ts
  FROM events
), clean AS (
  SELECT * FROM ev WHERE price > 0 AND quantity > 0
)"""

LI = """
WITH clean AS (
  SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS symbol, l_extendedprice AS price,
         l_quantity AS quantity, date_trunc('millisecond', l_shipdate) AS "timestamp"
  FROM lineitem WHERE l_extendedprice > 0 AND l_quantity > 0
)"""

MINUTE = "((epoch_ms(\"timestamp\") - ((epoch_ms(\"timestamp\") % 60000) + 60000) % 60000) // 60000)"
PER_DAY = """year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month, day("timestamp")::BIGINT AS day,
       count(*) AS n_rows, CAST(round(sum(quantity), 4) AS DECIMAL(18,4)) AS quantity"""
DAY_TEXT = "concat('year=', year(\"timestamp\"), '/month=', month(\"timestamp\"), '/day=', day(\"timestamp\"), '/')"

# ---------------------------------------------------------------- step 1: expressions


def q_normalize_symbol(spark, sf):
    d = _decoded_events(spark, sf)
    return d.select("event_id", normalize_symbol(F.col("symbol"), VariantType()).alias("symbol"))


SQL_NORMALIZE_SYMBOL = "SELECT event_id, upper(event_type) AS symbol FROM events"


def q_parse_ts_numeric(spark, sf):
    ev = read_table(spark, sf, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    secs = F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / F.lit(1e6)
    as_json = ev.select(
        "event_id",
        F.try_parse_json(
            F.to_json(F.struct(ms.alias("ms"), (ms / 1000).cast("bigint").alias("s"), secs.alias("sf")))
        ).alias("m"),
    )
    return as_json.select(
        "event_id",
        parse_epoch_ms(J.field("m", "ms"), VariantType()).alias("ms_from_ms"),
        parse_epoch_ms(J.field("m", "s"), VariantType()).alias("ms_from_s"),
        parse_epoch_ms(J.field("m", "sf"), VariantType()).alias("ms_from_sf"),
    )


SQL_PARSE_TS_NUMERIC = """
SELECT event_id,
       epoch_ms(date_trunc('millisecond', ts)) AS ms_from_ms,
       (epoch_ms(date_trunc('millisecond', ts)) // 1000) * 1000 AS ms_from_s,
       CAST(trunc(CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) * CAST(1000 AS DOUBLE)) AS BIGINT) AS ms_from_sf
FROM events"""


def q_parse_ts_iso(spark, sf):
    ev = read_table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    shape = (F.col("event_id") % 6).cast("bigint")
    text = (
        F.when(shape == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(shape == 1, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("Z")))
        .when(shape == 2, F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(shape == 3, F.concat(F.date_format(ts + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+05:30")))
        .when(shape == 4, F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.date_format(ts, "yyyy/MM/dd"))
    )
    return ev.select("event_id", shape.alias("shape"), parse_epoch_ms(text, StringType()).alias("ts_ms"))


SQL_PARSE_TS_ISO = """
SELECT event_id, event_id % 6 AS shape,
       CASE event_id % 6
         WHEN 2 THEN epoch_ms(date_trunc('second', ts))
         WHEN 4 THEN epoch_ms(date_trunc('day', ts))
         WHEN 5 THEN NULL
         ELSE epoch_ms(date_trunc('millisecond', ts)) END AS ts_ms
FROM events"""


def q_parse_ts_week(spark, sf):
    """ISO week dates: with and without separators, day and time, and weeks that their year does not have."""
    ev = read_table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    shape = (F.col("event_id") % 6).cast("bigint")
    # A day's ISO year is the year of its week's Thursday.
    year = F.year(F.date_add(F.to_date(ts), 3 - F.weekday(ts))).cast("string")
    week, day = F.lpad(F.weekofyear(ts).cast("string"), 2, "0"), (F.weekday(ts) + 1).cast("string")
    text = (
        F.when(shape == 0, F.concat(year, F.lit("-W"), week, F.lit("-"), day))
        .when(shape == 1, F.concat(year, F.lit("W"), week, day))
        .when(shape == 2, F.concat(year, F.lit("-W"), week))
        .when(shape == 3, F.concat(year, F.lit("-W"), week, F.lit("-"), day, F.date_format(ts, "'T'HH:mm:ss.SSS"), F.lit("Z")))
        .when(shape == 4, F.concat(year, F.lit("W"), week, day, F.date_format(ts, "' 'HHmmss")))
        .otherwise(F.concat(year, F.when(F.col("event_id") % 2 == 1, F.lit("-W53-1")).otherwise(F.lit("-W00-1"))))
    )
    return ev.select("event_id", shape.alias("shape"), parse_epoch_ms(text, StringType()).alias("ts_ms"))


SQL_PARSE_TS_WEEK = """
SELECT event_id, event_id % 6 AS shape,
       CASE event_id % 6
         WHEN 2 THEN epoch_ms(date_trunc('week', ts))
         WHEN 3 THEN epoch_ms(date_trunc('millisecond', ts))
         WHEN 4 THEN epoch_ms(date_trunc('second', ts))
         WHEN 5 THEN CASE WHEN event_id % 2 = 1 AND strftime(make_date(isoyear(ts), 12, 28), '%V') = '53'
                          THEN epoch_ms(CAST(date_trunc('week', make_date(isoyear(ts), 12, 28)) AS TIMESTAMP)) END
         ELSE epoch_ms(date_trunc('day', ts)) END AS ts_ms
FROM events"""


def q_to_double(spark, sf):
    ev = read_table(spark, sf, "events")
    v = F.col("value").cast("string")
    shape = (F.col("event_id") % 6).cast("bigint")
    text = (
        F.when(shape == 0, v)
        .when(shape == 1, F.concat(F.lit(" "), v, F.lit("\t")))
        .when(shape == 2, F.concat(v, F.lit("d")))
        .when(shape == 3, F.format_string("%e", F.col("value")))
        .when(shape == 4, F.concat(F.floor("value").cast("string"), F.lit("_000")))
        .otherwise(F.lit("0x10"))
    )
    return ev.select("event_id", shape.alias("shape"), text_to_double(text).alias("price"))


SQL_TO_DOUBLE = """
SELECT event_id, event_id % 6 AS shape,
       CASE event_id % 6
         WHEN 0 THEN value WHEN 1 THEN value WHEN 3 THEN value
         WHEN 4 THEN CAST(floor(value) AS DOUBLE) * 1000
         ELSE NULL END AS price
FROM events"""


def q_minute_bucket(spark, sf):
    clean = _clean_events(spark, sf)
    ms = F.unix_millis("timestamp")
    return clean.select("event_id", ms.alias("ts_ms"), minute_bucket(ms).alias("minute"))


SQL_MINUTE_BUCKET = EV + f"""
SELECT event_id, epoch_ms("timestamp") AS ts_ms, {MINUTE} AS minute FROM clean"""

# ---------------------------------------------------------------- step 2: JSON, P1


def q_decode_json(spark, sf):
    d = decode_json(events_as_messages(spark, sf))
    m = F.col("msg")
    return d.select(
        "event_id",
        F.try_variant_get(J.field(m, "s"), "$", "string").alias("s"),
        F.try_variant_get(J.field(m, "p"), "$", "string").alias("p"),
        F.try_variant_get(J.field(m, "q"), "$", "string").alias("q"),
        F.try_variant_get(J.field(m, "T"), "$", "bigint").alias("t"),
    )


SQL_DECODE_JSON = """
SELECT event_id, event_type AS s, CAST(value AS VARCHAR) AS p, json_extract_string(props, '$.k') AS q,
       epoch_ms(date_trunc('millisecond', ts)) AS t
FROM events"""


def q_encode_json(spark, sf):
    clean = _clean_events(spark, sf)
    canon = clean.select(
        "event_id", "symbol", "price", "quantity", F.unix_millis("timestamp").alias("timestamp")
    )
    return to_canonical_json(canon, keep=("event_id",))


SQL_ENCODE_JSON = EV + """
SELECT event_id, json_object('symbol', symbol, 'price', price, 'quantity', quantity,
                             'timestamp', epoch_ms("timestamp"))::VARCHAR AS value
FROM clean"""


def q_from_exchange(spark, sf):
    d = _decoded_events(spark, sf)
    return d.select(
        "event_id",
        F.try_variant_get("symbol", "$", "string").alias("symbol"),
        "price",
        "quantity",
        F.try_variant_get("timestamp", "$", "bigint").alias("ts_ms"),
    )


SQL_FROM_EXCHANGE = """
SELECT event_id, event_type AS symbol, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
       epoch_ms(date_trunc('millisecond', ts)) AS ts_ms
FROM events"""

# ---------------------------------------------------------------- step 3: validate, clean


def q_validate_trades(spark, sf):
    return is_valid_trade(_decoded_events(spark, sf), keep=("event_id",))


SQL_VALIDATE_TRADES = EV + """
SELECT event_id, (price > 0 AND quantity > 0) AS is_valid FROM ev"""


def q_clean_trades(spark, sf):
    return _clean_events(spark, sf)


SQL_CLEAN_TRADES = EV + """
SELECT event_id, symbol, price, quantity, "timestamp" FROM clean"""


def q_clean_lineitem(spark, sf):
    wide = spread(lineitem_as_messages(spark, sf), 2 * spark.sparkContext.defaultParallelism)
    msgs = from_exchange(decode_json(wide))
    return split_trades(msgs, keep=("l_orderkey", "l_linenumber")).clean


SQL_CLEAN_LINEITEM = LI + """
SELECT l_orderkey, l_linenumber, symbol, price, quantity, "timestamp" FROM clean"""


def q_reject_counts(spark, sf):
    return reject_counts(split_trades(_decoded_events(spark, sf)).rejects)


SQL_REJECT_COUNTS = EV + """
SELECT reject_reason, count(*) AS n_rejects FROM (
  SELECT CASE WHEN NOT (price > 0) THEN 'invalid_price'
              WHEN NOT (quantity > 0) THEN 'invalid_quantity' END AS reject_reason
  FROM ev) WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""

# ---------------------------------------------------------------- step 4: minute buckets


def q_minute_price_runs(spark, sf):
    return minute_price_runs(_clean_events(spark, sf, keep=()))


SQL_MINUTE_PRICE_RUNS = EV + f"""
SELECT {MINUTE} AS minute, symbol, price, count(*) AS n FROM clean GROUP BY ALL"""


def q_minute_prices(spark, sf):
    """Every run of the sorted lists, with the price before it in its list."""
    mp = minute_prices(_clean_events(spark, sf, keep=()), chunks=1)
    runs = mp.select("minute", "symbol", "n_trades", "n_prices", "prices", F.posexplode("prices").alias("pos", "run"))
    before = F.when(F.col("pos") > 0, F.get("prices", F.col("pos") - 1)["price"])
    return runs.select(
        "minute", "symbol", "n_trades", "n_prices", F.col("run.price").alias("price"), F.col("run.n").alias("n"), before.alias("price_before")
    )


SQL_MINUTE_PRICES = EV + f"""
, runs AS (SELECT {MINUTE} AS minute, symbol, price, count(*) AS n FROM clean GROUP BY ALL)
SELECT minute, symbol, CAST(sum(n) OVER m AS BIGINT) AS n_trades, count(*) OVER m AS n_prices, price, n,
       lag(price) OVER (PARTITION BY minute, symbol ORDER BY price) AS price_before
FROM runs WINDOW m AS (PARTITION BY minute, symbol)"""


def q_minute_price_chunks(spark, sf):
    """The lists as they are dealt by default, put together again."""
    mp = minute_prices(_clean_events(spark, sf, keep=()))
    return mp.select("minute", "symbol", F.explode("prices").alias("run")).select("minute", "symbol", "run.price", "run.n")


def q_minute_ohlcv(spark, sf):
    o = minute_ohlcv(_clean_events(spark, sf, keep=()))
    return o.select(
        "minute", "symbol", "window_start", "n_trades", "open", "high", "low", "close",
        _dec(F.col("volume")).alias("volume"), _dec(F.col("vwap"), 6).alias("vwap"),
    )


SQL_MINUTE_OHLCV = EV + f"""
SELECT {MINUTE} AS minute, symbol,
       make_timestamp({MINUTE} * 60000 * 1000) AS window_start,
       count(*) AS n_trades,
       first(price ORDER BY "timestamp", price, quantity) AS open,
       max(price) AS high, min(price) AS low,
       first(price ORDER BY "timestamp" DESC, price DESC, quantity DESC) AS close,
       CAST(round(sum(quantity), 4) AS DECIMAL(18,4)) AS volume,
       CAST(round(sum(price * quantity) / sum(quantity), 6) AS DECIMAL(18,6)) AS vwap
FROM clean GROUP BY ALL"""

# ---------------------------------------------------------------- step 5: sinks


def q_write_partitioned(spark, sf):
    back = spark.read.parquet(_event_lake(spark, sf))
    return back.select(*TRADE_COLS, *[F.col(c).cast("bigint").alias(c) for c in LAKE_PARTITIONS])


SQL_WRITE_PARTITIONED = EV + """
SELECT symbol, price, quantity, "timestamp",
       year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month, day("timestamp")::BIGINT AS day FROM clean"""


def q_write_processing_time(spark, sf):
    """Folders of one instant for all rows."""
    lake = scratch_dir(spark, "lake") + "/btc_trades"
    write_trades(_clean_events(spark, sf, keep=()), lake, as_of="2026-04-04 12:00:00")
    return spark.read.parquet(lake).select(*TRADE_COLS, *[F.col(c).cast("bigint").alias(c) for c in LAKE_PARTITIONS])


SQL_WRITE_PROCESSING_TIME = EV + """
SELECT symbol, price, quantity, "timestamp", CAST(2026 AS BIGINT) AS year, CAST(4 AS BIGINT) AS month, CAST(4 AS BIGINT) AS day
FROM clean"""


def q_batch_files(spark, sf):
    """Files of a day with at most 100 rows each."""
    lake = scratch_dir(spark, "lake") + "/btc_trades"
    messages = events_as_messages(spark, sf).hint("rebalance")  # decoding takes longer than dealing the text out
    clean = split_trades(from_exchange(decode_json(messages))).clean
    write_trades(clean, lake, batch_size=100, as_of=F.col("timestamp"))
    per_file = spark.read.parquet(lake).groupBy(*LAKE_PARTITIONS, F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(*[F.col(c).cast("bigint").alias(c) for c in LAKE_PARTITIONS]).agg(
        F.sum("rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.max("rows").alias("most_rows")
    )


SQL_BATCH_FILES = EV + """
SELECT year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month, day("timestamp")::BIGINT AS day,
       count(*) AS n_rows, CAST(ceil(count(*) / 100.0) AS BIGINT) AS n_files, least(count(*), 100) AS most_rows
FROM clean GROUP BY ALL"""

# ---------------------------------------------------------------- step 6: listing


def q_list_files(spark, sf):
    lake = _event_lake(spark, sf)
    files = list_files(spark, lake + "/year=*/month=*/day=*/*.parquet")
    rows = read_trades(spark, files, with_file=True).trades
    return _days(rows).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


SQL_LIST_FILES = EV + """
SELECT year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month, day("timestamp")::BIGINT AS day,
       count(*) AS n_rows
FROM clean GROUP BY ALL"""


def q_limit_files(spark, sf):
    lake = _one_file_a_day(_clean_events(spark, sf, keep=()), scratch_dir(spark, "lake") + "/btc_trades")
    files = limit_files(list_files(spark, lake + "/year=*/month=*/day=*/*.parquet"), 5)
    rows = read_trades(spark, files, with_file=True).trades
    return _days(rows).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


SQL_LIMIT_FILES = EV + f"""
, days AS (SELECT {DAY_TEXT} AS k, year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month,
                  day("timestamp")::BIGINT AS day, count(*) AS n_rows FROM clean GROUP BY ALL)
SELECT year, month, day, n_rows FROM days ORDER BY k LIMIT 5"""


def q_single_file(spark, sf):
    """One explicit path instead of a pattern: the first day's file."""
    lake = _one_file_a_day(_clean_events(spark, sf, keep=()), scratch_dir(spark, "lake") + "/btc_trades")
    path = preview(list_files(spark, lake + "/*.parquet"), 1)[0]
    return read_trades(spark, list_files(spark, path)).trades


SQL_SINGLE_FILE = EV + f"""
SELECT symbol, price, quantity, "timestamp" FROM clean WHERE {DAY_TEXT} = (SELECT min({DAY_TEXT}) FROM clean)"""


def q_exists_preview(spark, sf):
    lake = _one_file_a_day(_clean_events(spark, sf, keep=()), scratch_dir(spark, "lake") + "/btc_trades")
    files = list_files(spark, lake + "/year=*/month=*/day=*/*.parquet")
    shown = files.where(F.col("path").isin(preview(files)))
    there, missing = exists_any(spark, lake), exists_any(spark, lake + "/nothing-here")
    return _days(shown, "path").select("*", F.lit(there).alias("there"), F.lit(missing).alias("missing"))


SQL_EXISTS_PREVIEW = EV + f"""
, days AS (SELECT DISTINCT {DAY_TEXT} AS k, year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month,
                  day("timestamp")::BIGINT AS day FROM clean)
SELECT year, month, day, true AS there, false AS missing FROM days ORDER BY k LIMIT 5"""


def q_pending_files(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + "/year=*/month=*/day=1*/*.parquet", table).collect()
    listing = list_files(spark, lake + "/year=*/month=*/day=*/*.parquet")
    pending = pending_files(listing, ledger_rows(spark, resolve_names(spark, table)))
    rows = read_trades(spark, pending, with_file=True).trades
    return _days(rows).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


SQL_PENDING_FILES = EV + """
SELECT year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month, day("timestamp")::BIGINT AS day,
       count(*) AS n_rows
FROM clean WHERE CAST(day("timestamp") AS VARCHAR) NOT LIKE '1%' GROUP BY ALL"""

# ---------------------------------------------------------------- step 7: reader


def _pandas_style_writer(folder: str):
    """Executor-side writer of INT64 NANOS (UTC) files, as pandas' to_parquet makes them."""

    def write(batches):
        import re as _re

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark import TaskContext

        if _re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", folder) and not folder.startswith("file:"):
            system, base = fs.FileSystem.from_uri(folder)
        else:
            system, base = fs.LocalFileSystem(), _re.sub(r"^file:(//)?", "", folder)
        system.create_dir(base, recursive=True)
        for k, batch in enumerate(batches):
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            ts = pc.cast(table.column("timestamp"), pa.timestamp("ns", tz="UTC"))
            table = table.set_column(table.schema.get_field_index("timestamp"), "timestamp", ts)
            # named by task and batch: a task that runs again writes the same files again
            name = f"{base}/nanos-{TaskContext.get().partitionId():05d}-{k:05d}.parquet"
            pq.write_table(table, name, filesystem=system)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([batch.num_rows], pa.int64())], names=["file", "rows"])

    return write


def q_read_mixed_timestamps(spark, sf):
    root = scratch_dir(spark, "mixed")
    clean = _clean_events(spark, sf, keep=("event_id",))
    shape = F.col("event_id") % 4
    clean.where(shape == 0).select(*TRADE_COLS).write.parquet(root + "/micros_utc")
    clean.where(shape == 1).select(
        "symbol", "price", "quantity", F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    ).write.parquet(root + "/micros_local")
    clean.where(shape == 2).select(
        "symbol", "price", "quantity", F.unix_millis("timestamp").alias("timestamp")
    ).write.parquet(root + "/int64_ms")
    clean.where(shape == 3).select(*TRADE_COLS).mapInArrow(
        _pandas_style_writer(root + "/nanos"), "file string, rows bigint"
    ).collect()
    files = list_files(spark, root + "/*/*.parquet")
    return read_trades(spark, files).trades


SQL_READ_MIXED_TIMESTAMPS = EV + """
SELECT symbol, price, quantity, "timestamp" FROM clean"""


def q_read_projected(spark, sf):
    lake = _event_lake(spark, sf)
    return read_trades(spark, list_files(spark, lake + "/*")).trades


SQL_READ_PROJECTED = SQL_READ_MIXED_TIMESTAMPS

# ---------------------------------------------------------------- step 8: tables and loads


def q_load_batch(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + "/year=*/month=*/day=*/*.parquet", table).collect()
    return fact_view(spark, table)


SQL_LOAD_BATCH = SQL_READ_MIXED_TIMESTAMPS


def q_load_twice(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    pattern = lake + "/year=*/month=*/day=*/*.parquet"
    load_batch(spark, pattern, table).collect()
    second = load_batch(spark, pattern, table).first()
    facts = fact_view(spark, table)
    return facts.agg(F.count(F.lit(1)).alias("rows_in_table")).select(
        "rows_in_table",
        F.lit(second.files_loaded).cast("bigint").alias("files_loaded_second_run"),
        F.lit(second.rows_loaded).cast("bigint").alias("rows_loaded_second_run"),
    )


SQL_LOAD_TWICE = EV + """
SELECT count(*) AS rows_in_table, CAST(0 AS BIGINT) AS files_loaded_second_run,
       CAST(0 AS BIGINT) AS rows_loaded_second_run FROM clean"""


def q_ledger_rows(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + "/year=*/month=*/day=*/*.parquet", table).collect()
    return _days(ledger_view(spark, table)).distinct()


SQL_LEDGER_ROWS = EV + """
SELECT DISTINCT year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month,
       day("timestamp")::BIGINT AS day FROM clean"""


def q_load_metrics(spark, sf):
    lake = _one_file_a_day(_clean_events(spark, sf, keep=()), scratch_dir(spark, "lake") + "/btc_trades")
    table = _fresh_table(spark)
    first = load_batch(spark, lake + "/year=*/month=*/day=1*/*.parquet", table).first()
    second = load_batch(spark, lake + "/year=*/month=*/day=*/*.parquet", table).first()
    rows = [(1, first.files_found, first.files_skipped, first.files_loaded, first.rows_loaded),
            (2, second.files_found, second.files_skipped, second.files_loaded, second.rows_loaded)]
    # A two-row report built from the loads' observed metrics.
    return spark.createDataFrame(rows, "run bigint, files_found bigint, files_skipped bigint, files_loaded bigint, rows_loaded bigint")


SQL_LOAD_METRICS = EV + """
, days AS (SELECT day("timestamp") AS d, count(*) AS n FROM clean GROUP BY ALL)
SELECT CAST(1 AS BIGINT) AS run, count(*) FILTER (WHERE CAST(d AS VARCHAR) LIKE '1%') AS files_found,
       CAST(0 AS BIGINT) AS files_skipped, count(*) FILTER (WHERE CAST(d AS VARCHAR) LIKE '1%') AS files_loaded,
       CAST(sum(n) FILTER (WHERE CAST(d AS VARCHAR) LIKE '1%') AS BIGINT) AS rows_loaded FROM days
UNION ALL
SELECT CAST(2 AS BIGINT), count(*), count(*) FILTER (WHERE CAST(d AS VARCHAR) LIKE '1%'),
       count(*) FILTER (WHERE CAST(d AS VARCHAR) NOT LIKE '1%'),
       CAST(sum(n) FILTER (WHERE CAST(d AS VARCHAR) NOT LIKE '1%') AS BIGINT) FROM days"""


def q_trades_between(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + "/year=*/month=*/day=*/*.parquet", table).collect()
    return trades_between(spark, table, "2024-01-05 06:00:00", "2024-01-12 18:00:00")


SQL_TRADES_BETWEEN = EV + """
SELECT symbol, price, quantity, "timestamp" FROM clean
WHERE "timestamp" >= TIMESTAMP '2024-01-05 06:00:00' AND "timestamp" < TIMESTAMP '2024-01-12 18:00:00'"""



ALL_DAYS, SOME_DAYS = "/year=*/month=*/day=*/*.parquet", "/year=*/month=*/day=1*/*.parquet"
SQL_PER_DAY = EV + f"""
SELECT {PER_DAY} FROM clean GROUP BY ALL"""


def q_create_tables(spark, sf):
    """A table made anew forgets its rows and its files: the next load reads all of them."""
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + SOME_DAYS, table).collect()
    ensure_tables(spark, table, recreate=True)
    empty = fact_view(spark, table).count() + ledger_view(spark, table).count()
    load_batch(spark, lake + ALL_DAYS, table, create=True).collect()
    return _per_day(fact_view(spark, table), _number(empty, "left_after_recreate"))


SQL_CREATE_TABLES = EV + f"""
SELECT {PER_DAY}, CAST(0 AS BIGINT) AS left_after_recreate FROM clean GROUP BY ALL"""


def q_ledger_lookup(spark, sf):
    """The first and the last file, looked up one by one."""
    lake = _one_file_a_day(_clean_events(spark, sf, keep=()), scratch_dir(spark, "lake") + "/btc_trades")
    table = _fresh_table(spark)
    load_batch(spark, lake + SOME_DAYS, table).collect()
    files = list_files(spark, lake + ALL_DAYS)
    ends = files.agg(F.min("path").alias("low"), F.max("path").alias("high")).first()
    found = {p: is_loaded(spark, table, p) for p in ends}
    rows = files.where(F.col("path").isin(list(ends))).withColumn("loaded", F.col("path").isin([p for p in ends if found[p]]))
    return _days(rows, "path").join(rows.select(_part(F.col("path"), "day").alias("day"), "loaded"), "day").select("year", "month", "day", "loaded")


SQL_LEDGER_LOOKUP = EV + f"""
, days AS (SELECT DISTINCT {DAY_TEXT} AS k, year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month,
                  day("timestamp")::BIGINT AS day FROM clean)
SELECT year, month, day, CAST(day AS VARCHAR) LIKE '1%' AS loaded FROM days
WHERE k IN ((SELECT min(k) FROM days), (SELECT max(k) FROM days))"""


def q_load_with_bad_file(spark, sf):
    """A file with a sound footer and damaged pages is reported on every run and stops no other file."""
    clean = _clean_events(spark, sf, keep=())
    some = F.dayofmonth("timestamp").cast("string").startswith("1")
    lake = _one_file_a_day(clean.where(some), scratch_dir(spark, "lake") + "/btc_trades")
    table = _fresh_table(spark)
    path = preview(list_files(spark, lake + ALL_DAYS), 1)[0]
    bad = path.rsplit("/", 1)[0] + "/damaged.parquet"
    _write_bytes(spark, bad, _damaged(spark, path))
    first = load_batch(spark, lake + ALL_DAYS, table).first()
    _one_file_a_day(clean.where(~some), lake)
    second = load_batch(spark, lake + ALL_DAYS, table).first()
    named = sum(m.failed == [bad] for m in (first, second))
    recorded = ledger_view(spark, table).where(F.col("file_name") == bad).count()
    return _per_day(fact_view(spark, table), _number(named, "reported"), _number(recorded, "recorded"))


SQL_LOAD_WITH_BAD_FILE = EV + f"""
SELECT {PER_DAY}, CAST(2 AS BIGINT) AS reported, CAST(0 AS BIGINT) AS recorded FROM clean GROUP BY ALL"""


def q_recover_load(spark, sf):
    """A load that died before its ``loaded`` entries, one of whose files is damaged since: its rows stay."""
    lake = _one_file_a_day(_clean_events(spark, sf, keep=()), scratch_dir(spark, "lake") + "/btc_trades")
    table = _fresh_table(spark)
    names = resolve_names(spark, table)
    load_batch(spark, lake + ALL_DAYS, table).collect()
    led = spark.table(names.ledger_table)
    begun = led.where(F.col("status") == "pending").collect()
    spark.sql(f"TRUNCATE TABLE {names.ledger_table}")
    spark.createDataFrame(begun, led.schema).write.insertInto(names.ledger_table)
    path = preview(list_files(spark, lake + ALL_DAYS), 1)[0]
    _write_bytes(spark, path, _damaged(spark, path))
    m = load_batch(spark, lake + ALL_DAYS, table).first()
    return _per_day(fact_view(spark, table), _number(m.recovered_loads, "recovered"), _number(m.files_failed, "failed"))


SQL_RECOVER_LOAD = EV + f"""
SELECT {PER_DAY}, CAST(0 AS BIGINT) AS recovered, CAST(1 AS BIGINT) AS failed FROM clean GROUP BY ALL"""


def q_compact_days(spark, sf):
    """Two loads of every day, then one load id a day with the same rows."""
    halves = _clean_events(spark, sf)
    table = _fresh_table(spark)
    for k in (0, 1):
        half = halves.where(F.col("event_id") % 2 == k).drop("event_id")
        lake = _one_file_a_day(half, scratch_dir(spark, "lake") + "/btc_trades")
        load_batch(spark, lake + ALL_DAYS, table).collect()
    compact_days(spark, table)
    ids = spark.table(resolve_names(spark, table).fact).groupBy(F.dayofmonth("trade_date").cast("bigint").alias("day")).agg(
        F.countDistinct("load_id").alias("load_ids")
    )
    return _per_day(fact_view(spark, table)).join(ids, "day")


SQL_COMPACT_DAYS = EV + f"""
SELECT {PER_DAY}, CAST(1 AS BIGINT) AS load_ids FROM clean GROUP BY ALL"""


def q_load_layout(spark, sf):
    """Files a day in the table: one for a small day, as many as its bytes need for a large one."""
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + ALL_DAYS, table).collect()
    rows = spark.table(resolve_names(spark, table).fact)
    per_file = rows.groupBy("trade_date", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("trade_date").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))


SQL_LOAD_LAYOUT = EV + """
SELECT CAST("timestamp" AS DATE) AS trade_date, CAST(count(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS n_files FROM clean GROUP BY ALL"""


def q_load_reconciled(spark, sf):
    """Rows of each day's files by their footers, in the ledger, and in the table."""
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    m = load_batch(spark, lake + ALL_DAYS, table).first()
    footers = classify_files(list_files(spark, lake + ALL_DAYS)).select("path", F.col("rows").alias("footer_rows"))
    recorded = ledger_rows(spark, resolve_names(spark, table)).where(F.col("status") == "loaded").select(F.col("file_name").alias("path"), F.col("n_rows").alias("ledger_rows"))
    by_file = footers.join(recorded, "path", "full")
    days = by_file.groupBy(*[_part(F.col("path"), c).alias(c) for c in LAKE_PARTITIONS]).agg(F.sum("footer_rows").alias("footer_rows"), F.sum("ledger_rows").alias("ledger_rows"))
    return _per_day(fact_view(spark, table)).drop("quantity").join(days, list(LAKE_PARTITIONS), "full").withColumn("unreconciled", F.lit(m.unreconciled_loads))


SQL_LOAD_RECONCILED = EV + """
SELECT year("timestamp")::BIGINT AS year, month("timestamp")::BIGINT AS month, day("timestamp")::BIGINT AS day,
       count(*) AS n_rows, count(*) AS footer_rows, count(*) AS ledger_rows, CAST(0 AS BIGINT) AS unreconciled
FROM clean GROUP BY ALL"""


def _begun_only(spark: SparkSession, table: str, files: DataFrame, load_id: str) -> None:
    """A load that recorded its files and died before it wrote anything."""
    import datetime as dt

    record(spark, resolve_names(spark, table), files.select("path"), load_id, "pending", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))


def q_recover_unwritten(spark, sf):
    """A load that died before it wrote anything, one of whose files is damaged since: the others are loaded, the bad one is tried again."""
    clean = _clean_events(spark, sf, keep=())
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    small = scratch_dir(spark, "small")
    clean.limit(20).coalesce(1).write.parquet(small)
    bad = lake + "/year=2024/month=1/day=1/damaged.parquet"
    _write_bytes(spark, bad, _damaged(spark, preview(list_files(spark, small + "/*.parquet"), 1)[0]))
    _begun_only(spark, table, list_files(spark, lake + ALL_DAYS), "died")
    first = load_batch(spark, lake + ALL_DAYS, table).first()
    second = load_batch(spark, lake + ALL_DAYS, table).first()
    named = sum([f.rsplit("/", 1)[1] for f in m.failed] == ["damaged.parquet"] for m in (first, second))
    return _per_day(fact_view(spark, table), _number(first.abandoned_loads, "abandoned"), _number(named, "reported"), _number(second.files_loaded, "loaded_again"))


SQL_RECOVER_UNWRITTEN = EV + f"""
SELECT {PER_DAY}, CAST(1 AS BIGINT) AS abandoned, CAST(2 AS BIGINT) AS reported, CAST(0 AS BIGINT) AS loaded_again FROM clean GROUP BY ALL"""


def q_ledger_snapshot(spark, sf):
    """Several loads, then a snapshot: the same files are listed before and after, none is loaded
    again, a load that is still open is carried over, and the tail is one file."""
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    names = resolve_names(spark, table)
    for day in ("1", "2", "3*", "1?", "2?"):
        load_batch(spark, lake + f"/year=*/month=*/day={day}/*.parquet", table).collect()
    before = ledger_view(spark, table).select("file_name").checkpoint()
    waiting = list_files(spark, lake + "/year=*/month=*/day=9/*.parquet")
    _begun_only(spark, table, waiting, "open")
    compact_ledger(spark, table)
    after = ledger_view(spark, table).select("file_name")
    changed = before.exceptAll(after).unionByName(after.exceptAll(before)).count()
    tail = spark.table(names.ledger_table).where("part = 'tail'")
    tail_files = tail.select(F.col("_metadata.file_path").alias("f")).distinct().count()
    recovered = load_batch(spark, lake + ALL_DAYS, table).first()
    again = load_batch(spark, lake + ALL_DAYS, table).first()
    return _per_day(
        fact_view(spark, table), _number(changed, "changed"), _number(tail_files, "tail_files"),
        _number(recovered.recovered_loads, "recovered"), _number(again.files_loaded, "loaded_again"),
    )


SQL_LEDGER_SNAPSHOT = EV + f"""
SELECT {PER_DAY}, CAST(0 AS BIGINT) AS changed, CAST(1 AS BIGINT) AS tail_files, CAST(1 AS BIGINT) AS recovered, CAST(0 AS BIGINT) AS loaded_again
FROM clean GROUP BY ALL"""

# ---------------------------------------------------------------- step 9: streaming


def _message_files(spark: SparkSession, sf: str) -> str:
    folder = scratch_dir(spark, "messages")
    events_as_messages(spark, sf).select("value").write.text(folder)
    return folder


def q_stream_clean(spark, sf):
    folder = _message_files(spark, sf)
    lake = scratch_dir(spark, "lake") + "/btc_trades"
    q = stream_trades(
        spark.readStream.schema("value string").text(folder), lake, scratch_dir(spark, "ckpt"),
        raw=True, trigger={"availableNow": True},
    )
    q.awaitTermination()
    return spark.read.parquet(lake).select(*TRADE_COLS)


SQL_STREAM_CLEAN = SQL_READ_MIXED_TIMESTAMPS


def _both_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Clean trades and rejects of one folder, one under the other."""
    clean, rejects = read_outcomes(spark, path)
    blank = [F.lit("").alias("symbol"), F.lit(0.0).alias("price"), F.lit(0.0).alias("quantity"), F.timestamp_millis(F.lit(0)).alias("timestamp")]
    return clean.select(*TRADE_COLS, F.lit("").alias("reject_reason")).unionByName(rejects.select(*blank, "reject_reason"))


SQL_BOTH_OUTCOMES = EV + """
SELECT symbol, price, quantity, "timestamp", '' AS reject_reason FROM clean
UNION ALL
SELECT '', 0.0, 0.0, TIMESTAMP '1970-01-01', CASE WHEN NOT (price > 0) THEN 'invalid_price' ELSE 'invalid_quantity' END
FROM ev WHERE NOT (price > 0 AND quantity > 0)"""


def q_write_outcomes(spark, sf):
    """Clean trades and rejects written by one pass over the messages."""
    out = scratch_dir(spark, "outcomes")
    write_outcomes(trade_outcomes(_decoded_events(spark, sf)), out)
    return _both_outcomes(spark, out)


def q_stream_outcomes(spark, sf):
    """The same as one stream."""
    out = scratch_dir(spark, "outcomes")
    messages = spark.readStream.schema("value string").text(_message_files(spark, sf))
    stream_outcomes(messages, out, scratch_dir(spark, "ckpt"), raw=True, trigger={"availableNow": True}).awaitTermination()
    return _both_outcomes(spark, out)


def _out_of_order(spark: SparkSession, sf: str, copies: int = 1) -> DataFrame:
    """A stream of clean trades from files that each hold all times, two files a micro-batch."""
    folder = scratch_dir(spark, "messages")
    one = events_as_messages(spark, sf).select("value")
    for _ in range(copies):
        one.repartition(6).write.mode("append").text(folder)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).text(folder)
    return split_trades(from_exchange(decode_json(messages))).clean


def q_stream_minutes(spark, sf):
    out = scratch_dir(spark, "minutes")
    stream_minute_price_runs(_out_of_order(spark, sf), out, scratch_dir(spark, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    return read_minute_price_runs(spark, out)


SQL_STREAM_MINUTES = SQL_MINUTE_PRICE_RUNS


def q_stream_ohlcv(spark, sf):
    out = scratch_dir(spark, "bars")
    stream_minute_ohlcv(_out_of_order(spark, sf), out, scratch_dir(spark, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    return read_minute_ohlcv(spark, out).select(
        "minute", "symbol", "n_trades", "open", "high", "low", "close", _dec(F.col("volume")).alias("volume"), _dec(F.col("vwap"), 6).alias("vwap")
    )


def q_roll_up_minutes(spark, sf):
    """The parts of all ended batches merged: the same sums from at most two parts."""
    out = scratch_dir(spark, "minutes")
    stream_minute_price_runs(_out_of_order(spark, sf), out, scratch_dir(spark, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    roll_up_minute_price_runs(spark, out)
    parts = spark.read.parquet(out).select("batch").distinct().count()
    return read_minute_price_runs(spark, out).withColumn("parts", F.lit(parts).cast("bigint"))


SQL_ROLL_UP_MINUTES = f"SELECT *, CAST(2 AS BIGINT) AS parts FROM ({SQL_MINUTE_PRICE_RUNS})"


def q_roll_up_ohlcv(spark, sf):
    out = scratch_dir(spark, "bars")
    stream_minute_ohlcv(_out_of_order(spark, sf), out, scratch_dir(spark, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    roll_up_minute_ohlcv(spark, out)
    return read_minute_ohlcv(spark, out).select(
        "minute", "symbol", "n_trades", "open", "high", "low", "close", _dec(F.col("volume")).alias("volume"), _dec(F.col("vwap"), 6).alias("vwap")
    )


SQL_STREAM_OHLCV = f"SELECT * EXCLUDE (window_start) FROM ({SQL_MINUTE_OHLCV})"


def q_dedupe_stream(spark, sf):
    """Every message arrives twice, in no order."""
    out = scratch_dir(spark, "deduped")
    dedupe_stream(_out_of_order(spark, sf, copies=2), out, scratch_dir(spark, "ckpt"), FIELDS, {"availableNow": True}).awaitTermination()
    return deduped(spark, out)


SQL_DEDUPE_STREAM = EV + """
SELECT DISTINCT symbol, price, quantity, "timestamp" FROM clean"""


def q_for_each_batch(spark, sf):
    """A callback that counts each micro-batch by symbol; its output is named after the batch."""
    out = scratch_dir(spark, "batches")

    def count(trades: DataFrame, batch_id: int) -> None:
        trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    folder = scratch_dir(spark, "messages")
    events_as_messages(spark, sf).select("value").repartition(4).write.text(folder)
    messages = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).text(folder)
    for_each_batch(messages, count, scratch_dir(spark, "ckpt"), raw=True, trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(out).groupBy("symbol").agg(F.sum("n").alias("n_trades"))


SQL_FOR_EACH_BATCH = EV + """
SELECT symbol, count(*) AS n_trades FROM clean GROUP BY symbol"""


def q_custom_codec(spark, sf):
    """Messages as base64 text instead of JSON, there and back."""
    clean = _clean_events(spark, sf)
    messages = encode_json(clean, codec=lambda c: F.base64(F.to_json(c).cast("binary")))
    back = decode_json(messages, codec=lambda c: F.try_parse_json(F.unbase64(c).cast("string")))
    get = lambda key, kind: F.try_variant_get("msg", f"$.{key}", kind)
    return back.select(
        get("event_id", "bigint").alias("event_id"), get("symbol", "string").alias("symbol"),
        get("price", "double").alias("price"), get("quantity", "double").alias("quantity"),
        get("timestamp", "timestamp").alias("timestamp"),
    )


SQL_CUSTOM_CODEC = SQL_CLEAN_TRADES


def q_stream_load(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    q = load_stream(spark, lake, table, scratch_dir(spark, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return fact_view(spark, table)


SQL_STREAM_LOAD = SQL_READ_MIXED_TIMESTAMPS


def q_stream_after_batch(spark, sf):
    """A stream over files of which a batch load has loaded some."""
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + SOME_DAYS, table).collect()
    load_stream(spark, lake, table, scratch_dir(spark, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    return _per_day(fact_view(spark, table))


def q_two_streams(spark, sf):
    """Two streams of the same name, each over half of the trades of the same days."""
    messages = events_as_messages(spark, sf)
    table = _fresh_table(spark)
    for k in (0, 1):
        # chosen as messages: each is decoded and cleaned once
        half = split_trades(from_exchange(decode_json(messages.where(F.col("event_id") % 2 == k)))).clean
        lake = _one_file_a_day(half, scratch_dir(spark, "lake") + "/btc_trades")
        load_stream(spark, lake, table, scratch_dir(spark, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    return _per_day(fact_view(spark, table))


# ---------------------------------------------------------------- step 11: extension


def q_dedupe_merge(spark, sf):
    lake = _event_lake(spark, sf)
    table = _fresh_table(spark)
    load_batch(spark, lake + "/year=*/month=*/day=1*/*.parquet", table).collect()
    replay = _clean_events(spark, sf, keep=()).unionByName(_clean_events(spark, sf, keep=()))
    return rows_to_add(spark, replay, table, FIELDS)


SQL_DEDUPE_MERGE = EV + """
SELECT DISTINCT symbol, price, quantity, "timestamp" FROM clean
WHERE CAST(day("timestamp") AS VARCHAR) NOT LIKE '1%'"""


# ---------------------------------------------------------------- registry

REGISTRY: dict[str, tuple[Query, str | None]] = {
    "normalize_symbol": (q_normalize_symbol, SQL_NORMALIZE_SYMBOL),
    "parse_ts_numeric": (q_parse_ts_numeric, SQL_PARSE_TS_NUMERIC),
    "parse_ts_iso": (q_parse_ts_iso, SQL_PARSE_TS_ISO),
    "parse_ts_week": (q_parse_ts_week, SQL_PARSE_TS_WEEK),
    "to_double": (q_to_double, SQL_TO_DOUBLE),
    "minute_bucket": (q_minute_bucket, SQL_MINUTE_BUCKET),
    "decode_json": (q_decode_json, SQL_DECODE_JSON),
    "encode_json": (q_encode_json, SQL_ENCODE_JSON),
    "from_exchange": (q_from_exchange, SQL_FROM_EXCHANGE),
    "validate_trades": (q_validate_trades, SQL_VALIDATE_TRADES),
    "clean_trades": (q_clean_trades, SQL_CLEAN_TRADES),
    "clean_lineitem": (q_clean_lineitem, SQL_CLEAN_LINEITEM),
    "reject_counts": (q_reject_counts, SQL_REJECT_COUNTS),
    "minute_price_runs": (q_minute_price_runs, SQL_MINUTE_PRICE_RUNS),
    "minute_prices": (q_minute_prices, SQL_MINUTE_PRICES),
    "minute_price_chunks": (q_minute_price_chunks, SQL_MINUTE_PRICE_RUNS),
    "minute_ohlcv": (q_minute_ohlcv, SQL_MINUTE_OHLCV),
    "write_partitioned": (q_write_partitioned, SQL_WRITE_PARTITIONED),
    "write_processing_time": (q_write_processing_time, SQL_WRITE_PROCESSING_TIME),
    "batch_files": (q_batch_files, SQL_BATCH_FILES),
    "list_files": (q_list_files, SQL_LIST_FILES),
    "limit_files": (q_limit_files, SQL_LIMIT_FILES),
    "single_file": (q_single_file, SQL_SINGLE_FILE),
    "exists_preview": (q_exists_preview, SQL_EXISTS_PREVIEW),
    "pending_files": (q_pending_files, SQL_PENDING_FILES),
    "read_mixed_timestamps": (q_read_mixed_timestamps, SQL_READ_MIXED_TIMESTAMPS),
    "read_projected": (q_read_projected, SQL_READ_PROJECTED),
    "load_batch": (q_load_batch, SQL_LOAD_BATCH),
    "load_twice": (q_load_twice, SQL_LOAD_TWICE),
    "ledger_rows": (q_ledger_rows, SQL_LEDGER_ROWS),
    "load_metrics": (q_load_metrics, SQL_LOAD_METRICS),
    "create_tables": (q_create_tables, SQL_CREATE_TABLES),
    "ledger_lookup": (q_ledger_lookup, SQL_LEDGER_LOOKUP),
    "load_with_bad_file": (q_load_with_bad_file, SQL_LOAD_WITH_BAD_FILE),
    "recover_load": (q_recover_load, SQL_RECOVER_LOAD),
    "compact_days": (q_compact_days, SQL_COMPACT_DAYS),
    "load_layout": (q_load_layout, SQL_LOAD_LAYOUT),
    "load_reconciled": (q_load_reconciled, SQL_LOAD_RECONCILED),
    "recover_unwritten": (q_recover_unwritten, SQL_RECOVER_UNWRITTEN),
    "ledger_snapshot": (q_ledger_snapshot, SQL_LEDGER_SNAPSHOT),
    "trades_between": (q_trades_between, SQL_TRADES_BETWEEN),
    "stream_clean": (q_stream_clean, SQL_STREAM_CLEAN),
    "stream_minutes": (q_stream_minutes, SQL_STREAM_MINUTES),
    "stream_ohlcv": (q_stream_ohlcv, SQL_STREAM_OHLCV),
    "dedupe_stream": (q_dedupe_stream, SQL_DEDUPE_STREAM),
    "write_outcomes": (q_write_outcomes, SQL_BOTH_OUTCOMES),
    "stream_outcomes": (q_stream_outcomes, SQL_BOTH_OUTCOMES),
    "roll_up_minutes": (q_roll_up_minutes, SQL_ROLL_UP_MINUTES),
    "roll_up_ohlcv": (q_roll_up_ohlcv, SQL_STREAM_OHLCV),
    "for_each_batch": (q_for_each_batch, SQL_FOR_EACH_BATCH),
    "custom_codec": (q_custom_codec, SQL_CUSTOM_CODEC),
    "stream_load": (q_stream_load, SQL_STREAM_LOAD),
    "stream_after_batch": (q_stream_after_batch, SQL_PER_DAY),
    "two_streams": (q_two_streams, SQL_PER_DAY),
    "dedupe_merge": (q_dedupe_merge, SQL_DEDUPE_MERGE),
}


def _utc(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    return run


def queries() -> dict[str, Query]:
    return {name: _utc(fn) for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, (_, sql) in REGISTRY.items() if sql}
