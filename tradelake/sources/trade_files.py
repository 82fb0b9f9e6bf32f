"""Reading trade Parquet files whatever their physical timestamp type.

Lake files differ in how ``timestamp`` is stored: pandas writes INT64 NANOS (UTC),
Spark and pyarrow write INT64 MICROS (with or without the UTC flag), older files
hold plain INT64 epoch milliseconds, some engines write INT96. Spark cannot merge
these in one scan (and reads NANOS only as BIGINT, under
``spark.sql.legacy.parquet.nanosAsLong``), so:

1. ``classify_files`` reads each file's Parquet *footer* (not its data) in a
   distributed ``mapInArrow`` and returns a type signature and the number of rows per file, or an error
   for unreadable files and files without the needed columns;
2. ``read_trades`` reads each signature group with its own schema, converts to
   ``symbol STRING, price DOUBLE, quantity DOUBLE, timestamp TIMESTAMP`` and
   ``unionByName``s the groups (at most a handful).

Only the four columns are read (P10); lake partition folders are ignored.

A sound footer does not mean sound data: ``damaged_files`` reads the four columns of
files whole, in tasks, and names those that cannot be read; ``unparseable_files`` names
files whose text timestamps do not parse.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType

from ..functions.timestamps import floor_div, parse_epoch_ms
from ..operators.trades import FIELDS

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
CLASSIFY_SCHEMA = "path string, signature string, rows bigint, bytes bigint, error string"


def _make_opener():
    """Opens a listed path in a task.

    Built as a closure so that it is pickled by value: executors need pyarrow,
    not this package.
    """

    def open_path(path):
        import re as _re
        import urllib.parse as _up

        from pyarrow import fs

        if path.startswith("file:"):
            return fs.LocalFileSystem().open_input_file(_up.unquote(_re.sub(r"^file:(//)?", "", path)))
        if path.startswith("/"):
            return fs.LocalFileSystem().open_input_file(path)
        if path.startswith("s3a://") or path.startswith("s3n://"):
            path = "s3://" + path[6:]
        system, local = fs.FileSystem.from_uri(path)
        return system.open_input_file(local)

    return open_path


def _make_classifier(fields: tuple[str, ...]):
    """The footer reader shipped to executors (a closure, see ``_make_opener``)."""
    open_path = _make_opener()

    def spark_type(col):
        physical = col.physical_type
        logical = str(col.logical_type)
        ltype = getattr(col.logical_type, "type", "NONE")
        if ltype == "TIMESTAMP" or logical.startswith("Timestamp"):
            return ("nanos", "bigint") if "nanoseconds" in logical else ("timestamp", "timestamp")
        if physical == "INT96":
            return "timestamp", "timestamp"
        if ltype == "DATE":
            return "date", "date"
        if ltype == "DECIMAL":
            return "decimal", f"decimal({col.precision},{col.scale})"
        simple = {
            "BYTE_ARRAY": ("text", "string"), "INT64": ("int", "bigint"), "INT32": ("int", "int"),
            "DOUBLE": ("double", "double"), "FLOAT": ("double", "float"), "BOOLEAN": ("bool", "boolean"),
        }
        return simple.get(physical, ("other", ""))

    def signature(path):
        import pyarrow.parquet as pq

        try:
            with open_path(path) as fh:
                meta, size = pq.read_metadata(fh), fh.size()
        except Exception as exc:  # unreadable footer: a failed file, retried next run
            return None, None, None, f"unreadable: {type(exc).__name__}: {exc}"
        cols = {}
        for i in range(len(meta.schema)):
            c = meta.schema.column(i)
            if "." not in c.path:
                cols[c.name] = c
        parts = []
        for name in fields:
            if name == "symbol" and name not in cols:
                parts.append("symbol=absent:")
                continue
            if name not in cols:
                return None, None, None, f"missing column {name}"
            kind, stype = spark_type(cols[name])
            allowed = ("nanos", "timestamp", "int", "text", "date") if name == "timestamp" else (
                ("double", "int", "decimal", "text", "bool") if name != "symbol" else None)
            if not stype or (allowed is not None and kind not in allowed):
                return None, None, None, f"unsupported {name} type {cols[name].physical_type} {cols[name].logical_type}"
            parts.append(f"{name}={kind}:{stype}")
        return ";".join(parts), meta.num_rows, size, None

    def classify(batches):
        import pyarrow as pa

        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [signature(p) for p in paths]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.string()),
                ],
                names=["path", "signature", "rows", "bytes", "error"],
            )

    return classify


def classify_files(files: DataFrame) -> DataFrame:
    """``path, signature, rows, bytes, error`` for every file in a listing (footers only)."""
    return files.select("path").mapInArrow(_make_classifier(tuple(FIELDS)), CLASSIFY_SCHEMA)


def _make_data_reader(fields: tuple[str, ...]):
    """Reads the columns of whole files, a row group at a time, and reports the error of each."""
    open_path = _make_opener()

    def error_of(path):
        import pyarrow.parquet as pq

        try:
            with open_path(path) as fh:
                file = pq.ParquetFile(fh)
                columns = [c for c in fields if c in file.schema_arrow.names]
                for i in range(file.num_row_groups):
                    file.read_row_group(i, columns=columns)
        except Exception as exc:
            return f"damaged: {type(exc).__name__}: {exc}"
        return None

    def check(batches):
        import pyarrow as pa

        for batch in batches:
            paths = batch.column(0).to_pylist()
            errors = [error_of(p) for p in paths]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(errors, pa.string())], names=["path", "error"])

    return check


def damaged_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    """``(path, error)`` of the files whose data cannot be read. Only these reach the driver."""
    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    checked = files.mapInArrow(_make_data_reader(tuple(FIELDS)), "path string, error string")
    return [(r.path, r.error) for r in checked.where("error is not null").collect()]


def unparseable_files(spark: SparkSession, rows) -> list[tuple[str, str]]:
    """Classified files with text timestamps of which one does not parse: they fail, so that
    no row is loaded without its time."""
    found: list[tuple[str, str]] = []
    groups: dict[str, list[str]] = {}
    for r in rows:
        if not r.error and _parse_signature(r.signature)["timestamp"][0] == "text":
            groups.setdefault(r.signature, []).append(r.path)
    for paths in groups.values():
        by_path = {plain_path(p): p for p in paths}
        text = F.col("timestamp")
        bad = (
            spark.read.schema("timestamp string").parquet(*paths)
            .where(text.isNotNull() & parse_epoch_ms(text, StringType()).isNull())
            .select(plain_path(F.col("_metadata.file_path")).alias("path")).distinct()
        )
        found += [(by_path.get(r.path, r.path), "text timestamps that do not parse") for r in bad.collect()]
    return found


def plain_path(path):
    """One spelling of a local path (listings write ``file:/x``, scans ``file:///x``), for text or a column."""
    if isinstance(path, Column):
        return F.regexp_replace(path, "^file:/+", "file:/")
    return re.sub("^file:/+", "file:/", path)


def _parse_signature(signature: str) -> dict[str, tuple[str, str]]:
    out = {}
    for part in signature.split(";"):
        name, rest = part.split("=", 1)
        kind, spark_type = rest.split(":", 1)
        out[name] = (kind, spark_type)
    return out


def _read_group(spark: SparkSession, signature: str, paths: list[str], with_file: bool) -> DataFrame:
    sig = _parse_signature(signature)
    schema = ", ".join(f"`{n}` {t}" for n, (k, t) in sig.items() if k != "absent")
    df = spark.read.schema(schema).parquet(*paths)
    ts_kind = sig["timestamp"][0]
    ts = F.col("timestamp")
    if ts_kind == "nanos":
        ts_out = F.timestamp_micros(floor_div(ts, 1000))
    elif ts_kind == "int":
        ts_out = F.timestamp_millis(ts.cast("bigint"))  # epoch ms, as the reference's fallback
    elif ts_kind == "text":
        ts_out = F.timestamp_millis(parse_epoch_ms(ts, StringType()))
    else:
        ts_out = ts.cast("timestamp")
    symbol: Column = F.lit(None).cast("string") if sig["symbol"][0] == "absent" else F.col("symbol").cast("string")
    cols = [
        symbol.alias("symbol"),
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        ts_out.alias("timestamp"),
    ]
    if with_file:
        cols.append(plain_path(F.col("_metadata.file_path")).alias("file_name"))
    return df.select(*cols)


@dataclass
class TradeRead:
    trades: DataFrame | None
    good: list[str]
    failed: list[tuple[str, str]]


def read_classified(spark: SparkSession, rows, with_file: bool = False) -> TradeRead:
    """Read already classified files (rows with ``path, signature, error``)."""
    groups: dict[str, list[str]] = {}
    failed: list[tuple[str, str]] = []
    for r in rows:
        if r.error:
            failed.append((r.path, r.error))
        else:
            groups.setdefault(r.signature, []).append(r.path)
    if any("timestamp=nanos" in s for s in groups) and spark.conf.get(NANOS_AS_LONG) != "true":
        raise RuntimeError(f"set {NANOS_AS_LONG}=true (get_session and ensure_utc do) to read INT64 NANOS timestamps")
    parts = [_read_group(spark, s, sorted(p), with_file) for s, p in sorted(groups.items())]
    trades = reduce(lambda a, b: a.unionByName(b), parts) if parts else None
    good = sorted(p for ps in groups.values() for p in ps)
    return TradeRead(trades, good, failed)


def read_trades(spark: SparkSession, files: DataFrame | list[str], with_file: bool = False) -> TradeRead:
    """Read trade files of any supported physical layout as one DataFrame.

    ``files`` is a listing (``path`` column) or a list of paths. The paths (not the
    rows) come back to the driver, one entry a file: a Spark scan of chosen files is
    planned from their paths, and its file index lives on the driver in any case.
    """
    if isinstance(files, list):
        files = spark.createDataFrame([(p,) for p in files], "path string")
    return read_classified(spark, classify_files(files).collect(), with_file)
