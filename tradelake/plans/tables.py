"""Fact table and file ledger.

Fact table: ``symbol STRING, price DOUBLE, quantity DOUBLE, timestamp TIMESTAMP``
plus partition columns ``trade_date DATE`` (the day of the trade, as the
reference's day partitioning on ``timestamp``) and ``load_id STRING`` (the load
that wrote the rows; a re-run of that load overwrites exactly its partitions).

Ledger: ``file_name STRING, loaded_at TIMESTAMP, load_id STRING, status STRING, n_rows
BIGINT`` (rows of the file in the load, where known), kept as a snapshot and a tail
(``plans.ledger``). Status ``pending`` is written before a load, ``loaded`` after it
(``failed`` for files that could not be read); compaction has entries of its own
(``plans.compact``). Its public view (``ledger_view``) is the reference's ``(file_name,
loaded_at)`` of loaded files. NOT NULL is not enforced on Parquet tables, so the loader
only ever writes non-null names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_trades, new_rows
from ..session import scratch_dir

DEFAULT_LEDGER = "loaded_files"
FACT_COLUMNS = ("symbol", "price", "quantity", "timestamp")
FACT_DDL = "`symbol` STRING, `price` DOUBLE, `quantity` DOUBLE, `timestamp` TIMESTAMP, `trade_date` DATE, `load_id` STRING"
LEDGER_COLUMNS = ("file_name", "loaded_at", "load_id", "status", "n_rows")
LEDGER_DDL = "`file_name` STRING, `loaded_at` TIMESTAMP, `load_id` STRING, `status` STRING, `n_rows` BIGINT, `part` STRING, `gen` BIGINT, `day` STRING"


class InvalidTableName(ValueError):
    pass


class LedgerMissing(RuntimeError):
    pass


@dataclass(frozen=True)
class TableNames:
    catalog: str
    namespace: str
    table: str
    ledger: str

    @property
    def database(self) -> str:
        return f"`{self.catalog}`.`{self.namespace}`"

    @property
    def fact(self) -> str:
        return f"`{self.catalog}`.`{self.namespace}`.`{self.table}`"

    @property
    def ledger_table(self) -> str:
        return f"`{self.catalog}`.`{self.namespace}`.`{self.ledger}`"


def resolve_names(spark: SparkSession | None, table: str, ledger: str = DEFAULT_LEDGER,
                  current_catalog: str | None = None) -> TableNames:
    """``catalog.db.table`` or ``db.table`` (current catalog); anything else is an error.
    The ledger lives next to the table."""
    parts = table.split(".")
    if len(parts) == 3 and all(parts):
        catalog, namespace, name = parts
    elif len(parts) == 2 and all(parts):
        catalog = current_catalog or (spark.catalog.currentCatalog() if spark is not None else "spark_catalog")
        namespace, name = parts
    else:
        raise InvalidTableName(f"{table!r} is neither db.table nor catalog.db.table")
    return TableNames(catalog, namespace, name, ledger or DEFAULT_LEDGER)


def ledger_id(spark: SparkSession | None, table: str, ledger: str = DEFAULT_LEDGER,
              current_catalog: str | None = None) -> str:
    n = resolve_names(spark, table, ledger, current_catalog)
    return f"{n.catalog}.{n.namespace}.{n.ledger}"


def _exists(spark: SparkSession, names: TableNames, name: str) -> bool:
    return spark.catalog.tableExists(f"{names.catalog}.{names.namespace}.{name}")


def ensure_tables(spark: SparkSession, table: str, location: str | None = None, recreate: bool = False,
                  ledger: bool = True, ledger_name: str = DEFAULT_LEDGER) -> TableNames:
    """Create namespace, fact table and (optionally) ledger if missing.
    ``recreate`` drops the fact table first (S22), and the ledger with it: its files are
    no longer loaded, so the next load must read them again."""
    names = resolve_names(spark, table, ledger_name)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.database}{where}")
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {names.fact}")
        spark.sql(f"DROP TABLE IF EXISTS {names.ledger_table}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {names.fact} ({FACT_DDL}) USING parquet PARTITIONED BY (trade_date, load_id)"
    )
    if ledger:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names.ledger_table} ({LEDGER_DDL}) USING parquet PARTITIONED BY (part, gen, day)")
    return names


def require_ledger(spark: SparkSession, names: TableNames) -> None:
    """The ledger must exist, else stop with advice."""
    if not _exists(spark, names, names.ledger):
        raise LedgerMissing(
            f"no file ledger at {names.catalog}.{names.namespace}.{names.ledger}: "
            "ensure_tables(..., ledger=True) makes one"
        )


def fact_rows(spark: SparkSession, names: TableNames) -> DataFrame:
    """The fact table without the partitions that an unfinished compaction holds twice
    (normally none, and the plain table is read)."""
    from .compact import hidden_partitions

    rows, hidden = spark.table(names.fact), hidden_partitions(spark, names)
    return rows if hidden is None else rows.join(hidden, ["trade_date", "load_id"], "left_anti")


def fact_view(spark: SparkSession, table: str) -> DataFrame:
    """The four public columns of the fact table."""
    return fact_rows(spark, resolve_names(spark, table)).select(*FACT_COLUMNS)


def rows_to_add(spark: SparkSession, staged: DataFrame, table: str, keys: tuple[str, ...]) -> DataFrame:
    """Staged trades whose key the fact table does not hold. ``keys`` must hold
    ``timestamp``: only the partitions of the staged days are read. The staged trades are
    worked out once, and one of each key is kept in the shared scratch folder: both their
    days and the result are read from there."""
    if "timestamp" not in keys:
        raise ValueError("keys must hold timestamp")
    path = scratch_dir(spark, "staged")
    dedupe_trades(staged, keys).write.parquet(path)
    staged = spark.read.schema(staged.schema).parquet(path)
    low, high = staged.agg(F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))).first()
    target = fact_rows(spark, resolve_names(spark, table)).where(F.col("trade_date").between(F.lit(low), F.lit(high)))
    return new_rows(staged, target.select(*FACT_COLUMNS), keys)


def trades_between(spark: SparkSession, table: str, start, end) -> DataFrame:
    """Trades with ``start <= timestamp < end``.

    The ``trade_date`` predicate prunes partitions (a range on ``timestamp`` alone
    does not); the ``timestamp`` predicate is pushed to the Parquet row groups.
    """
    names = resolve_names(spark, table)
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return (
        fact_rows(spark, names)
        .where(F.col("trade_date").between(F.to_date(lo), F.to_date(hi)))
        .where((F.col("timestamp") >= lo) & (F.col("timestamp") < hi))
        .select(*FACT_COLUMNS)
    )
