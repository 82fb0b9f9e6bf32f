"""Trade message sources.

Messages are JSON text in a ``value`` column, whether they come from Kafka
(``sources.kafka``), from text files (``spark.read.text``), or from a stream of
either. The test tables are shaped into messages here so that the whole path,
text -> VARIANT -> typed trade, runs on data that grows with the tables:

* ``events``: symbol ``event_type``, price ``value``, quantity ``props.k``,
  time ``ts`` (a zone-less timestamp read as UTC);
* ``lineitem``: symbol ``l_returnflag || l_linestatus``, price
  ``l_extendedprice``, quantity ``l_quantity``, time ``l_shipdate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(messages: DataFrame, partitions: int) -> DataFrame:
    """Deal messages over ``partitions`` tasks before CPU-heavy work: a round-robin
    shuffle of the raw text, for sources of few partitions (one unsplittable file, a
    topic with few partitions)."""
    return messages.repartition(partitions)


def _epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _raw(symbol: Column, price: Column, quantity: Column, ts: Column) -> Column:
    """Exchange message text ``{"s", "p", "q", "T"}`` with numbers as text, like the exchange sends."""
    return F.to_json(
        F.struct(
            symbol.alias("s"),
            price.cast("string").alias("p"),
            quantity.cast("string").alias("q"),
            _epoch_ms(ts).alias("T"),
        )
    )


def event_fields(events: DataFrame) -> dict[str, Column]:
    return {
        "symbol": F.col("event_type"),
        "price": F.col("value"),
        "quantity": F.get_json_object(F.col("props"), "$.k"),
        "timestamp": F.col("ts"),
    }


def lineitem_fields(lineitem: DataFrame) -> dict[str, Column]:
    return {
        "symbol": F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
        "price": F.col("l_extendedprice"),
        "quantity": F.col("l_quantity"),
        "timestamp": F.col("l_shipdate"),
    }


def events_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value``: raw exchange messages built from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    f = event_fields(ev)
    return ev.select(F.col("event_id"), _raw(f["symbol"], f["price"], f["quantity"], f["timestamp"]).alias("value"))


def lineitem_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, l_linenumber, value``: raw exchange messages built from ``lineitem``."""
    li = read_table(spark, sf_dir, "lineitem")
    f = lineitem_fields(li)
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        _raw(f["symbol"], f["price"], f["quantity"], f["timestamp"]).alias("value"),
    )
