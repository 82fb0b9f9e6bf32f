"""Raw exchange trade -> canonical event (P1, D1 -> D2).

The exchange sends ``{"s": symbol, "p": "price text", "q": "quantity text",
"T": epoch ms, ...}``; the producer renames to ``symbol, price, quantity,
timestamp``, converts price and quantity with ``float()`` and passes ``T``
through untouched. A missing key or a bad number raises there; here the row is
kept with a pre-reason and ends in the rejects of ``split_trades``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.numbers import variant_to_double
from .trades import PRE_REASON

# The exchange's short keys and the canonical names they map to.
EXCHANGE_KEYS = {"s": "symbol", "p": "price", "q": "quantity", "T": "timestamp"}


def from_exchange(df: DataFrame, msg: str = "msg") -> DataFrame:
    """Decoded raw messages (VARIANT column ``msg``) -> canonical columns
    ``symbol`` (VARIANT), ``price`` DOUBLE, ``quantity`` DOUBLE, ``timestamp`` (VARIANT)."""
    m = F.col(msg)
    rest = [c for c in df.columns if c not in (msg, PRE_REASON, *EXCHANGE_KEYS.values())]
    fields = df.select(*rest, m.alias("_x_msg"), *[J.field(m, k).alias(f"_x_{k}") for k in EXCHANGE_KEYS])
    s, p, q, t = (F.col(f"_x_{k}") for k in EXCHANGE_KEYS)
    # The top-level type (a schema string over every key) is only needed when a
    # key is missing: an object with all keys is an object.
    top = J.json_type(F.col("_x_msg"))
    reason = (
        F.when(F.col("_x_msg").isNull(), F.lit("malformed_json"))
        .when((s.isNull() | p.isNull() | q.isNull() | t.isNull()) & ~top.startswith("OBJECT"), F.lit("not_an_object"))
        .when(s.isNull(), F.lit("missing_symbol"))
        .when(p.isNull(), F.lit("missing_price"))
        .when(q.isNull(), F.lit("missing_quantity"))
        .when(t.isNull(), F.lit("missing_timestamp"))
    )
    kinds = fields.withColumn("_x_pk", J.kind(p)).withColumn("_x_qk", J.kind(q))
    return kinds.select(
        *rest,
        s.alias("symbol"),
        variant_to_double(p, F.col("_x_pk")).alias("price"),
        variant_to_double(q, F.col("_x_qk")).alias("quantity"),
        t.alias("timestamp"),
        reason.alias(PRE_REASON),
    )


def to_canonical_json(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical event as JSON text (what the producer sends to the topic)."""
    return df.select(
        *keep,
        F.to_json(
            F.struct(
                F.col("symbol"), F.col("price"), F.col("quantity"), F.col("timestamp")
            )
        ).alias("value")
    )
