"""Validation and cleaning of trade messages.

The reference checks each message twice: ``is_valid_trade`` (an object; keys
``price``, ``quantity``, ``timestamp`` present, a null counts as present; both
numbers coerce and are > 0) and then ``clean_trade`` (symbol normalised; numbers
coerced; ``price <= 0 or quantity <= 0`` dropped; timestamp parsed, dropped if
unparseable). Here both are one ``reject_reason`` column built from Catalyst
expressions, so a message is either a clean trade or a reject row with the first
rule it failed:

    malformed_json, not_an_object, missing_price, missing_quantity,
    missing_timestamp, invalid_price, invalid_quantity, invalid_timestamp,
    timestamp_out_of_range

Inputs may be decoded messages (one VARIANT column) or already typed columns
(``symbol``, ``price``, ``quantity``, ``timestamp`` of any supported type); the
branch is chosen from ``df.schema`` when the plan is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions import json as J
from ..functions.numbers import is_positive, to_double, variant_to_double
from ..functions.symbols import normalize_symbol
from ..functions.timestamps import in_range, ms_to_timestamp, with_epoch_ms_wide

FIELDS = ("symbol", "price", "quantity", "timestamp")
REQUIRED = ("price", "quantity", "timestamp")
CLEAN_COLUMNS = FIELDS
REASON = "reject_reason"
PRE_REASON = "_reject"

# Reject reasons, in the order the rules are applied.
REASONS = (
    "malformed_json",
    "not_an_object",
    "missing_symbol",
    "missing_price",
    "missing_quantity",
    "missing_timestamp",
    "invalid_price",
    "invalid_quantity",
    "invalid_timestamp",
    "timestamp_out_of_range",
)


def message_fields(df: DataFrame, msg: str = "msg", raw: str | None = "value") -> DataFrame:
    """Spread a decoded canonical message into VARIANT columns ``symbol, price,
    quantity, timestamp`` and a pre-reason for text that is not a JSON object."""
    m = F.col(msg)
    # The top-level type is a schema string over every key: only compute it when
    # no canonical key is found (an object with any of them is an object).
    none_found = F.lit(True)
    for f in FIELDS:
        none_found = none_found & J.field(m, f).isNull()
    shape = F.when(m.isNull(), F.lit("malformed_json")).when(
        none_found & ~J.json_type(m).startswith("OBJECT"), F.lit("not_an_object")
    )
    prior = F.coalesce(F.col(PRE_REASON), shape) if PRE_REASON in df.columns else shape
    return df.select(
        *[c for c in df.columns if c not in (msg, PRE_REASON) + FIELDS],
        *[J.field(m, f).alias(f) for f in FIELDS],
        prior.alias(PRE_REASON),
    )


def _typed(df: DataFrame) -> dict[str, object]:
    return {f.name: f.dataType for f in df.schema.fields}


def _present(df: DataFrame, name: str) -> Column:
    """Key present (a JSON null counts as present). Typed columns are always present."""
    if name not in df.columns:
        return F.lit(False)
    return F.col(name).isNotNull() if isinstance(_typed(df)[name], VariantType) else F.lit(True)


def _with_double(df: DataFrame, name: str, out: str) -> DataFrame:
    if name not in df.columns:
        return df.withColumn(out, F.lit(None).cast("double"))
    dtype = _typed(df)[name]
    if isinstance(dtype, VariantType):
        df = df.withColumn(out + "_k", J.kind(F.col(name)))
        return df.withColumn(out, variant_to_double(F.col(name), F.col(out + "_k")))
    return df.withColumn(out, to_double(F.col(name), dtype))


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Add ``_price``, ``_quantity``, ``_ts_wide`` and ``reject_reason`` (NULL = clean).

    Built in small projections so that each expensive piece (VARIANT type, regex)
    runs once per row and whole-stage codegen stays within its size limits.
    """
    present = {f: _present(df, f) for f in REQUIRED}
    prior = F.col(PRE_REASON) if PRE_REASON in df.columns else F.lit(None).cast("string")
    df = _with_double(df, "price", "_price")
    df = _with_double(df, "quantity", "_quantity")
    if "timestamp" in df.columns:
        df = with_epoch_ms_wide(df, "timestamp", "_ts_wide")
    else:
        df = df.withColumn("_ts_wide", F.lit(None).cast("decimal(38,0)"))
    reason = (
        F.when(prior.isNotNull(), prior)
        .when(~present["price"], F.lit("missing_price"))
        .when(~present["quantity"], F.lit("missing_quantity"))
        .when(~present["timestamp"], F.lit("missing_timestamp"))
        .when(~is_positive(F.col("_price")), F.lit("invalid_price"))
        .when(~is_positive(F.col("_quantity")), F.lit("invalid_quantity"))
        .when(F.col("_ts_wide").isNull(), F.lit("invalid_timestamp"))
        .when(~in_range(F.col("_ts_wide")), F.lit("timestamp_out_of_range"))
    )
    return df.withColumn(REASON, reason)


def _clean_projection(df: DataFrame, keep: tuple[str, ...]) -> list[Column]:
    types = _typed(df)
    sym = normalize_symbol(F.col("symbol"), types["symbol"]) if "symbol" in df.columns else F.lit("UNKNOWN")
    return [
        *[F.col(k) for k in keep],
        sym.alias("symbol"),
        F.col("_price").alias("price"),
        F.col("_quantity").alias("quantity"),
        ms_to_timestamp(F.col("_ts_wide").cast("bigint")).alias("timestamp"),
    ]


def _raw_text(df: DataFrame, raw: str | None) -> Column:
    if raw and raw in df.columns:
        return F.col(raw).cast("string")
    present = [c for c in FIELDS if c in df.columns]
    return F.to_json(F.struct(*[F.col(c) for c in present]))


def rows_where(df: DataFrame, cond: Column, cols: list[Column]) -> DataFrame:
    """``df.where(cond).select(cols)`` without a Filter node.

    A Filter on a column computed by the rules would be pushed below the
    projections that compute it, with every alias substituted: the rules would
    then run twice per row (filter, then projection) as one expression too big
    for generated code. A generator emitting zero or one row keeps one
    evaluation and stays inside whole-stage codegen.
    """
    return df.select(F.inline(F.when(cond, F.array(F.struct(*cols)))))


@dataclass
class Split:
    clean: DataFrame
    rejects: DataFrame


def split_trades(df: DataFrame, keep: tuple[str, ...] = (), raw: str | None = "value") -> Split:
    """One pass of rules, two lazy outputs: clean trades and reject rows.

    ``clean``: ``keep..., symbol STRING, price DOUBLE, quantity DOUBLE, timestamp TIMESTAMP``.
    ``rejects``: ``keep..., value STRING, reject_reason STRING``.
    Writing both takes two scans; ``trade_outcomes`` writes both from one.
    """
    marked = with_reject_reason(df)
    clean = rows_where(marked, F.col(REASON).isNull(), _clean_projection(marked, keep))
    rejects = rows_where(
        marked,
        F.col(REASON).isNotNull(),
        [*[F.col(k) for k in keep], _raw_text(marked, raw).alias("value"), F.col(REASON)],
    )
    return Split(clean, rejects)


def trade_outcomes(df: DataFrame, keep: tuple[str, ...] = (), raw: str | None = "value") -> DataFrame:
    """Every row once, with its ``outcome`` (``clean`` or ``reject``): the columns of both outputs
    of ``split_trades``, null where they belong to the other. For one write of both
    (``plans.writer.write_outcomes``) from one pass over the input."""
    marked = with_reject_reason(df)
    clean = F.col(REASON).isNull()
    own = _clean_projection(marked, ())
    return marked.select(
        *[F.col(k) for k in keep],
        *[F.when(clean, c).alias(name) for c, name in zip(own, FIELDS)],
        F.when(~clean, _raw_text(marked, raw)).alias("value"),
        F.col(REASON),
        F.when(clean, "clean").otherwise("reject").alias("outcome"),
    )


def clean_trades(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """only the clean trades."""
    return split_trades(df, keep).clean


def is_valid_trade(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """F1 alone, as the reference's validator sees a message: object, keys present,
    both numbers coerce and are > 0. Adds ``is_valid BOOLEAN``."""
    marked = with_reject_reason(df)
    ok = F.col(REASON).isNull() | F.col(REASON).isin("invalid_timestamp", "timestamp_out_of_range")
    cols = [F.col(k) for k in keep] if keep else [F.col(c) for c in df.columns if c != PRE_REASON]
    return marked.select(*cols, ok.alias("is_valid"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rows per reject reason (partial aggregation, tiny output)."""
    return rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("n_rejects"))
