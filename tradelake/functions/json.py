"""JSON on the wire.

Messages arrive as text (a Kafka ``value`` or a line of a text file). They are
decoded into VARIANT with ``try_parse_json`` rather than ``from_json`` with a
fixed schema, because the cleaning rules depend on the JSON type of each field:
``1704067200000`` is a valid timestamp but ``"1704067200000"`` is not, and a
quoted price is accepted while a list is not. Malformed text decodes to NULL and
becomes a reject row, never a failed job. Of a repeated key the last value counts
(``spark.sql.variant.allowDuplicateKeys``, set by ``ensure_utc``).

Both directions take a codec: a function from a column to a column, text to VARIANT
when decoding and struct to text when encoding. JSON is the default.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


Codec = Callable[[Column], Column]


def decode_json(df: DataFrame, col: str = "value", out: str = "msg", codec: Codec = F.try_parse_json) -> DataFrame:
    """Add ``out`` as the VARIANT form of the text in ``col`` (NULL if malformed)."""
    text = F.col(col)
    if dict(df.dtypes).get(col) == "binary":
        text = text.cast("string")
    return df.withColumn(out, codec(text))


def encode_json(df: DataFrame, cols: list[str] | None = None, out: str = "value", codec: Codec = F.to_json) -> DataFrame:
    """One message (a JSON object by default) per row, in a single ``out`` column (what a Kafka sink wants).

    Note: ``to_json`` writes NaN and Infinity as quoted strings.
    """
    cols = cols or df.columns
    return df.select(codec(F.struct(*[F.col(c) for c in cols])).alias(out))


def field(msg: Column | str, key: str) -> Column:
    """The value under ``key`` as VARIANT: SQL NULL if the key is absent, a VARIANT
    null (type VOID) if it is present with a JSON null."""
    msg = F.col(msg) if isinstance(msg, str) else msg
    return F.try_variant_get(msg, f"$['{key}']", "variant")


def json_type(v: Column) -> Column:
    """Type name of a VARIANT value (``BIGINT``, ``DECIMAL(11,1)``, ``STRING``, ``OBJECT<...>`` ...)."""
    return F.schema_of_variant(v)


def kind(v: Column) -> Column:
    """Coarse JSON kind of a VARIANT: missing, null, int, float, bool, string, object, array."""
    t = json_type(v)
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(t == "VOID", F.lit("null"))
        .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), F.lit("int"))
        .when(t.isin("DOUBLE", "FLOAT") | t.startswith("DECIMAL"), F.lit("float"))
        .when(t == "BOOLEAN", F.lit("bool"))
        .when(t == "STRING", F.lit("string"))
        .when(t.startswith("OBJECT"), F.lit("object"))
        .when(t.startswith("ARRAY"), F.lit("array"))
        .otherwise(F.lit("other"))
    )


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def as_double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def as_integral(v: Column) -> Column:
    return F.try_variant_get(v, "$", "decimal(38,0)")


def as_bool(v: Column) -> Column:
    return F.try_variant_get(v, "$", "boolean")
