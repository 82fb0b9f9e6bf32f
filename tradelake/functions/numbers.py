"""Numeric coercion (P4) with the rules of Python's ``float()``.

Spark's string-to-double cast and ``float()`` disagree on a few inputs: Spark takes
``1.5d`` and ``1.5f`` (Java suffixes) and refuses ``1_000``. A regex gate decides
what is a number, underscores and surrounding blanks are stripped, then
``try_cast`` converts. JSON booleans count as 1.0 / 0.0; JSON null, objects and
arrays are not numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    VariantType,
)

from . import json as J

# The two shapes of text that Python's float() accepts.
DECIMAL_TEXT = r"^\s*[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?\s*$"
SPECIAL_TEXT = r"(?i)^\s*[+-]?(?:inf|infinity|nan)\s*$"
BLANKS = " \t\n\r\x0b\x0c"  # what \s matches in the patterns above


def text_to_double(s: Column) -> Column:
    """``float(s)`` for text: NULL where Python raises."""
    ok = s.rlike(DECIMAL_TEXT) | s.rlike(SPECIAL_TEXT)
    # Plain trims and replaces (no regex): the gate above already vetted the shape.
    cleaned = F.replace(F.btrim(s, F.lit(BLANKS)), F.lit("_"), F.lit(""))
    return F.when(ok, cleaned.try_cast("double"))


def variant_to_double(v: Column, k: Column | None = None) -> Column:
    """``float(v)`` for a VARIANT; pass ``k`` (its ``json.kind``) if already computed."""
    k = J.kind(v) if k is None else k
    return (
        F.when(k == "int", J.as_integral(v).cast("double"))
        .when(k == "float", J.as_double(v))
        .when(k == "bool", F.when(J.as_bool(v), F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(k == "string", text_to_double(J.as_string(v)))
    )


def to_double(col: Column | str, dtype: DataType) -> Column:
    """Python ``float(x)`` for a column of type ``dtype``; NULL where it would raise."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, VariantType):
        return variant_to_double(c)
    if isinstance(dtype, StringType):
        return text_to_double(c)
    if isinstance(dtype, BooleanType):
        return F.when(c, F.lit(1.0)).when(~c, F.lit(0.0))
    if isinstance(dtype, (DoubleType, FloatType, IntegralType, DecimalType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def is_positive(x: Column) -> Column:
    """``x > 0`` as Python means it: Spark orders NaN above every number, so
    ``NaN > 0`` is true there and must be excluded explicitly."""
    return x.isNotNull() & ~F.isnan(x) & (x > 0)
