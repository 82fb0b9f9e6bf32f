"""Timestamps.

``parse_epoch_ms`` follows the reference's ``parse_timestamp``:

* numbers (and booleans) below 1e11 are seconds: ``int(ts * 1000)``, truncated
  toward zero (a double multiply for fractional input, exact for integers);
* numbers from 1e11 up are milliseconds: ``int(ts)``;
* NaN and infinities give NULL;
* text must be an ISO-8601 date, week date or date-time (Python 3.11 ``fromisoformat``
  shapes); no zone means UTC. Numeric text such as ``"1704067200000"`` is not a
  timestamp;
* anything else gives NULL.

The ISO gate is a regex because Spark's own cast accepts shapes Python refuses
(``2024``, ``2024-1-1``, ``12:00``) and refuses shapes Python accepts (basic
``20240101T010203``, any one-character date/time separator). Matching text is
rebuilt in the extended form ``yyyy-MM-ddTHH:mm:ss.ffffff+hh:mm`` and cast.
ISO text converts exactly (the reference's float multiply loses 1 ms on about
0.7 % of values; documented divergence).

Instants outside years 1..9999 cannot become a Python datetime; the reference's
consumer crashes on them. ``in_range`` lets callers reject such rows instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from . import json as J

# The seconds/milliseconds threshold, the representable range of a
# Python datetime in epoch ms (0001-01-01T00:00:00Z .. 9999-12-31T23:59:59.999Z),
# the minute width, and the accepted ISO-8601 shapes (groups: year, date
# separator, month, day, hour, time separator, minute, second, fraction, zone).
SECONDS_BELOW = 1e11
MIN_MS = -62135596800000
MAX_MS = 253402300799999
MINUTE_MS = 60000
ISO_TEXT = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_div(x: Column, n: int) -> Column:
    """Integer division truncating toward zero, exact for any BIGINT."""
    return (x.cast("decimal(38,0)") / F.lit(n)).cast("bigint")


def floor_div(x: Column, n: int) -> Column:
    """Integer division rounding toward minus infinity (Python ``//``), exact."""
    return ((x.cast("decimal(38,0)") - F.pmod(x, F.lit(n))) / F.lit(n)).cast("bigint")


# Week dates: year, separator, week, day of the week, and what follows the date.
WEEK_TEXT = r"^(\d{4})(-?)W(\d{2})(?:\2([1-7]))?($|[^0-9-].*$)"


def week_date(s: Column) -> Column:
    """An ISO week date (``2024-W01-1``, ``2024W011``, with or without a time) as calendar date text.

    Week 1 is the one with the year's first Thursday, so it holds January 4; a week whose
    Thursday is in another year is not one of that year. NULL if the text is no week date."""

    def part(i: int) -> Column:
        return F.regexp_extract(s, WEEK_TEXT, i)

    year = part(1).cast("int")
    first = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(first, part(3).cast("int") * 7 - 7 - F.weekday(first))
    day = F.date_add(monday, F.when(part(4) == "", 0).otherwise(part(4).try_cast("int") - 1))
    text = F.when(F.year(F.date_add(monday, 3)) == year, F.concat(F.date_format(day, "yyyy-MM-dd"), part(5)))
    # the cheap test first: hardly any text has a W there
    return F.when(F.substring(s, 5, 2).contains("W") & s.rlike(WEEK_TEXT), text)


# One regex pass rewrites matching text to its parts, in this order:
# year|month|day|hour|minute|second|fraction|zone (empty when absent).
_ISO_PARTS = "$1|$3|$4|$5|$7|$8|$9|$10"


def iso_parts(s: Column) -> Column:
    """``array<string>`` of ISO-8601 parts, NULL when the text is not ISO-8601."""
    return F.when(s.rlike(ISO_TEXT), F.split(F.regexp_replace(s, ISO_TEXT, _ISO_PARTS), r"\|", -1))


def iso_parts_to_ms(parts: Column) -> Column:
    """Epoch ms from ``iso_parts``; NULL for impossible dates (Feb 30, hour 24 ...)."""

    def part(i: int) -> Column:
        return parts.getItem(i)

    def or_zero(x: Column) -> Column:
        return F.when(x == "", F.lit("00")).otherwise(x)

    zone = part(7)
    zone_text = (
        F.when(zone.isin("", "Z"), F.lit("+00:00"))
        .when(F.length(zone) == 3, F.concat(zone, F.lit(":00")))
        .when(F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
        .otherwise(zone)
    )
    text = F.concat(
        part(0), F.lit("-"), part(1), F.lit("-"), part(2),
        F.lit("T"), or_zero(part(3)), F.lit(":"), or_zero(part(4)), F.lit(":"), or_zero(part(5)),
        F.lit("."), F.rpad(F.substring(part(6), 1, 6), 6, "0"), zone_text,
    )
    # int(x.timestamp() * 1000) truncates toward zero.
    return trunc_div(F.unix_micros(text.try_cast("timestamp")), 1000)


def iso_text_to_ms(s: Column) -> Column:
    """Epoch ms of ISO-8601 text; NULL where Python's ``fromisoformat`` would refuse."""
    # one element of an array: the calendar form is computed once, though its parts are used many times
    return F.transform(F.array(F.coalesce(week_date(s), s)), lambda t: iso_parts_to_ms(iso_parts(t)))[0]


# "Wide" values are DECIMAL(38,0) epoch ms, before the range check; values too
# large for it are clamped to +-OUT_OF_RANGE so that they still read as "out of
# range" rather than "unparseable".
OUT_OF_RANGE = 10**30


def _clamp(d: Column) -> Column:
    big = F.lit(str(OUT_OF_RANGE)).cast("decimal(38,0)")
    return F.when(d > big, big).when(d < -big, -big).otherwise(d)


def _integral_to_ms(x: Column) -> Column:
    """``int(ts * 1000)`` below 1e11 else ``int(ts)``, exact."""
    d = _clamp(x.cast("decimal(38,0)"))
    return F.when(d < F.lit(SECONDS_BELOW), d * F.lit(1000).cast("decimal(4,0)")).otherwise(d)


def _fractional_to_ms(x: Column) -> Column:
    """Same for doubles: a double multiply, then truncation; NULL for NaN and +-inf."""
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ms = F.when(x < F.lit(SECONDS_BELOW), x * F.lit(1000.0)).otherwise(x)
    bounded = F.greatest(F.least(ms, F.lit(float(OUT_OF_RANGE))), F.lit(-float(OUT_OF_RANGE)))
    # Truncate toward zero in the double domain (a cast to DECIMAL would round);
    # from 2**53 up every double is an integer and converts exactly.
    truncated = F.when(bounded >= 0, F.floor(bounded)).otherwise(F.ceil(bounded))
    exact = F.when(F.abs(bounded) < F.lit(2.0**53), truncated.cast("decimal(38,0)")).otherwise(
        bounded.cast("decimal(38,0)")
    )
    return F.when(finite, exact)


def epoch_ms_wide(col: Column | str, dtype: DataType) -> Column:
    """``parse_timestamp`` as DECIMAL(38,0) epoch ms, before the range check."""
    c = _col(col)
    if isinstance(dtype, VariantType):
        k = J.kind(c)
        return (
            F.when(k == "int", _integral_to_ms(J.as_integral(c)))
            .when(k == "float", _fractional_to_ms(J.as_double(c)))
            .when(k == "bool", F.when(J.as_bool(c), F.lit(1000)).otherwise(F.lit(0)).cast("decimal(38,0)"))
            .when(k == "string", iso_text_to_ms(J.as_string(c)).cast("decimal(38,0)"))
        )
    if isinstance(dtype, IntegralType) or (isinstance(dtype, DecimalType) and dtype.scale == 0):
        return _integral_to_ms(c)
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        return _fractional_to_ms(c.cast("double"))
    if isinstance(dtype, BooleanType):
        return F.when(c, F.lit(1000)).when(~c, F.lit(0)).cast("decimal(38,0)")
    if isinstance(dtype, StringType):
        return iso_text_to_ms(c).cast("decimal(38,0)")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return trunc_div(F.unix_micros(c.cast("timestamp")), 1000).cast("decimal(38,0)")
    if isinstance(dtype, DateType):
        return F.unix_millis(c.cast("timestamp")).cast("decimal(38,0)")
    return F.lit(None).cast("decimal(38,0)")


def with_epoch_ms_wide(df, src: str, out: str):
    """DataFrame form of ``epoch_ms_wide`` in small steps (kind, text, parts, value).

    Each step is its own projection, so expensive pieces (the VARIANT type, the
    regex) are computed once per row and generated code stays small. Adds
    ``out`` and helper columns ``out + "_*"`` that the caller may drop.
    """
    dtype = df.schema[src].dataType
    c = F.col(src)
    if isinstance(dtype, VariantType):
        df = df.withColumn(out + "_k", J.kind(c))
        k = F.col(out + "_k")
        text = F.when(k == "string", J.as_string(c))
        numeric = (
            F.when(k == "int", _integral_to_ms(J.as_integral(c)))
            .when(k == "float", _fractional_to_ms(J.as_double(c)))
            .when(k == "bool", F.when(J.as_bool(c), F.lit(1000)).otherwise(F.lit(0)).cast("decimal(38,0)"))
        )
    elif isinstance(dtype, StringType):
        text, numeric = c, F.lit(None).cast("decimal(38,0)")
    else:
        text, numeric = F.lit(None).cast("string"), epoch_ms_wide(c, dtype)
    df = df.withColumn(out + "_num", numeric).withColumn(out + "_text", F.coalesce(week_date(text), text))
    df = df.withColumn(out + "_parts", iso_parts(F.col(out + "_text")))
    iso = iso_parts_to_ms(F.col(out + "_parts")).cast("decimal(38,0)")
    return df.withColumn(out, F.coalesce(F.col(out + "_num"), iso))


def in_range(ms_wide: Column) -> Column:
    return ms_wide.between(F.lit(MIN_MS), F.lit(MAX_MS))


def parse_epoch_ms(col: Column | str, dtype: DataType) -> Column:
    """Epoch milliseconds (BIGINT) of a timestamp-like column, NULL if unparseable
    or outside years 1..9999."""
    wide = epoch_ms_wide(col, dtype)
    return F.when(in_range(wide), wide.cast("bigint"))


def ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch ms -> UTC TIMESTAMP (P5)."""
    return F.timestamp_millis(_col(ms))


def minute_bucket(ms: Column | str) -> Column:
    """``ms // 60000`` with floor semantics (P8): -1 -> -1, 59999 -> 0, 60000 -> 1."""
    return floor_div(_col(ms), MINUTE_MS)


def trade_date(ts: Column | str) -> Column:
    """Event-day partition value of the fact table."""
    return F.to_date(_col(ts))


def processing_partitions(as_of: Column | _dt.datetime | str | None = None) -> list[Column]:
    """Lake partition columns ``year, month, day`` (P6), unpadded integers.

    Default is processing time (the reference's layout). A fixed instant or a column
    (e.g. the trade's own timestamp for a backfill) may be given instead.
    """
    if as_of is None:
        ts = F.current_timestamp()
    elif isinstance(as_of, Column):
        ts = as_of
    else:
        ts = F.lit(as_of).cast("timestamp")
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day")]
