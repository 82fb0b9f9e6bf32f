"""Symbol normalisation (P2): null or absent -> ``UNKNOWN``, else text, upper case.

``""`` stays ``""`` and nothing is trimmed, as in the reference. Non-string JSON
values are turned into text by the VARIANT string cast (``123`` -> ``123``,
``true`` -> ``TRUE``); objects print as JSON, not as Python reprs (documented).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, VariantType

from . import json as J

UNKNOWN = "UNKNOWN"


def normalize_symbol(col: Column | str, dtype: DataType = StringType()) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, VariantType):
        text = J.as_string(c)
    elif isinstance(dtype, StringType):
        text = c
    else:
        text = c.cast("string")
    return F.coalesce(F.upper(text), F.lit(UNKNOWN))
