"""Row de-duplication (S26, T6): recommended by the reference's docs, not built there.

Trades carry no exchange id, so two real trades with the same symbol, price,
quantity and millisecond look identical; the caller must name the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_trades(trades: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key (a shuffle on the key, with map-side partial de-duplication)."""
    return trades.dropDuplicates(list(keys))


def new_rows(staged: DataFrame, target: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Staged rows whose key is not in the target yet (the MERGE insert branch)."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}"))
    return dedupe_trades(staged, keys).alias("s").join(target.select(*keys).alias("t"), same, "left_anti")
