"""Which task writes which day.

A day's rows go to one task, and a day above ``file_bytes`` to as many as its bytes need, so a
load leaves one file for a small day and ``ceil(bytes / file_bytes)`` for a large one. Tasks
are packed from a histogram of rows a day: neighbouring small days share a task up to an even
share of the whole, counting the cost of opening a file for each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_BYTES = 128 << 20
#: Opening and closing a file costs a task about as much as writing this many bytes.
OPEN_BYTES = 1 << 20


@dataclass(frozen=True)
class DayTasks:
    day: object
    first: int
    tasks: int


def pack_days(rows_by_day: dict, row_bytes: float, slots: int, file_bytes: int = FILE_BYTES) -> tuple[list[DayTasks], int]:
    """Tasks of each day, and their number. ``slots``: tasks there should be at least, if there are as many days."""
    size = {d: n * row_bytes for d, n in rows_by_day.items()}
    share = min(file_bytes + OPEN_BYTES, sum(b + OPEN_BYTES for b in size.values()) / max(1, slots))
    out, task, held = [], 0, 0.0
    for day in sorted(size, key=str):
        if size[day] > file_bytes:
            n = math.ceil(size[day] / file_bytes)
            task += held > 0
            out.append(DayTasks(day, task, n))
            task, held = task + n, 0.0
            continue
        cost = size[day] + OPEN_BYTES
        if held and held + cost > share:
            task, held = task + 1, 0.0
        out.append(DayTasks(day, task, 1))
        held += cost
    return out, max(1, task + (held > 0))


def by_day(rows: DataFrame, rows_by_day: dict, row_bytes: float, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``rows`` (with ``trade_date``) dealt to the tasks that write them, in one exchange."""
    spark = rows.sparkSession
    plan, tasks = pack_days(rows_by_day, row_bytes, 2 * spark.sparkContext.defaultParallelism, file_bytes)
    dealt = spark.createDataFrame([(p.day, p.first, p.tasks) for p in plan], "day date, first int, tasks int")
    turn = F.pmod(F.monotonically_increasing_id(), F.col("tasks")).cast("int")
    placed = rows.join(dealt, F.col("trade_date").eqNullSafe(F.col("day"))).withColumn("task", F.col("first") + turn)
    return placed.repartitionById(tasks, F.col("task")).select(*rows.columns)
