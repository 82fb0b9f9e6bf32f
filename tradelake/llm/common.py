"""Helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import scratch_dir

ROW = "row"

_KEPT: dict = {}


def kept(key, make):
    """What a Python worker keeps from task to task: one object, so that a stage drops the one of the stage before."""
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Hand memory that is free again to the system; allocators keep it for themselves otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared scratch folder and read it back.

    The folder must outlive the result, whose plan reads it; a lost executor's tasks
    are simply run again from these files.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` beside all input columns in one struct, so that names cannot clash."""
    return df.select(F.struct("*").alias(ROW), *columns)


def unpacked(df: DataFrame, names: list[str], **computed: Column) -> DataFrame:
    """The input's columns again, in order; a computed column replaces one of its name."""
    own = [computed[n].alias(n) if n in computed else F.col(f"{ROW}.`{n}`").alias(n) for n in names]
    return df.select(*own, *[c.alias(n) for n, c in computed.items() if n not in names])


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` is enough (and faster) where all bytes are ASCII."""
    slow = F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(slow)
