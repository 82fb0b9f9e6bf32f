r"""Line de-duplication: long lines that many documents share stay in one document only.

Method: explode normalised lines, hash each key to 128 bits, count distinct documents
per hash, drop the lines of frequent keys everywhere but in the largest ``doc_id`` that
holds them, and put the other lines together again by position. Built-in functions only.

Defined results
  null or empty text   one empty line, never dropped; a null text stays null
  null doc_id          all rows without an id count as one document, the smallest
  repeated rows        rows of one doc_id count as one document; each row is returned
  ties                 none: the keeper is the largest id, and all its copies of the line stay
  empty table          empty result
  other columns        passed through; ``n_lines`` and ``n_dropped`` replace columns of that name
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, packed, saved, text_of, unpacked

#: Fixed value: the white space that a key loses at both ends.
EDGES = " \t\n\x0b\x0c\r"


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, plus ``n_lines`` (before) and ``n_dropped``.

    Line hashes travel, not lines. A key that a third of all documents hold is counted by
    partial sums, and its join is one that adaptive execution may split.
    """
    work = packed(
        docs,
        F.col(id_col).alias("id"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        F.split(text_of(text_col), "\n", -1).alias("lines"),
    )
    line = F.col("line")
    keyed = work.select("id", "text_hash", F.posexplode("lines").alias("pos", "line")).select(
        "id", "text_hash", "pos", lower_ascii(F.btrim(line, F.lit(EDGES))).alias("key")
    )
    hashed = saved(
        keyed.where(F.char_length("key") >= min_chars).select(
            "id",
            "text_hash",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("second"), "key").alias("h2"),
        ),
        "line-hashes",
    )
    frequent = (
        hashed.groupBy("h1", "h2", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n_docs"), F.max("id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    dropped = (
        hashed.join(frequent, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("d_id"), F.col("text_hash").alias("d_hash"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    joined = work.join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("text_hash") == F.col("d_hash")), "left")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda p: F.get(F.col("lines"), p)
    )
    text = F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    return unpacked(
        joined,
        docs.columns,
        **{
            text_col: text,
            "n_lines": F.size("lines").cast("long"),
            "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
        },
    )
