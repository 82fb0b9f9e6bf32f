"""Token-id files: all ids of a corpus in ascending id order, in patched frame-of-reference blocks.

The file format is a Parquet folder. A row is a run of whole documents: its ``segment`` (the
writing task, in id order), the ids before it in the segment (``first``), the documents' ids and
lengths, and ``data``, a block buffer (see ``pfor``) with its index of block starts. A document's
place among all ids is its place in the segment plus the ids of the segments before; one row for
each segment gives the latter, so neither writing nor reading needs a second pass over ids.

Defined results
  null or empty text   only the end id
  null doc_id          before all others; ties are in the order of the text's hash
  repeated rows        one entry each
  empty table          no rows
  other columns        ignored
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import pfor
from .common import text_of
from .tokens import encoded, encoder

FILE_SCHEMA = "segment int, first long, doc_ids array<long>, lengths array<long>, data binary"
FILE_ARROW = pa.schema(
    [("segment", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())]
)
READ_SCHEMA = "segment int, local_start long, doc_id long, n_tokens long, ids_crc32 long"
READ_ARROW = pa.schema(
    [("segment", pa.int32()), ("local_start", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    spaces: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_per_run: int = 65_536,
    percentile: float = 0.9,
) -> None:
    """``tokenizer``: a vocabulary file at the same place on every executor; ``spaces``: see ``tokens``."""

    def write(batches):
        enc, segment = encoder(tokenizer, spaces), TaskContext.get().partitionId()
        texts = ((i.as_py(), t.as_py()) for b in batches for i, t in zip(b.column("doc_id"), b.column("text")))
        first, names, runs, size = 0, [], [], 0

        def run():
            return pa.RecordBatch.from_pydict(
                {"segment": [segment], "first": [first], "doc_ids": [names], "lengths": [[len(x) for x in runs]], "data": [pfor.encode(np.concatenate(runs), percentile)]},
                schema=FILE_ARROW,
            )

        for doc_id, ids in encoded(texts, enc, end_id):
            names.append(doc_id)
            runs.append(ids)
            size += len(ids)
            if size >= ids_per_run:
                yield run()
                first, names, runs, size = first + size, [], [], 0
        if runs:
            yield run()

    work = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = work.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    ordered.mapInArrow(write, FILE_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the decoded ids of every document."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = pfor.decode(row["data"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": [row["segment"]] * len(ends),
                        "local_start": row["first"] + starts,
                        "doc_id": row["doc_ids"],
                        "n_tokens": row["lengths"],
                        "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)],
                    },
                    schema=READ_ARROW,
                )

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select("segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = (  # a row for each writing task
        sizes.groupBy("segment").agg(F.sum("n").alias("n")).select("segment", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    return files.mapInArrow(read, READ_SCHEMA).join(bases, "segment").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
