"""The corpus pipeline over ``documents``: STAGES in order, each over all that the one before kept.

1. toxicity          documents that the string-kernel machine rejects (score of 0.3 or more) go
2. line_dedup        lines that five documents share stay in the one with the largest id
3. near_duplicates   one document (the smallest id) of each group linked at a similarity of 0.75 stays
4. decontamination   documents that hold a benchmark item go
5. packing           sequences of at most 2048 ids along the Hilbert curve: one row per piece

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from tradelake.llm.common import saved, table
from tradelake.llm.queries import fold, vocabulary

REJECT = 0.3


def unused(docs: DataFrame, name: str) -> str:
    """``name``, longer if the documents have such a column."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold(4) != 2))
    score = unused(docs, "score")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < REJECT).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = unused(docs, "leaks")
    marked = decontaminate.find_leaks(spark, docs, table(spark, sf_dir, "benchmark"), leaks_col=leaks)
    return marked.where(F.size(leaks) == 0).drop(leaks)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), spaces="dropped", end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
#: Learned scores and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
