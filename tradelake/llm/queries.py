"""The registered queries ``opN_<name>`` and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import scratch_dir

from .common import saved, table, text_of


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_warc, resolve_revisits, write_warc

    path = scratch_dir(spark, "warc")
    write_warc(resolve_revisits(table(spark, sf_dir, "pages")), path)
    return read_warc(spark, path)


OP1_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, url, strlen(body) AS n, sha1(body) AS h FROM p),
b AS (
  SELECT page_id, url, n, array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + CAST((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT), 1)), '') AS digest
  FROM d),
w AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS winner FROM b)
SELECT page_id, url, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = winner THEN NULL ELSE winner END AS refers_to
FROM w
"""


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), spaces="part", end_id=2)
    return read_token_files(spark, path)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the id range is the history, the upper half the new batch; all rows are returned."""
    from .exact_dedup import deduplicate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    old = F.coalesce(F.col("doc_id") <= ((low or 0) + (high or 0)) // 2, F.lit(True))
    return deduplicate(docs.where(old), docs.where(~old)).drop("in_history")


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def fold(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train

    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(fold(4) != 2))
    return score(docs, model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score, statistics, train

    stats = saved(statistics(table(spark, sf_dir, "documents")), "text-statistics")
    model = train(stats, table(spark, sf_dir, "labels").where(fold(3) != 1))
    return score(stats, model).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    pieces = pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), spaces="dropped", end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import drop_repeated_lines

    return drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(text_of("text"), 256).alias("kept_sha256")
    )


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
freq AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT y.doc_id, y.pos, y.line, f.k IS NOT NULL AND y.doc_id <> f.keeper AS gone
  FROM keyed y LEFT JOIN freq f ON y.k = f.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .main_text import extract

    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it holds a benchmark item, and which (item ids, ascending; shares of their words in order)."""
    from .decontaminate import find_leaks

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(spark, docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.col("leaks.item_id").alias("item_ids"), F.col("leaks.ratio").alias("ratios"))


def op11_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes in the order of (first 60 bits of the text's md5, id)."""
    from .histogram_sort import shard_documents

    shards = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return shards.select(
        "doc_id", (F.octet_length(text_of("text")).cast("long") + 16).alias("size"), F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation c begins with the first crc32(c) % 4 turns of conversation c - c % 20."""
    from .prefix_trie import prefix_trie

    conv = F.col("conv")
    trie = prefix_trie(table(spark, sf_dir, "conversations"), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, max_head=3)
    return trie.drop("ref_conv", "ref_pos")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    found = spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_token_blocks": op2_token_blocks,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_main_text": op8_main_text,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_histogram_sort": op11_histogram_sort,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op7_line_dedup": OP7_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
