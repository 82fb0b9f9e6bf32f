r"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures.

Words are counted over all texts first. A word's letters are a binary vector with one place for
each (letter, occurrence): one replaced letter changes two places, one inserted letter changes
one. A vector's places are dealt into ``parts`` partitions, and a signature is what is left when
some are left out: two for replacements (two vectors at distance two agree on one of them at
least), one for insertions. Signatures are computed for the letters of one of ``pieces`` stretches
of the word; what stands before and after that stretch is part of the signature as it is, for one
edit touches one stretch only. Words with an equal signature are joined on its hash and compared.

Defined results
  null or empty text    no words
  null id               counts as an empty id (the run's hash is that of ``:<run>``)
  repeated rows         each counts
  ties                  of near words with the same count the smallest in code-point order
  very long texts       read in stretches, cut where no word goes on
  empty table           no words
  other columns         ignored
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: The letters of a run (after A-Z are lower-cased), and one run in how many loses a letter.
RUN = "[a-zÀ-ÿ]+"
NOT_RUN = re.compile("[^a-zÀ-ÿ]")
ONE_IN = 97
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: A task sends its counts on when it holds this many words.
HELD_WORDS = 300_000
STRETCH = 1_000_000


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters that split no run."""
    a = 0
    while a < len(text):
        cut = NOT_RUN.search(text, a + size)
        b = cut.start() if cut else len(text)
        yield text[a:b]
        a = b


def words_of(doc_id: str, text: str) -> Counter:
    """The counted words of one document: its runs, a letter deleted where the run's hash says so."""
    runs: Counter = Counter()
    find = re.compile(RUN).findall
    for part in stretches(text.encode().translate(_LOWER).decode()):
        runs.update(find(part))
    out: Counter = Counter()
    before = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), before)
        if h % ONE_IN == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n``: words of at least ``min_chars`` code points that all texts hold ``min_count`` times or more."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)

        for batch in batches:
            ids, texts = batch.columns
            for k in range(batch.num_rows):
                for word, n in words_of(ids[k].as_py(), texts[k].as_py()).items():
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    counted = rows.where(F.col("text").isNotNull()).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _dealt(cut: DataFrame, parts: int) -> DataFrame:
    """The binary vector of ``middle``, dealt into partitions: ``p0``, ``p1`` ..., each the text of its places.

    Step by step, so that no step's column is computed twice.
    """
    ordered = cut.withColumn("letters", F.array_sort(F.split("middle", "")))

    def place(letter, k):
        nth = k - F.array_position("letters", letter)
        return F.pmod(F.ascii(letter) * 7 + nth, F.lit(parts)).cast("int")

    placed = ordered.withColumn("places", F.transform("letters", place))

    def part(j):
        own = F.filter("letters", lambda _, k: F.get("places", k) == j)
        return F.array_join(own, "").alias(f"p{j}")

    return placed.select("word", "n", "role", "l", "piece", "head", "tail", *[part(j) for j in range(parts)])


def signatures(words: DataFrame, min_chars: int, pieces: int, parts: int) -> DataFrame:
    """``key, role, word, n``; role 0: words of one length, 1 and 2: the shorter and the longer of a pair one letter apart."""
    length = F.char_length("word")
    forms = F.array(*[F.struct(F.lit(role).alias("role"), (length - (1 if role == 2 else 0)).alias("l")) for role in (0, 1, 2)])
    spread = words.withColumn("f", F.explode(forms)).where(F.col("f.l") >= min_chars)
    places = spread.select("word", "n", "f.role", "f.l", F.explode(F.array(*map(F.lit, range(pieces)))).alias("piece"))
    before = F.floor(F.col("l") * F.col("piece") / pieces).cast("int")
    after = F.col("l") - F.floor(F.col("l") * (F.col("piece") + 1) / pieces).cast("int")
    cut = places.select("word", "n", "role", "l", "piece", before.alias("before"), after.alias("after")).select(
        "word", "n", "role", "l", "piece",
        F.substring("word", F.lit(1), F.col("before")).alias("head"),
        F.when(F.col("after") > 0, F.expr("right(word, after)")).otherwise("").alias("tail"),
        F.substring("word", F.col("before") + 1, F.char_length("word") - F.col("before") - F.col("after")).alias("middle"),
    )
    dealt = _dealt(cut, parts)

    def keys(left_out: int, family: int) -> Column:
        kept = [[j for j in range(parts) if j not in out] for out in combinations(range(parts), left_out)]
        own = (F.lit(family), "l", "piece", "head", "tail")
        return F.array(*[F.xxhash64(*own, F.lit(i), *[f"p{j}" for j in js]) for i, js in enumerate(kept)])

    key = F.explode(F.when(F.col("role") == 0, keys(2, 0)).otherwise(keys(1, 1)))
    return dealt.select(key.alias("key"), "role", "word", "n")


def near_words(words: DataFrame, min_chars: int = 5, pieces: int = 3, parts: int = 3) -> DataFrame:
    """``word, near, near_n``: every pair of words exactly one edit apart, in both directions, once.

    Only words with the same signature meet; the comparison by edit distance decides. A signature
    fixes two thirds of the word and, with a third of the letters' places, most of the rest, so its
    group holds the few words that differ in one stretch.
    """
    signed = signatures(words, min_chars, pieces, parts)
    a = signed.where("role <> 2").select("key", "role", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = signed.where("role <> 1").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = a.join(b, "key").where(((F.col("role") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    )
    return met.select(both.alias("p")).select("p.*").repartition("word").dropDuplicates(["word", "near"])


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: a form's count is twice its word's or more, so paths end; each round doubles the step."""
    at = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(at.join(further, "root", "left").select("word", "root", "next"), "spelling-roots")
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return at
        at = moved.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3, ratio: int = 2
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word.

    ``form`` is the near word of largest count if that is ``ratio`` times the word's own or more;
    ``root`` follows forms to the last.
    """
    words = saved(word_counts(docs, id_col, text_col, min_chars, min_count), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words, min_chars).groupBy("word").agg(F.count("near").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    known = saved(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
