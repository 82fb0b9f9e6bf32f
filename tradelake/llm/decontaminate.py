"""Benchmark decontamination by latent semantic retrieval.

Method. Documents are cut into passages of 32 words. Three passes over all documents:
1. document frequencies of hashed terms; 2. a randomised SVD of the TF-IDF matrix of all
passages (each task adds ``A^T A`` times a fixed random matrix, the driver gets that sketch of
fixed size and takes its Nystroem eigenpairs); 3. every passage, at a stride of 16 words, is
projected and scaled by the singular values, and compared by cosine with the passages of the
benchmark items. Pairs at a cosine of COSINE or more are candidates. Those around which enough
of the item's words stand at all, in whatever order (first as bits, then by the terms: bounds
that lose none), are aligned with the item by longest common subsequence. An item leaks if most of its
words are there in order, or fewer of them together with its answer (its last words) in one
piece.

Benchmark items are a query set: they go against all rows in blocks of a fixed size.

Defined results
  null or empty text or item   no words: never a leak
  null doc_id                  passed through like any other row
  repeated rows, ties          each row is judged by itself
  empty benchmark              no leaks; empty documents: no rows
  other columns                passed through; ``leaks`` replaces a column of that name
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

#: Hashed terms, columns of the random matrix, dimensions kept.
TERMS, SKETCH, KEPT = 8192, 48, 40
#: Leading directions left out: they tell languages and frequent words apart, not passages.
LEADING = 8
PASSAGE, STRIDE = 32, 16
#: A batch of documents holds about this many words.
BATCH_WORDS = 40_000
#: A candidate's cosine: the highest that loses less than 1 % of the leaks that alignment with every
#: passage finds (paraphrases with 40 % of the words before the answer replaced; see the README).
COSINE = 0.05
#: A leak: share of the item's words in order; the lower one only together with the answer.
COPIED, PARAPHRASED = 0.75, 0.55
#: Items of more words are aligned without counting their words first.
SHORT = 256
#: Bits of items' words: those compared for every passage and item, and for the pairs left.
WIDE, FINE = 512, 2048
ITEMS_PER_BLOCK = 4096
_DROPPED = b".,;:!?\"'()[]{}"
PIECES = 16


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(None, _DROPPED).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def terms_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(TERMS)).astype("<u2")


def _grouped(column):
    """Lists of (index, terms) with about BATCH_WORDS words."""
    group, size = [], 0
    for k, data in enumerate(column):
        terms = np.frombuffer(data.as_py(), "<u2")
        group.append((k, terms))
        size += len(terms)
        if size >= BATCH_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _padded(group: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms as rows of STRIDE words, the last of a document filled up with TERMS; document of each row; its number there)."""
    lengths = np.array([len(t) for _, t in group], dtype=np.int64)
    rows = -(-lengths // STRIDE)
    shift = STRIDE * (np.cumsum(rows) - rows) - (np.cumsum(lengths) - lengths)
    out = np.full(STRIDE * int(rows.sum()), TERMS, dtype=np.int64)
    out[np.arange(lengths.sum()) + np.repeat(shift, lengths)] = np.concatenate([t for _, t in group])
    doc = np.repeat(np.arange(len(group)), rows)
    return out.reshape(-1, STRIDE), doc, np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)


def _passages(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each passage: neighbouring rows of a document, or the only one."""
    with_next = np.append(doc[1:] == doc[:-1], False)[: len(doc)]
    with_last = np.append(False, doc[1:] == doc[:-1])[: len(doc)]
    first = np.nonzero(with_next | ~with_last)[0]
    return first, first + with_next[first]


def _over_words(table: np.ndarray, rows: np.ndarray, add=np.add) -> np.ndarray:
    """The table's rows of the words of each row, added up, one word of every row at a time."""
    columns = np.ascontiguousarray(rows.T)
    out = np.take(table, columns[0], axis=0)
    for column in columns[1:]:
        add(out, np.take(table, column, axis=0), out=out)
    return out


def _sum_rows(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    out = rows[first]
    two = last > first
    out[two] += rows[last[two]]
    return out


def random_matrix() -> np.ndarray:
    return np.random.default_rng(11).normal(size=(TERMS, SKETCH)).astype(np.float32)


def _pieces(array: np.ndarray):
    for k, x in enumerate(np.array_split(array, PIECES)):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["piece", "data"])


def _summed(df: DataFrame, work, dtype) -> np.ndarray:
    """The sum over all tasks of the fixed-size array that each gives."""

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), dtype).astype(np.float64) for x in t.column("data"))
        return pa.table({"piece": t.column("piece")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    rows = df.mapInArrow(work, "piece int, data binary").groupBy("piece").applyInArrow(add, "piece int, data binary").collect()
    return np.concatenate([np.frombuffer(r.data, np.float64) for r in sorted(rows, key=lambda r: r.piece)]) if rows else np.zeros(0)


def document_frequencies(terms: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents hold each hashed term, and the number of documents with words."""

    def run(batches):
        found = np.zeros(TERMS + 1, dtype=np.int64)
        here = np.zeros(TERMS, dtype=bool)
        for batch in batches:
            for data in batch.column(0):
                mine = np.frombuffer(data.as_py(), "<u2")
                if len(mine):
                    here[:] = False
                    here[mine] = True
                    found[:TERMS] += here
                    found[TERMS] += 1
        yield from _pieces(found)

    total = _summed(terms, run, np.int64)
    return (total[:TERMS], int(total[TERMS])) if len(total) else (np.zeros(TERMS), 0)


def inverse_frequencies(df: np.ndarray, n: int) -> np.ndarray:
    return np.log((n + 1.0) / (df + 1.0) + 1e-6).clip(0.01).astype(np.float32)


def sketch_of(group: list[tuple[int, np.ndarray]], idf: np.ndarray, weighted: np.ndarray, out: np.ndarray) -> None:
    """Add ``A^T A omega`` for the passages of some documents (SKETCH x TERMS, without the last idf factor).

    ``weighted``: omega times idf with a row of zeros for filling. A passage's row of A is its
    TF-IDF divided by the root of the sum of its words' squared idf.
    """
    rows, doc, _ = _padded(group)
    if not len(rows):
        return
    first, last = _passages(doc)
    squares = np.append(idf, 0).astype(np.float32).astype(np.float64) ** 2
    length = _sum_rows(np.take(squares, rows) @ np.ones(STRIDE), first, last)
    z = _sum_rows(_over_words(weighted, rows), first, last) / length[:, None]
    back = np.zeros((len(rows), z.shape[1]))
    back[first] = z
    two = last > first
    back[last[two]] += z[two]
    flat = rows.ravel()
    for c in range(z.shape[1]):
        out[c] += np.bincount(flat, weights=np.repeat(back[:, c], STRIDE), minlength=TERMS + 1)[:TERMS]


def latent_table(terms: DataFrame) -> np.ndarray:
    """TERMS + 1 rows: what a term adds to a passage's scaled latent vector."""
    df, n = document_frequencies(terms)
    idf = inverse_frequencies(df, n)

    def run(batches):
        weighted = np.append(random_matrix() * idf[:, None], np.zeros((1, SKETCH), np.float32), axis=0)
        total = np.zeros((SKETCH, TERMS))
        for batch in batches:
            for group in _grouped(batch.column(0)):
                sketch_of(group, idf, weighted, total)
        yield from _pieces(total.ravel())

    summed = _summed(terms, run, np.float64)
    y = summed.reshape(SKETCH, TERMS).T * idf[:, None] if len(summed) else np.zeros((TERMS, SKETCH))
    return table_from(y, idf)


def wide_bits(terms: np.ndarray, n_bits: int) -> np.ndarray:
    """Every one of ``terms`` as one of ``n_bits`` bits (in words of 64), the most frequent ones in different bits; other terms have none."""
    found, n = np.unique(terms, return_counts=True)
    bit = np.empty(len(found), dtype=np.int64)
    bit[np.argsort(-n, kind="stable")] = np.arange(len(found)) % n_bits
    out = np.zeros((TERMS + 1, n_bits // 64), dtype=np.uint64)
    out[found, bit >> 6] = np.uint64(1) << (bit & 63).astype(np.uint64)
    return out


def table_from(y: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Nystroem eigenpairs of A^T A from its sketch, folded with the inverse frequencies and singular values."""
    omega = random_matrix().astype(np.float64)
    shift = 1e-6 * max(1e-9, float(np.linalg.norm(y)))
    core = omega.T @ (y + shift * omega)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    values = np.maximum(values, 1e-12 * max(1e-9, values.max()))
    u, s, _ = np.linalg.svd((y + shift * omega) @ (vectors / np.sqrt(values)), full_matrices=False)
    kept = idf[:, None] * u[:, LEADING : LEADING + KEPT] / np.maximum(s[LEADING : LEADING + KEPT], 1e-9)
    return np.append(kept, np.zeros((1, KEPT)), axis=0).astype(np.float32)


def passages_of(group: list[tuple[int, np.ndarray]], table: np.ndarray):
    """Of all passages at the stride: unit latent vector, document, first word."""
    rows, doc, number = _padded(group)
    first, last = _passages(doc)
    vectors = _sum_rows(_over_words(table, rows), first, last)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vectors, doc[first], STRIDE * number[first]


def _as_floats(bits: np.ndarray) -> np.ndarray:
    """The bits of each row as numbers, so that a product of matrices counts those that two rows share."""
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)


def present_around(rows: np.ndarray, doc: np.ndarray, first: np.ndarray, reach: int) -> np.ndarray:
    """For each passage the terms that its document holds from ``reach`` rows before it to ``reach`` rows after."""
    out = np.zeros((len(first), TERMS + 1), dtype=bool)
    for step in range(-reach, reach + 2):
        at = first + step
        inside = (at >= 0) & (at < len(rows))
        inside[inside] = doc[at[inside]] == doc[first[inside]]
        out[np.nonzero(inside)[0][:, None], rows[at[inside]]] = True
    return out


def bits_around(bits: np.ndarray, doc: np.ndarray, first: np.ndarray, reach: int, out: np.ndarray | None = None, known: int = -1) -> np.ndarray:
    """The same as bits: what ``reach`` rows before and after a passage hold together. ``out`` holds those of ``known`` rows already."""
    if out is None:
        out = np.zeros((len(first), bits.shape[1]), dtype=np.uint64)
    for step in [*range(-reach, -known), *range(known + 2, reach + 2)] if known >= 0 else range(-reach, reach + 2):
        at = first + step
        inside = (at >= 0) & (at < len(doc))
        inside[inside] = doc[at[inside]] == doc[first[inside]]
        out[inside] |= bits[at[inside]]
    return out


def places_of(words: list[bytes]) -> dict[bytes, int]:
    """The places of each word, as the bits of a number."""
    at: dict[bytes, int] = {}
    for i, w in enumerate(words):
        at[w] = at.get(w, 0) | 1 << i
    return at


def common_subsequence(at: dict[bytes, int], n: int, b: list[bytes]) -> int:
    """Length of the longest common subsequence of ``b`` and n words at the places ``at``, a row of the table as bits."""
    full = (1 << n) - 1
    row = full
    for w in b:
        if w in at:
            hit = row & at[w]
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def leak_ratio(item: list[bytes], places: dict[bytes, int], words: list[bytes], at: int) -> float:
    """How much of the item lies in order around word ``at``; 0 if it is no leak."""
    m = len(item)
    region = words[max(0, at - m) : at + PASSAGE + m]
    ratio = common_subsequence(places, m, region) / m
    if ratio >= COPIED:
        return ratio
    if ratio >= PARAPHRASED:
        answer = item[-max(3, m // 5) :]
        if any(region[k : k + len(answer)] == answer for k in range(len(region) - len(answer) + 1)):
            return ratio
    return 0.0


class Items:
    """One block of benchmark items, ready to be searched for."""

    def __init__(self, rows: list[tuple], table: np.ndarray):
        self.table = table
        self.ids, self.words = [i for i, _ in rows], [words_of(text) for _, text in rows]
        self.places = [places_of(w) for w in self.words]
        group = [(k, terms_of(hashes_of(w))) for k, w in enumerate(self.words) if w]
        if group:
            self.vectors, owner, _ = passages_of(group, table)
            self.owned = np.array([k for k, _ in group])
            self.firsts = np.nonzero(np.append(True, owner[1:] != owner[:-1]))[0]  # an item's passages are neighbours
            self.length = np.array([len(w) for w in self.words], dtype=np.int64)
            self.start = np.cumsum(self.length) - self.length
            self.terms = np.concatenate([t for _, t in group])
            # Of a leak's words all but a known number stand around the passage, and each missing word takes one bit at most.
            # Words of no item take no bits. Few bits are compared for all pairs, more for the pairs that are left.
            self.wide, self.fine = wide_bits(self.terms, WIDE), wide_bits(self.terms, FINE)
            whole = np.stack([np.bitwise_or.reduce(self.wide[t], axis=0) for _, t in group])
            self.whole = np.stack([np.bitwise_or.reduce(self.fine[t], axis=0) for _, t in group])
            n = self.length[self.owned]
            missing = np.where(n <= SHORT, n - np.ceil(PARAPHRASED * n - 1e-9).astype(np.int64), n)
            needed = (np.bitwise_count(whole).sum(axis=1, dtype=np.int64) - missing).astype(np.float32)
            self.needed = np.bitwise_count(self.whole).sum(axis=1, dtype=np.int64) - missing
            # A leak lies within an item's length of the passage: shorter items are looked for in fewer rows.
            reach = np.maximum(2, -(-np.minimum(SHORT, n) // STRIDE))
            self.by_reach = [(int(r), k, np.ascontiguousarray(_as_floats(whole[k]).T), needed[k]) for r in np.unique(reach) for k in [np.nonzero(reach == r)[0]]]
            self.passages = np.diff(np.append(self.firsts, len(owner)))
        self.empty = not group

    def similar(self, vectors: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether passage ``p`` is a candidate for any passage of item ``q`` (by its place in ``owned``)."""
        out = np.zeros(len(p), dtype=bool)
        for j in range(int(self.passages.max())):
            more = np.nonzero(~out & (self.passages[q] > j))[0]
            for at in range(0, len(more), 8192):
                k = more[at : at + 8192]
                out[k] = np.einsum("ij,ij->i", vectors[p[k]], self.vectors[self.firsts[q[k]] + j]) >= COSINE
        return out

    def may_hold(self, around: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether row ``p`` of ``around`` has enough of the bits of item ``q`` (by its place in ``owned``)."""
        out = np.zeros(len(p), dtype=bool)
        for at in range(0, len(p), 8192):
            k = slice(at, at + 8192)
            out[k] = np.bitwise_count(around[p[k]] & self.whole[q[k]]).sum(axis=1, dtype=np.int64) >= self.needed[q[k]]
        return out

    def may_align(self, present: np.ndarray, p: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether enough of each item's words stand, in whatever order, around row ``p`` of ``present``."""
        out = np.ones(len(p), dtype=bool)
        short = np.nonzero(self.length[item] <= SHORT)[0]
        for a in range(0, len(short), 8192):
            k = short[a : a + 8192]
            n = self.length[item[k]]
            first = np.cumsum(n) - n
            at = np.arange(n.sum()) + np.repeat(self.start[item[k]] - first, n)
            hits = present[np.repeat(p[k], n), self.terms[at]]
            out[k] = np.add.reduceat(hits, first, dtype=np.int64) / n >= PARAPHRASED
        return out

    def search(self, group: list[tuple[int, np.ndarray]], text_at) -> dict[int, dict]:
        """index -> {item id: ratio} for a group of (index, terms)."""
        found: dict[int, dict] = {}
        group = [g for g in group if len(g[1])]
        if self.empty or not group:
            return found
        vectors, doc, word = passages_of(group, self.table)
        rows, doc_of_row, _ = _padded(group)
        first, _ = _passages(doc_of_row)
        of_rows, fine_of_rows = (_over_words(bits, rows, np.bitwise_or) for bits in (self.wide, self.fine))
        words: dict[int, list[bytes]] = {}
        around, known = None, -1
        for reach, owners, whole, needed in self.by_reach:
            around = bits_around(of_rows, doc_of_row, first, reach, around, known)
            known = reach
            for at in range(0, len(doc), 1024):
                p, q = np.nonzero(_as_floats(around[at : at + 1024]) @ whole >= needed)
                q = owners[q]
                used, k = np.unique(p, return_inverse=True)
                held = self.may_hold(bits_around(fine_of_rows, doc_of_row, first[at + used], reach), k, q)
                p, q = p[held], q[held]
                near = self.similar(vectors[at : at + 1024], p, q)
                p, q = p[near], q[near]
                if not len(p):
                    continue
                used, k = np.unique(p, return_inverse=True)
                items = self.owned[q]
                may = self.may_align(present_around(rows, doc_of_row, first[at + used], reach), k, items)
                for p, item in zip((p[may] + at).tolist(), items[may].tolist()):
                    index = group[doc[p]][0]
                    if index not in words:
                        words[index] = words_of(text_at(index))
                    ratio = leak_ratio(self.words[item], self.places[item], words[index], int(word[p]))
                    if ratio:
                        mine = found.setdefault(index, {})
                        mine[self.ids[item]] = max(ratio, mine.get(self.ids[item], 0.0))
        return found


LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("ratio", T.DoubleType())]))
LEAKS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("ratio", pa.float64())]))


def find_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    leaks_col: str = "leaks",
) -> DataFrame:
    """``docs`` with ``leaks_col``: the benchmark items found in the text, each with the share of its words in order."""
    names = [c for c in docs.columns if c != leaks_col]

    @F.arrow_udf("binary")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([terms_of(hashes_of(words_of(t.as_py()))).tobytes() for t in texts], pa.binary())

    # a text is in a batch once, inside its row
    text_at = names.index(text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    out = saved(docs.select(row, hashed(F.col(f"`{text_col}`")).alias("terms")), "passage-terms")
    table = latent_table(out.select("terms"))
    out = out.select("row", "terms", F.array().cast(LEAKS).alias("leaks"))
    schema = out.schema

    def block_of(rows):
        def run(batches):
            items = Items(rows, table)
            for batch in batches:
                texts, leaks = batch.column("row").field(text_at), batch.column("leaks").to_pylist()
                for group in _grouped(batch.column("terms")):
                    for index, mine in items.search(group, lambda i: texts[i].as_py()).items():
                        leaks[index] = leaks[index] + [{"item_id": i, "ratio": r} for i, r in sorted(mine.items(), key=lambda x: (x[0] is None, x[0]))]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("terms"), pa.array(leaks, LEAKS_ARROW)], names=["row", "terms", "leaks"])

        return run

    rows: list[tuple] = []
    for r in benchmark.select(F.col(item_col).cast("long"), item_text).toLocalIterator():
        rows.append(tuple(r))
        if len(rows) == ITEMS_PER_BLOCK:
            out = out.mapInArrow(block_of(rows), schema)
            rows = []
    if rows:
        out = out.mapInArrow(block_of(rows), schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names], F.col("leaks").alias(leaks_col))
