"""Packing along a space-filling curve.

Method: every document's token ids are hashed into a signed vector, projected to a few
dimensions by a fixed random matrix, and scaled by means and deviations over all documents;
the cell of that point has a Hilbert key. Documents are range-sorted by key, so neighbours on
the curve share sequences, and each range is laid end to end into sequences of ``length`` ids.
What is left at the end of a range is cut at powers of two, so no sequence has padding. Ranges
end at (key, id), so copies that share a key do not share one task. The ends are found once, by
exact counts of id bytes below them, so whatever runs on the result sees the same pieces.

Defined results
  null or empty text   only the end id, one piece
  null doc_id          sorts first among equal keys
  repeated rows        packed once each; rows of one id in the order of their ids' bytes
  empty table          no pieces
  other columns        ignored
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_of
from .histogram_sort import KEY, Probes, splitters
from .tokens import encoded, encoder

DIMS, BITS, HASHED = 3, 10, 512
_LOWEST = -(1 << 63)
IDS_SCHEMA = "doc_id long, n int, ids binary, point array<float>"
IDS_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("point", pa.list_(pa.float32()))])
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
PIECE_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def projection(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(HASHED, DIMS))


def point(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The projected unit vector of one document's ids."""
    stirred = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sign = np.where(stirred >> np.uint64(63), 1.0, -1.0)
    vector = np.bincount((stirred >> np.uint64(40)).astype(np.int64) % HASHED, weights=sign, minlength=HASHED)
    vector = np.sign(vector) * np.sqrt(np.abs(vector))
    return (vector / max(1e-9, float(np.linalg.norm(vector)))) @ matrix


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of integer cells (n, dims): undo excess rotations from the top bit down, then Gray-decode."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(flip, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _cells(points: np.ndarray, means: list[float], deviations: list[float]) -> np.ndarray:
    """Normal scores to equal-mass cells."""
    z = (points - np.array(means)) / np.array(deviations)
    uniform = 0.5 * (1 + np.tanh(0.7978845608 * (z + 0.044715 * z**3)))
    return np.clip((uniform * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


def _cut(sizes: list[int], length: int) -> list[int]:
    """Lengths of the sequences for what is left: the powers of two in its size, largest first."""
    left = sum(sizes)
    return [1 << b for b in range(int(math.log2(length)) + 1, -1, -1) if left >> b & 1]


def pack_documents(
    docs: DataFrame, tokenizer: str, spaces: str, end_id: int, length: int = 2048, id_col: str = "doc_id", text_col: str = "text",
    range_bytes: int = 8 << 20, max_ranges: int = 16_384,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned 32-bit little-endian), doc_tokens, sequence_id, offset.

    ``range_bytes`` of ids make a range, and more where there would be over ``max_ranges`` of them.
    """
    matrix = projection()

    def ids_of(batches):
        enc = encoder(tokenizer, spaces)
        texts = ((i.as_py(), t.as_py()) for b in batches for i, t in zip(b.column("doc_id"), b.column("text")))
        rows = []
        for doc_id, ids in encoded(texts, enc, end_id):
            small = int(ids.max()) < 1 << 16  # the width in bytes is the buffer's size by n
            rows.append({"doc_id": doc_id, "n": len(ids), "ids": ids.astype("<u2" if small else "<u4").tobytes(), "point": point(ids, matrix)})
            if len(rows) == 500:
                yield pa.RecordBatch.from_pylist(rows, schema=IDS_ARROW)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=IDS_ARROW)

    work = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    tokens = saved(work.mapInArrow(ids_of, IDS_SCHEMA), "packing-ids")
    dims = [F.col("point")[i] for i in range(DIMS)]
    stats = tokens.agg(*[F.avg(d) for d in dims], *[F.stddev_pop(d) for d in dims]).first()
    means, deviations = [x or 0.0 for x in stats[:DIMS]], [x or 1.0 for x in stats[DIMS:]]

    def keys(points: pa.Array) -> np.ndarray:
        return hilbert_key(_cells(np.asarray(points.flatten()).reshape(-1, DIMS), means, deviations))

    @F.arrow_udf("long")
    def key_of(points: pa.Array) -> pa.Array:
        return pa.array(keys(points), pa.int64())

    rest = ["doc_id", "n", "ids", F.coalesce("doc_id", F.lit(_LOWEST)).alias("i"), F.lit(0).cast("long").alias("r")]
    keyed = tokens.select(*rest, key_of("point").alias("h"))
    weights = saved(keyed.select(*KEY, F.octet_length("ids").cast("long").alias("bytes")), "packing-keys")
    total = int(weights.agg(F.sum("bytes")).first()[0] or 0)
    ranges = max(1, min(-(-total // range_bytes), max_ranges))
    cuts = splitters(weights, [total * (k + 1) / ranges for k in range(ranges - 1)], [0.1 * total / ranges] * (ranges - 1))
    bounds = sorted({c.key for c in cuts if c.key is not None})
    finder = Probes(bounds) if bounds else None

    @F.arrow_udf("int")
    def range_of(points: pa.Array, i: pa.Array, r: pa.Array) -> pa.Array:
        return pa.array((finder.places(keys(points), np.asarray(i), np.asarray(r)) if finder else np.zeros(len(i))).astype(np.int32))

    def pack(batches):
        piece = done = fill = 0  # range, full sequences of it so far, ids in the open one
        open_pieces: list[tuple] = []  # doc_id, start, ids, doc_tokens
        rows: list[dict] = []

        def close(pieces, number):
            at = 0
            for doc_id, start, ids, n in pieces:
                rows.append(
                    {"doc_id": doc_id, "start": start, "length": len(ids), "ids": ids.astype("<u4").tobytes(), "doc_tokens": n, "sequence_id": (piece << 36) + number, "offset": at}
                )
                at += len(ids)

        def split(pieces, first_size):
            head, size = [], 0
            while size < first_size:
                doc_id, start, ids, n = pieces.pop(0)
                take = min(len(ids), first_size - size)
                head.append((doc_id, start, ids[:take], n))
                size += take
                if take < len(ids):
                    pieces.insert(0, (doc_id, start + take, ids[take:], n))
            return head

        def end_range():
            for number, size in enumerate(_cut([len(p[2]) for p in open_pieces], length), done):
                close(split(open_pieces, size), number)

        for batch in batches:
            for doc_id, n, data, place in zip(*(batch.column(c) for c in ("doc_id", "n", "ids", "piece"))):
                doc_id, n, data, place = doc_id.as_py(), n.as_py(), data.as_py(), place.as_py()
                if place != piece:
                    end_range()
                    piece, done, fill, open_pieces = place, 0, 0, []
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")
                start = 0
                while start < n:
                    take = min(n - start, length - fill)
                    open_pieces.append((doc_id, start, ids[start : start + take], n))
                    start, fill = start + take, fill + take
                    if fill == length:
                        close(open_pieces, done)
                        done, fill, open_pieces = done + 1, 0, []
                if len(rows) >= 500:
                    yield pa.RecordBatch.from_pylist(rows, schema=PIECE_ARROW)
                    rows.clear()
        end_range()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=PIECE_ARROW)

    # the range from the point, not from its key: so one Python worker a task works out both, not two after each other
    placed = tokens.select(*rest, "point").select("*", key_of("point").alias("h"), range_of("point", "i", "r").alias("piece"))
    dealt = placed.repartitionById(len(bounds) + 1, F.col("piece"))
    ordered = dealt.sortWithinPartitions("piece", "h", "i", "ids").select("doc_id", "n", "ids", "piece")
    return ordered.mapInArrow(pack, PIECE_SCHEMA)
