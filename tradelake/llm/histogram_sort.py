r"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a key: the first 60 bits of the text's md5, the id, and a row number. Equal
texts are neighbours and the order is otherwise random. The splitters between shards are found
without sorting: candidate keys (probes) are drawn from the rows between the two probes around
each target, and the exact bytes and rows below every probe are counted across all partitions,
until each splitter is within ``tolerance`` of its target or is the nearest key there is. Then
the rows are exchanged once, straight to their place.

The same rounds find looser cuts inside the shards, so that a task sorts about ``task_bytes``
and not a whole shard. Rows below a cut are counted with the bytes, so each row's slot in its
shard follows from its place in its piece.

Defined results
  null or empty text    no bytes; the row's own cost (``row_bytes``) counts
  null id               smaller than every id
  repeated rows         each has its own place; a splitter may lie between them
  ties                  of two keys equally near a target the smaller is the splitter
  very long texts       a row longer than a shard makes a larger shard; shards beside it may be empty
  empty table           empty result
  other columns         passed through; ``shard`` and ``slot`` replace columns of that name
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, saved, text_of, unpacked

KEY = ("h", "i", "r")
_KEY_TYPE = "h long, i long, r long"
#: Probes drawn in a round for each target that wants the nearest cut, and for each looser one;
#: a bracket of few rows is probed at every row.
PROBES, LOOSE_PROBES = 24, 4
_LOWEST = -(1 << 63)


def key_bytes(*columns: np.ndarray) -> np.ndarray:
    """Three signed 64-bit columns as one 24-byte string each, in the same order."""
    words = np.stack([c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns], axis=1)
    return np.ascontiguousarray(words.astype(">u8")).view("S24").reshape(-1)


class Probes:
    """Sorted keys, and for each row how many of them are at or below its key."""

    def __init__(self, keys: list[tuple[int, int, int]]):
        columns = np.array(sorted(keys), dtype=np.int64).reshape(-1, 3).T
        self.first, self.whole = columns[0].copy(), key_bytes(*columns)

    def places(self, h: np.ndarray, i: np.ndarray, r: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, h, "right")
        close = np.nonzero(np.searchsorted(self.first, h, "left") < at)[0]  # only these need the rest of the key
        if len(close):
            at[close] = np.searchsorted(self.whole, key_bytes(h[close], i[close], r[close]), "right")
        return at


def _columns(batch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def histogram(keys: DataFrame, probes: Probes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows between neighbouring probes (before the first, ..., from the last on)."""
    n = len(probes.whole) + 1

    def run(batches):
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            *key, b = _columns(batch)
            at = probes.places(*key)
            rows += np.bincount(at, minlength=n)
            np.add.at(size, at, b)
        hit = np.nonzero(rows)[0]
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(size[hit]), pa.array(rows[hit])], names=["at", "bytes", "rows"])

    counted = keys.select(*KEY, "bytes").mapInArrow(run, "at long, bytes long, rows long")
    size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for row in counted.groupBy("at").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("n")).collect():  # one a probe
        size[row["at"]], rows[row["at"]] = row.b, row.n
    return size, rows


def draw(keys: DataFrame, probes: Probes, share: np.ndarray, turn: int) -> list[tuple[int, int, int]]:
    """Keys drawn at random (by hash) from between the probes; ``share`` is each interval's rate."""

    def run(batches):
        for batch in batches:
            *key, lot = _columns(batch)
            at = probes.places(*key)
            chosen = (lot.astype(np.uint64) >> np.uint64(11)) / float(1 << 53) < share[at]
            yield pa.RecordBatch.from_arrays([pa.array(c[chosen]) for c in key], names=list(KEY))

    lot = F.shiftrightunsigned(F.xxhash64(F.lit(turn), *KEY), 0)
    found = keys.select(*KEY, lot.alias("lot")).mapInArrow(run, _KEY_TYPE)
    return [tuple(r) for r in found.collect()]  # a few for each open target


class Cut:
    """A splitter: the smallest key to its right, and the bytes and rows to its left."""

    def __init__(self, key, size: int, rows: int):
        self.key, self.size, self.rows = key, size, rows


def splitters(keys: DataFrame, targets: list[float], slack: list[float]) -> list[Cut]:
    """For each target (in bytes, ascending) the cut nearest to it, or one within its slack."""
    total, rows = keys.agg(F.sum("bytes"), F.count("*")).first()
    total, rows = int(total or 0), int(rows)
    lowest, end = Cut((_LOWEST,) * 3, 0, 0), Cut(None, total, rows)
    # the two known cuts around each target
    around: list[tuple[Cut, Cut]] = [(lowest, end) for _ in targets]
    turn = 0
    while True:
        open_ = [
            (a, PROBES if s < 0.01 * total / (len(targets) + 1) else LOOSE_PROBES) for (a, b), t, s in zip(around, targets, slack)
            if b.rows - a.rows > 1 and min(t - a.size, b.size - t) > s
        ]
        if not open_:
            break
        known = sorted({c.key: c for pair in around for c in pair if c.key is not None}.values(), key=lambda c: c.key)
        probes = Probes([c.key for c in known])
        wanted: dict = {}
        for a, n in open_:
            wanted[a.key] = wanted.get(a.key, 0) + n
        share = np.zeros(len(known) + 1)
        for k, c in enumerate(known):
            if c.key in wanted:
                inside = (known[k + 1].rows if k + 1 < len(known) else rows) - c.rows
                share[k + 1] = 1.0 if inside <= 2 * wanted[c.key] else wanted[c.key] / inside
        drawn = draw(keys, probes, share, turn)
        turn += 1
        grid = sorted({c.key for c in known}.union(drawn))
        size, count = histogram(keys, Probes(grid))
        below, upto = np.cumsum(size), np.cumsum(count)
        cuts = [Cut(k, int(below[j]), int(upto[j])) for j, k in enumerate(grid)] + [end]
        sizes = np.array([c.size for c in cuts])
        for j, t in enumerate(targets):
            right = min(int(np.searchsorted(sizes, t, "left")), len(cuts) - 1)
            left = max(right - 1, 0)
            around[j] = (cuts[left], cuts[right])
    return [a if t - a.size <= b.size - t else b for (a, b), t in zip(around, targets)]


def shard_documents(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
    row_bytes: int = 16, tolerance: float = 0.0, task_bytes: int = 64 << 20, max_pieces: int = 16_384,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``n_shards`` - 1, neighbours in key order) and ``slot`` (from 0 in each shard).

    Splitters are within ``tolerance`` times a shard's even share of their targets; 0 asks for the
    nearest cut there is, which makes the shards a function of the rows alone. ``task_bytes`` and
    ``max_pieces`` decide how many tasks sort a shard, not what is in it.
    """
    size = F.octet_length(text_of(text_col)).cast("long") + row_bytes
    digest = F.conv(F.substring(F.md5(text_of(text_col)), 1, 15), 16, 10).cast("long")
    rows = saved(
        packed(
            docs, digest.alias("h"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("i"),
            F.monotonically_increasing_id().alias("r"), size.alias("bytes"),
        ),
        "shard-rows",
    )
    keys = rows.select(*KEY, "bytes")
    total = int(keys.agg(F.sum("bytes")).first()[0] or 0)
    even = total / n_shards
    inner = int(max(1, min(-(-even // task_bytes), max_pieces // n_shards)))
    targets = [total * (j + 1) / (n_shards * inner) for j in range(n_shards * inner - 1)]
    slack = [tolerance * even if (j + 1) % inner == 0 else 0.05 * even / inner for j in range(len(targets))]
    cuts = splitters(keys, targets, slack)

    # A piece runs from one cut to the next. Cuts are in order; equal ones leave a piece empty.
    starts = [Cut((_LOWEST,) * 3, 0, 0), *cuts]
    bounds = [c.key for c in cuts if c.key is not None]  # None: nothing lies to the right
    finder = Probes(bounds) if bounds else None

    ahead = np.array([s.rows - starts[k - k % inner].rows for k, s in enumerate(starts)])

    def places(*key: pa.Array) -> np.ndarray:
        return finder.places(*map(np.asarray, key)) if finder else np.zeros(len(key[0]), np.int64)

    @F.arrow_udf("int")
    def piece_of(h: pa.Array, i: pa.Array, r: pa.Array) -> pa.Array:
        return pa.array(places(h, i, r).astype(np.int32))

    @F.arrow_udf("long")
    def ahead_of(h: pa.Array, i: pa.Array, r: pa.Array) -> pa.Array:
        """Rows of the shard before the row's piece."""
        return pa.array(ahead[places(h, i, r)])

    pieces = rows.withColumns({"piece": piece_of(*KEY), "ahead": ahead_of(*KEY)}).repartitionById(len(starts), F.col("piece"))
    order = F.row_number().over(Window.partitionBy("piece").orderBy(*KEY))
    placed = pieces.withColumn("slot", F.col("ahead") + order - 1)
    return unpacked(placed, docs.columns, shard=F.floor(F.col("piece") / inner).cast("int"), slot=F.col("slot"))


def write_shards(shards: DataFrame, path: str) -> None:
    """A folder for each shard, its files in key order as the tasks have them; no further exchange."""
    shards.write.partitionBy("shard").parquet(path)
