"""Exact de-duplication against a history kept behind minimal perfect hashes.

Method: the distinct digests of the history are dealt into buckets of a few thousand keys;
each bucket gets a minimal perfect hash (bit arrays by level, keys that collide go on to the
next level, a key's slot is the rank of its bit). Slots hold full digests and the locator of
the row that stays. A new batch looks its distinct digests up: a slot's digest is compared
byte by byte, so a nonmember is never taken for a member; nonmembers form groups of their own.
There are buckets enough for the history's keys and for the batch's, whichever are more.

Digests are pre-aggregated before every shuffle, so a text that a third of all rows share is
one key. Nothing but the two numbers of distinct digests reaches the driver.

Defined results
  null text        equals the empty text
  null doc_id      sorts below all ids
  repeated rows    rows equal in id and text: exactly one of the largest id stays
  empty tables     an empty history makes every batch row a nonmember; no rows give no rows
  other columns    ignored by ``deduplicate``, which returns its own columns
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_of

INDEX_SCHEMA = "bucket long, sizes array<long>, levels array<binary>, digests array<binary>, winners array<long>, counts array<long>"
GROUP_SCHEMA = "digest binary, keep_id long, group_size long, in_history boolean"


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """A key's place at a level: one digest word, then stirred with the level's odd factor."""
    with np.errstate(over="ignore"):
        x = words[:, level % 4] * np.uint64(0x9E3779B97F4A7C15 + 2 * level)
        x ^= words[:, (level + 1) % 4] >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(digests: list[bytes], gamma: float = 1.5) -> tuple[list[np.ndarray], np.ndarray]:
    """(a bit array for each level, the slot of each key) for distinct 32-byte digests."""
    words, left = _words(digests), np.arange(len(digests))
    levels, slots, used = [], np.zeros(len(digests), dtype=np.int64), 0
    while len(left):
        size = max(8, int(gamma * len(left)))
        at = _place(words[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        rank = np.cumsum(alone) - 1
        slots[left[mine]] = used + rank[at[mine]]
        used += int(alone.sum())
        levels.append(alone)
        left = left[~mine]
    return levels, slots


def find_slots(words: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot of each key, -1 where no level has its bit. A nonmember may get some slot."""
    slots, left, used = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for k, bits in enumerate(levels):
        if not len(left):
            break
        at = _place(words[left], k, len(bits))
        hit = bits[at]
        slots[left[hit]] = used + (np.cumsum(bits) - 1)[at[hit]]
        used += int(bits.sum())
        left = left[~hit]
    return slots


def _build(t: pa.Table) -> pa.Table:
    digests = t.column("digest").to_pylist()
    levels, slots = build_hash(digests)
    order = np.argsort(slots)
    winners, counts = t.column("winner").to_pylist(), t.column("n").to_pylist()
    return pa.table(
        {
            "bucket": [t.column("bucket")[0].as_py()],
            "sizes": [[len(x) for x in levels]],
            "levels": [[np.packbits(x).tobytes() for x in levels]],
            "digests": [[digests[i] for i in order]],
            "winners": [[winners[i] for i in order]],
            "counts": [[counts[i] for i in order]],
        },
        schema=pa.schema(
            [
                ("bucket", pa.int64()),
                ("sizes", pa.list_(pa.int64())),
                ("levels", pa.list_(pa.binary())),
                ("digests", pa.list_(pa.binary())),
                ("winners", pa.list_(pa.int64())),
                ("counts", pa.list_(pa.int64())),
            ]
        ),
    )


def _merge(index: pa.Table, batch: pa.Table) -> pa.Table:
    """One bucket: history groups with what the batch adds, then the batch's own groups."""
    larger = lambda a, b: b if a is None else a if b is None else max(a, b)
    new_digests = batch.column("digest").to_pylist()
    new_ids, new_n = batch.column("winner").to_pylist(), batch.column("n").to_pylist()
    digests: list[bytes] = []
    ids: list[int | None] = []
    counts: list[int] = []
    known = np.zeros(len(new_digests), dtype=bool)
    if index.num_rows:
        row = index.slice(0, 1).to_pylist()[0]
        digests, ids, counts = row["digests"], row["winners"], row["counts"]
        if new_digests:
            levels = [np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool) for b, n in zip(row["levels"], row["sizes"])]
            for k, slot in enumerate(find_slots(_words(new_digests), levels)):
                if slot >= 0 and digests[slot] == new_digests[k]:
                    known[k] = True
                    ids[slot] = larger(ids[slot], new_ids[k])
                    counts[slot] += new_n[k]
    rest = [k for k in range(len(new_digests)) if not known[k]]
    return pa.table(
        {
            "digest": pa.array(digests + [new_digests[k] for k in rest], pa.binary()),
            "keep_id": pa.array(ids + [new_ids[k] for k in rest], pa.int64()),
            "group_size": pa.array(counts + [new_n[k] for k in rest], pa.int64()),
            "in_history": pa.array([True] * len(digests) + [False] * len(rest), pa.bool_()),
        }
    )


def _distinct(rows: DataFrame, name: str) -> DataFrame:
    return saved(rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.sum("copies").alias("n")), name)


def _dealt(distinct: DataFrame, buckets: int) -> DataFrame:
    return distinct.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))


def build_index(history: DataFrame, keys_per_bucket: int = 2000, batch_keys: int = 0) -> tuple[DataFrame, int]:
    """The index table over ``history`` (doc_id, digest, copies) and its number of buckets, enough for ``batch_keys`` too."""
    distinct = _distinct(history, "history-digests")
    buckets = max(1, -(-max(distinct.count(), batch_keys) // keys_per_bucket))
    return saved(_dealt(distinct, buckets).groupBy("bucket").applyInArrow(_build, INDEX_SCHEMA), "history-index"), buckets


def deduplicate(history: DataFrame, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of both inputs: doc_id, keep_id, group_size, kept, text_sha256, in_history (its text is in the history)."""

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(text_col), 256)).alias("digest"))

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"))

    old, new = saved(counted(rows(history)), "history-rows"), saved(counted(rows(batch)), "batch-rows")
    added = _distinct(new, "batch-digests")
    index, buckets = build_index(old, batch_keys=added.count())
    groups = index.groupBy("bucket").cogroup(_dealt(added, buckets).groupBy("bucket")).applyInArrow(_merge, GROUP_SCHEMA)
    every = old.unionByName(new).groupBy("doc_id", "digest").agg(F.sum("copies").alias("copies"))
    return (
        every.join(groups, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "in_history",
        )
    )
