r"""Prefix trie of conversations whose head is another conversation's, by composable fingerprints.

A run of turns has a fingerprint ``(length, sum of turn_i * B**i)`` modulo a prime, in four lanes;
``(m, s) . (n, t) = (m + n, s + B**m * t)`` is a monoid. A conversation's prefixes are found by one
distributed scan: turns are range-sorted, each task multiplies up its own stretch, and what the
tasks before it hold of the same conversation is composed in front, so a conversation may run over
many tasks. A rebuilt conversation is a product of a head of its base and its own tail
(``s(tail) = (s(whole) - s(head)) / B**len(head)``), so its prefixes follow from two stored ones
by arithmetic; rebuilt texts are never made. Prefixes with equal fingerprints are a node.

Equality is checked, not assumed. Each turn has a 128-bit key, and one pass over the stored turns
shows that no two different turns share a key. All prefixes of a node must then end with the same
key: the fingerprint without that turn is the parent's, so by induction all turns are equal. If
either check fails, all is done again with other keys and bases.

Sums over subtrees need no walk: a conversation is a member of all nodes above its end, so they
are sums over a node's members. What is to count once a node and not once a member counts for the
node's smallest member: a conversation owns the nodes from some depth down to its end.

Defined results
  null conv_id        such rows belong to no conversation and are left out
  null turn           before all others; equal turns of a conversation are ordered by role, then text
  null role or text   empty
  repeated rows       each is a turn
  very long texts     only their hash and number of words travel on
  empty table         no nodes, not even the root
  other columns       ignored
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, text_of

PRIME = (1 << 31) - 1
LANES = 4
#: Fixed value: a word of a turn's text.
WORD = r"[^\x20\x09-\x0D]+"
#: Ids of one node's ends are written out by ranges of this many ids.
END_RANGE = 1 << 14
NODE = ["depth", "f1", "f2"]
_G = [f"g{j}" for j in range(LANES)]


def bases(seed: int) -> list[int]:
    rng = np.random.default_rng(seed)
    return [int(b) for b in rng.integers(1 << 20, PRIME - 1, LANES)]


class Powers:
    """``base ** n`` modulo the prime for arrays of exponents: two digits of 16 bits, then the rest."""

    def __init__(self, base: int):
        self.base = base
        self.low = self._table(base)
        self.high = self._table(pow(base, 1 << 16, PRIME))

    @staticmethod
    def _table(base: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < 1 << 16:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
        return out

    def __call__(self, n: np.ndarray) -> np.ndarray:
        n = n.astype(np.int64)
        got = self.low[n & 0xFFFF]
        if len(n) and n.max() >= 1 << 16:
            got = got * self.high[(n >> 16) & 0xFFFF] % np.uint64(PRIME)
        return got


def lanes(k1: np.ndarray, k2: np.ndarray) -> list[np.ndarray]:
    """Four numbers below the prime from a 128-bit key."""
    a, b = k1.view(np.uint64), k2.view(np.uint64)
    low = np.uint64(PRIME)
    return [(x & low) % low for x in (a, a >> np.uint64(31), b, b >> np.uint64(31))]


def _scan(seed: int):
    """Place, and running products and words, of each turn in the task's stretch of its conversation."""

    def run(batches):
        powers = [Powers(b) for b in bases(seed)]
        part = TaskContext.get().partitionId()
        conv, n, g, w = None, 0, [0] * LANES, 0  # of the conversation that the last batch ended in
        names = ["part", "conv", "lpos", "k1", "k2", "words", "w", *_G]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, k1, k2, words = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            new = np.append(True, ids[1:] != ids[:-1])
            starts = np.nonzero(new)[0]
            group = np.cumsum(new) - 1
            goes_on = conv is not None and ids[0] == conv
            mine = (group == 0) if goes_on else np.zeros(len(ids), bool)
            lpos = np.arange(len(ids)) - starts[group] + np.where(mine, n, 0)

            def upto(x, before):
                c = np.cumsum(x)
                return c - (c - x)[starts][group] + np.where(mine, before, 0)

            sums = [(upto((t * p(lpos) % np.uint64(PRIME)).astype(np.int64), b) % PRIME) for t, p, b in zip(lanes(k1, k2), powers, g)]
            said = upto(words, w)
            conv, n, g, w = ids[-1], int(lpos[-1]) + 1, [int(s[-1]) for s in sums], int(said[-1])
            parts = np.full(len(ids), part, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (parts, ids, lpos, k1, k2, words, said, *sums)], names=names)

    return run


def _carried(scanned: DataFrame, seed: int) -> DataFrame:
    """For each task whose first conversation began in an earlier one: what is before it (one row a task)."""
    last = F.max(F.struct("conv", "lpos", "w", *_G)).alias("last")
    ends = scanned.groupBy("part").agg(F.min("conv").alias("first"), last).orderBy("part").collect()
    rows, conv, n, w, g = [], None, 0, 0, [0] * LANES
    for e in ends:
        powers = [pow(b, n, PRIME) for b in bases(seed)]
        if conv is None or e.first != conv:
            n, w, g, powers = 0, 0, [0] * LANES, [1] * LANES
        else:
            rows.append((e.part, e.first, n, w, *g, *powers))
        if e.last.conv != e.first:
            n, w, g, powers = 0, 0, [0] * LANES, [1] * LANES
        g = [(x + p * y) % PRIME for x, p, y in zip(g, powers, e.last[3:])]
        conv, n, w = e.last.conv, n + e.last.lpos + 1, w + e.last.w
    names = ["part", "conv", "c_n", "c_w", *[f"c_{x}" for x in _G], *[f"p_{x}" for x in _G]]
    return scanned.sparkSession.createDataFrame(rows, ", ".join(f"{c} long" for c in names))


def _keys(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(s), "role", "text").alias(k) for k, s in (("k1", seed), ("k2", ~seed))]


def turn_table(turns: DataFrame, seed: int) -> DataFrame:
    """``conv, pos, k1, k2, words``, and over the conversation up to this turn the words ``w`` and sums ``g0`` ..."""
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "row"]
    ranged = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{c} long" for c in ["part", "conv", "lpos", "k1", "k2", "words", "w", *_G])
    # counted after the sort: the sampling of the ranges would count them once more
    words = F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")
    scanned = saved(ranged.select("conv", *_keys(seed), words).mapInArrow(_scan(seed), schema), "turn-scan")
    joined = scanned.join(F.broadcast(_carried(scanned, seed)), ["part", "conv"], "left")
    zero = F.lit(0).cast("long")
    whole = [F.pmod(F.coalesce(f"c_{x}", zero) + F.coalesce(f"p_{x}", F.lit(1)) * F.col(x), F.lit(PRIME)).alias(x) for x in _G]
    return joined.select(
        "conv", (F.col("lpos") + F.coalesce("c_n", zero)).alias("pos"), "k1", "k2", "words", (F.col("w") + F.coalesce("c_w", zero)).alias("w"), *whole
    )


def _rebuilt(turns: DataFrame, base: Column, head: Column, max_head: int) -> DataFrame:
    """One row a conversation: how much of its base's head and of its own turns it has, and their products."""
    first = F.when(F.col("pos") < max_head, F.struct("pos", "k1", "k2", "words", "w", *_G))
    convs = saved(
        turns.groupBy("conv").agg(F.count("pos").alias("n"), F.sum("words").alias("total"), F.sort_array(F.collect_list(first)).alias("head")),
        "conversations",
    )
    mine = convs.withColumns({"base": base, "h": head})
    theirs = convs.select(F.col("conv").alias("base"), F.col("n").alias("b_n"), F.col("head").alias("b_head"))
    joined = mine.join(theirs, "base", "left").withColumn("m", F.least("h", F.coalesce("b_n", F.lit(0))).cast("int"))
    at_m, at_h = F.get("b_head", F.col("m") - 1), F.get("head", F.col("h").cast("int") - 1)

    def of(place, name):
        return F.coalesce(place[name], F.lit(0)).cast("long")

    return joined.select(
        "conv", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"), F.slice(F.coalesce("b_head", F.array()), 1, max_head).alias("b_head"),
        of(at_m, "w").alias("b_w"), of(at_h, "w").alias("o_w"),
        (of(at_m, "w") + F.when(F.col("n") > F.col("h"), F.col("total") - of(at_h, "w")).otherwise(0)).alias("total"),
        *[of(at_m, x).alias(f"b_{x}") for x in _G], *[of(at_h, x).alias(f"o_{x}") for x in _G],
    )


def _packed_lanes(lane: list[Column]) -> list[Column]:
    return [(F.shiftleft(lane[0], 31) + lane[1]).alias("f1"), (F.shiftleft(lane[2], 31) + lane[3]).alias("f2")]


def _prefixes(turns: DataFrame, rebuilt: DataFrame, seed: int, max_head: int) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: its node, its last turn's key, words and
    stored place, and the words from that turn to the conversation's end."""
    zero = F.lit(0).cast("long")
    heads = rebuilt.select("conv", "base", "length", "total", "b_head", F.explode(F.sequence(F.lit(0), F.col("m"))).alias("depth"))
    turn = F.get("b_head", F.col("depth") - 1)
    top = heads.select(
        "conv", "length", F.col("depth").cast("long").alias("depth"),
        *_packed_lanes([F.coalesce(turn[x], zero) for x in _G]),
        turn["k1"].alias("k1"), turn["k2"].alias("k2"), F.coalesce(turn["words"], zero).alias("words"),
        (F.col("total") - F.coalesce(turn["w"] - turn["words"], zero)).alias("from_here"),
        F.when(F.col("depth") > 0, F.col("base")).alias("ref_conv"), F.when(F.col("depth") > 0, F.col("depth") - 1).cast("long").alias("ref_pos"),
    )
    inverse = [[pow(pow(b, k, PRIME), PRIME - 2, PRIME) for k in range(max_head + 1)] for b in bases(seed)]
    back = F.col("h") - F.col("m")

    def lane(j, x):
        tail = F.pmod(F.col(x) - F.col(f"o_{x}"), F.lit(PRIME))
        shift = F.element_at(F.array(*[F.lit(v).cast("long") for v in inverse[j]]), (back + 1).cast("int"))
        return F.pmod(F.col(f"b_{x}") + shift * tail, F.lit(PRIME))

    own = turns.join(rebuilt.drop("base", "b_head"), "conv").where(F.col("pos") >= F.col("h"))
    said_before = F.col("b_w") + F.col("w") - F.col("words") - F.col("o_w")
    rest = own.select(
        "conv", "length", (F.col("pos") - F.col("h") + F.col("m") + 1).alias("depth"), *_packed_lanes([lane(j, x) for j, x in enumerate(_G)]),
        "k1", "k2", "words", (F.col("total") - said_before).alias("from_here"), F.col("conv").alias("ref_conv"), F.col("pos").alias("ref_pos"),
    )
    return top.unionByName(rest)


def _ends_digest(prefixes: DataFrame) -> DataFrame:
    """``depth, f1, f2, ends_sha256``: the ids of the conversations that end in a node, ascending.

    Ids are joined by ranges in many tasks; only the hash itself, which has to run over a node's
    ids in order, takes a node's joined ranges one after another."""
    ends = prefixes.where(F.col("depth") == F.col("length"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    ranges = ends.groupBy(*NODE, F.floor(F.col("conv") / END_RANGE).alias("range")).agg(text.alias("ids"))

    def run(batches):
        node, sha = None, None
        schema = pa.schema([("depth", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("ends_sha256", pa.string())])

        def out(done):
            return pa.RecordBatch.from_arrays([*[pa.array([k[j] for k, _ in done], pa.int64()) for j in range(3)], pa.array([v for _, v in done], pa.string())], schema=schema)

        for batch in batches:
            done = []
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node is not None:
                        done.append((node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield out(done)
        if node is not None:
            yield out([(node, sha.hexdigest())])

    ordered = ranges.repartition(*NODE).sortWithinPartitions(*NODE, "range").select(*NODE, "ids")
    return ordered.mapInArrow(run, "depth long, f1 long, f2 long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, base: Column | None = None, head: Column | None = None, max_head: int = 3,
    id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", seed: int = 0,
) -> DataFrame:
    """One row a node of the trie of all rebuilt conversations.

    ``base`` and ``head`` are columns over ``conv``: whose first turns, and how many of them (at
    most ``max_head``), stand in for the conversation's own; by default none. Returns ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and ``ref_conv`` and ``ref_pos``: where the node's last turn is stored.
    """
    base = F.col("conv") if base is None else base
    head = F.lit(0).cast("long") if head is None else head
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")
    )
    for attempt in count(seed):
        stored = turn_table(turns, attempt)
        prefixes = saved(_prefixes(stored, _rebuilt(stored, base, head, max_head), attempt, max_head), "prefixes")
        nodes = saved(
            prefixes.groupBy(*NODE).agg(
                F.min("conv").alias("owner"), F.count("conv").alias("n_convs"), F.max("words").alias("words"), F.sum("from_here").alias("said"), F.max("length").alias("longest"),
                *[f(k).alias(f"{f.__name__}_{k}") for k in ("k1", "k2") for f in (F.min, F.max)],
            ),
            "trie-nodes",
        )
        unequal = nodes.where((F.col("min_k1") != F.col("max_k1")) | (F.col("min_k2") != F.col("max_k2")))
        shared = turns.select(*_keys(attempt), "role", "text").groupBy("k1", "k2", "role", "text").agg(F.lit(1).alias("one")).groupBy("k1", "k2").agg(F.count("one").alias("n")).where("n > 1")
        if unequal.isEmpty() and shared.isEmpty():
            return _trie(prefixes, nodes)


def _trie(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    owned = nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("words").alias("own_words"),
        F.max((F.col("depth") == F.col("longest")).cast("int")).alias("leaf"),
    )
    members = saved(
        prefixes.join(owned, "conv").select(
            "conv", *NODE, "top", "leaf", "ref_conv", "ref_pos",
            F.col("depth").between(F.col("top") - 1, F.col("bottom") - 1).cast("int").alias("child"),
            F.when(F.col("depth") >= F.col("top"), F.col("from_here")).otherwise(F.col("own_words")).alias("own_words"),
        ),
        "trie-members",
    )
    sums = members.groupBy(*NODE).agg(F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("own_words").alias("once"))
    # the owner's parent changes where its own part of the trie begins; further down it is the owner itself
    above = members.where(F.col("depth") == F.col("top") - 1).select("conv", *NODE).join(nodes.select(*NODE, F.col("owner").alias("parent")), NODE)
    refs = members.where(F.col("depth") >= F.col("top")).select("conv", "depth", "ref_conv", "ref_pos", "top")
    placed = refs.join(above.select("conv", "parent"), "conv", "left").select(
        F.col("conv").alias("owner"), "depth", "ref_conv", "ref_pos",
        F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"),
    )
    return (
        nodes.join(sums, NODE).join(_ends_digest(prefixes), NODE, "left").join(placed, ["owner", "depth"])
        .select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("said") - F.col("once")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "ref_conv", "ref_pos",
        )
    )
