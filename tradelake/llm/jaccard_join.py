"""Exact similarity join of documents on word shingles, by parity sketches.

Method. A document's shingle hashes are XORed into the cells of a sketch; a shingle flips one
cell, so the number of cells in which two sketches differ never exceeds the size of the
symmetric difference of the sets. For a similarity of at least t that is at most
``(a + b) (1 - t) / (1 + t)`` for set sizes a and b. Documents are dealt into bands by set
size; sketches of a band have the same number of cells, several a document's worth, and a
document also joins the band below when a partner may lie there. By the pigeonhole principle
two linked documents agree in one of the first ``d + 1`` non-empty cells in any common order,
with d the most cells that may differ; cells of rare shingles (by a fixed-size count over all
documents) and of several shingles come first. Candidates are pairs with an equal cell; a 1024-bit parity sketch (one bit
flipped for each shingle, Hamming distance again a lower bound) discards most false ones, and
the rest are verified on whole sets.

No group is expanded into all its pairs. Equal sets are one class, represented by its smallest
id. Within a group of equal cells every member is paired with the group's first member; of these
pairs each document's nearest by sketch is verified first, then those that still lie across
components. Of groups that span several components after that, members outside the group's largest
component are compared with all members, in blocks of bounded size, and only across components.

Defined results
  null or empty text, no words   no shingles, own component, linked with nothing
  null doc_id      carries no links; its component is that of the rows with the same set, else null
  repeated rows    rows of one id are one document
  ties             none: a component is named by its smallest id
  empty table      empty result
  other columns    ignored by ``similar_documents``, passed through by ``keep_one_of_each``
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, saved
from .graph import components
from .shingles import mix, shingle_set

#: Slots of the shingle count, bits of the pair filter, bits of the candidate filter: fixed sizes.
COUNT_BITS, SKETCH_BITS, BLOOM_BITS = 20, 1024, 24
#: Set sizes of a band lie within this ratio; bands below SMALL shingles have a cell for nearly each one.
RATIO, SMALL, SMALL_CELLS = 4, 16, 1 << 16
PIECES = 16
BLOCK_ROWS = 2000
#: Open groups by which a pair's repeats are known.
HOMES = 8
HELD_ROWS = 300_000

FIRST_SCHEMA = "doc_id long, n long, h1 long, h2 long, sketch array<long>, piece int, data binary"
FIRST_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("sketch", pa.list_(pa.int64())),
        ("piece", pa.int32()),
        ("data", pa.binary()),
    ]
)
PIECE_SCHEMA = "piece int, data binary"


def most_different(n: int, percent: int) -> int:
    """The largest symmetric difference of a set of n with any partner of at least this similarity."""
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


def _band(n: int) -> int:
    k = 0
    while RATIO ** (k + 1) <= n:
        k += 1
    return k


def bands(n: int, percent: int) -> list[int]:
    """A document's own band, and the one below if its smallest possible partner lies there."""
    own = _band(n)
    least = -(-n * percent // 100)
    return [own] if _band(max(1, least)) == own else [own, own - 1]


def cells_of(band: int, percent: int) -> int:
    """Cells of a band's sketches: at most two shingles a cell for the largest member."""
    top = RATIO ** (band + 1) * 100 // percent
    return SMALL_CELLS if top <= 2 * SMALL else top // 2


def cell_keys(shingles: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The keys by which a document meets its candidates. ``shingles`` sorted, ``classes``: how common each slot is."""
    n = len(shingles)
    keep = most_different(n, percent) + 1
    out = []
    common = classes[shingles >> np.uint64(64 - COUNT_BITS)].astype(np.uint64)
    for band in bands(n, percent):
        cells = cells_of(band, percent)
        cell = ((shingles >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
        first = np.concatenate([[0], np.nonzero(cell[1:] != cell[:-1])[0] + 1])
        values = np.bitwise_xor.reduceat(shingles, first)
        several = np.minimum(np.diff(np.append(first, n)), 4).astype(np.uint64) - np.uint64(1)
        rare = np.minimum.reduceat(common, first) + np.uint64(6) - np.uint64(2) * several
        with np.errstate(over="ignore"):
            keys = mix(values + mix(cell[first] + np.uint64(band << 40)))
        if len(keys) < keep:  # too many empty cells for the principle: such documents of a band all meet
            keys = np.append(keys, mix(np.array([(band << 40) + (1 << 39)], dtype=np.uint64)))
            rare = np.append(rare, np.uint64(0))
        order = (rare << np.uint64(56)) | (keys >> np.uint64(8))
        out.append(keys[np.argsort(order, kind="stable")[:keep]])
    return np.concatenate(out)


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """One bit flipped for each shingle."""
    flips = np.bincount((mix(shingles) >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).view("<i8")


def _texts(batches):
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            yield doc_id.as_py(), text.as_py()


def _merge_pieces(df: DataFrame, combine: Callable, dtype: str) -> np.ndarray:
    """The whole of a fixed-size array, combined piece by piece over all tasks."""

    def one(t: pa.Table) -> pa.Table:
        total = np.frombuffer(t.column("data")[0].as_py(), dtype).copy()
        for other in t.column("data")[1:]:
            total = combine(total, np.frombuffer(other.as_py(), dtype))
        return pa.table({"piece": t.column("piece")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    rows = df.select("piece", "data").groupBy("piece").applyInArrow(one, PIECE_SCHEMA).collect()
    return np.concatenate([np.frombuffer(r.data, dtype) for r in sorted(rows, key=lambda r: r.piece)]) if rows else np.zeros(0, dtype)


def _first_pass(work: DataFrame, size: int) -> DataFrame:
    """A row per document, and at the end of a task its shingle counts."""

    def run(batches):
        counts = np.zeros(1 << COUNT_BITS, dtype=np.uint32)
        slots: list[np.ndarray] = []
        held = 0
        rows: list[dict] = []
        for doc_id, text in _texts(batches):
            s = shingle_set(text, size)
            row = {"doc_id": doc_id, "n": len(s)}
            if len(s):
                with np.errstate(over="ignore"):
                    row["h1"], row["h2"] = (int(x) for x in np.array([mix(s).sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()]).view(np.int64))
                row["sketch"] = bit_sketch(s)
                slots.append((s >> np.uint64(64 - COUNT_BITS)).astype(np.int64))
                held += len(s)
            rows.append(row)
            if held > 2_000_000:
                counts += np.bincount(np.concatenate(slots), minlength=len(counts)).astype(np.uint32)
                slots, held = [], 0
            if len(rows) == 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=FIRST_ARROW)
                rows = []
        if held:
            counts += np.bincount(np.concatenate(slots), minlength=len(counts)).astype(np.uint32)
        rows += [{"piece": k, "data": x.tobytes()} for k, x in enumerate(np.split(counts, PIECES))]
        yield pa.RecordBatch.from_pylist(rows, schema=FIRST_ARROW)

    return saved(work.mapInArrow(run, FIRST_SCHEMA), "shingle-sets")


def _keys(work: DataFrame, classes: np.ndarray, size: int, percent: int) -> DataFrame:
    """(key, doc_id); of equal sets in a task only the first gives keys."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])

    def run(batches):
        seen: set[tuple[int, int]] = set()
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids))], schema=schema)

        for doc_id, text in _texts(batches):
            s = shingle_set(text, size)
            if doc_id is None or not len(s):
                continue
            with np.errstate(over="ignore"):
                name = (int(s.sum()), int(mix(s).sum()))
            if name in seen:
                continue
            seen.add(name)
            keys.append(cell_keys(s, classes, percent))
            ids.append(np.full(len(keys[-1]), doc_id, dtype=np.int64))
            held += len(keys[-1])
            if held > 50_000:
                yield out()
                keys, ids, held = [], [], 0
        if keys:
            yield out()

    return work.mapInArrow(run, "key long, doc_id long")


def _members(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of groups with several distinct ids, sorted by (key, id), without repeats."""
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]))[: len(key)]
    key, ids = key[fresh], ids[fresh]
    same = key[1:] == key[:-1]
    wide = np.append(same, False)[: len(key)] | np.append(False, same)[: len(key)]
    return key[wide], ids[wide]


def _groups(keys: DataFrame) -> DataFrame:
    """Rows (kind, key, a, b): kind 0, first member a with another member b; kind 1, member a of a group of three or more.

    Rows come sorted by key; a task holds some hundred thousand rows at a time, and of a longer group only its first member.
    """
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    held_rows, most_seen = HELD_ROWS, 500_000

    def run(batches):
        seen: set = set()

        def out(key: np.ndarray, ids: np.ndarray, lead: tuple[int, int] | None):
            """Of whole groups; ``lead``: key and first member of a group whose earlier rows are out already."""
            if lead is not None:  # as if the first member came again
                key, ids = np.append(lead[0], key), np.append(lead[1], ids)
            key, ids = _members(key, ids)
            if not len(key):
                return None
            first = np.append(True, key[1:] != key[:-1])
            start = np.nonzero(first)[0]
            size = np.diff(np.append(start, len(key)))
            leads = ids[np.repeat(start, size)]
            if lead is not None:
                leads[key == lead[0]] = lead[1]
            pairs = np.stack([leads, ids], axis=1)[leads != ids]
            pairs = np.unique(pairs, axis=0)
            fresh = [p for p in map(tuple, pairs.tolist()) if p not in seen]
            if len(seen) > most_seen:
                seen.clear()
            seen.update(fresh)
            # groups of the same members are one
            with np.errstate(over="ignore"):
                name = mix(np.add.reduceat(mix(ids.view(np.uint64)), start) + size.astype(np.uint64)).view(np.int64)
            large = size > 2
            if lead is not None:
                ours = key[start] == lead[0]
                large |= ours
                name[ours] = lead[0]
            kept = []
            for g in np.nonzero(large)[0].tolist():
                if name[g] == key[start[g]] or int(name[g]) not in seen:
                    seen.add(int(name[g]))
                    kept.append(g)
            rows = np.concatenate([np.arange(start[g], start[g] + size[g]) for g in kept]) if kept else np.zeros(0, np.int64)
            names = np.concatenate([np.full(size[g], name[g]) for g in kept]) if kept else np.zeros(0, np.int64)
            n, m = len(fresh), len(rows)
            ab = np.array(fresh, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([0, 1], np.int32), [n, m])),
                    pa.array(np.concatenate([np.zeros(n, np.int64), names])),
                    pa.array(np.concatenate([ab[:, 0], ids[rows]])),
                    pa.array(np.concatenate([ab[:, 1], np.zeros(m, np.int64)])),
                ],
                schema=schema,
            )

        key, ids, lead = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def cut(last: bool):
            """Give out what is held, but for the open group; of one that fills all, all but its first member."""
            nonlocal key, ids, lead, parts, held
            key = np.concatenate([key, *[k for k, _ in parts]])
            ids = np.concatenate([ids, *[i for _, i in parts]])
            parts, held = [], 0
            end = len(key) if last or not len(key) else int(np.searchsorted(key, key[-1]))
            if lead is not None and len(key) and key[0] != lead[0]:
                lead = None
            begun = None
            if end == 0 and len(key):  # one long group
                begun, end = lead or (int(key[0]), int(ids[0])), len(key)
            done = out(key[:end], ids[:end], lead or begun)
            key, ids = key[end:], ids[end:]
            lead = begun
            return done

        for batch in batches:
            parts.append((batch.column("key").to_numpy(), batch.column("doc_id").to_numpy()))
            held += batch.num_rows
            if held > held_rows:
                if (done := cut(False)) is not None:
                    yield done
        if (done := cut(True)) is not None:
            yield done

    dealt = keys.repartition("key").sortWithinPartitions("key", "doc_id")
    return saved(dealt.mapInArrow(run, "kind int, key long, a long, b long"), "cell-groups")


def _near(pairs: DataFrame, percent: int) -> DataFrame:
    """Of (a, b, na, nb, sa, sb) the pairs that sizes and bit sketches allow, with their distance."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    distance = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    far = pairs.where(small * 100 >= large * percent).select("a", "b", (F.col("na") + F.col("nb")).alias("size"), distance.alias("distance"))
    return far.where(F.col("distance") * (100 + percent) <= F.col("size") * (100 - percent)).select("a", "b", "distance")


def _sets(work: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, data): 48 bits of each shingle for all ``wanted`` ids, and for what else a fixed-size filter lets through."""

    def fill(batches):
        bits = np.zeros(1 << BLOOM_BITS, dtype=bool)
        for batch in batches:
            bits[_bloom(batch.column("doc_id").to_numpy())] = True
        for k, x in enumerate(np.split(np.packbits(bits), PIECES)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["piece", "data"])

    few = wanted.repartition(4)  # each task sends the whole filter
    merged = _merge_pieces(few.mapInArrow(fill, PIECE_SCHEMA), np.bitwise_or, "u1")

    def run(batches):
        bits = np.unpackbits(merged).astype(bool) if len(merged) else np.zeros(1 << BLOOM_BITS, dtype=bool)
        rows = []
        schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])
        for doc_id, text in _texts(batches):
            if doc_id is not None and bits[_bloom(np.array([doc_id]))].all():
                rows.append({"doc_id": doc_id, "data": short(shingle_set(text, size))})
                if len(rows) == 200:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return saved(work.mapInArrow(run, "doc_id long, data binary"), "candidate-sets")


def _bloom(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = mix(ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    places = np.stack([x >> np.uint64(64 - BLOOM_BITS), (x >> np.uint64(16)) & np.uint64((1 << BLOOM_BITS) - 1)])
    return places.astype(np.int64).ravel()


def short(shingles: np.ndarray) -> bytes:
    return np.ascontiguousarray(shingles.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def long(data: bytes) -> np.ndarray:
    """What ``short`` wrote, as numbers in the same order."""
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.uint64)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("da"), batch.column("db")):
                x, y = long(x.as_py()), long(y.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], schema=schema)

    joined = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("data").alias("db")), "b").join(
        sets.select(F.col("doc_id").alias("a"), F.col("data").alias("da")), "a"
    )
    return saved(joined.select("a", "b", "da", "db").mapInArrow(run, "a long, b long"), "similar-pairs")


def near_pairs(left, right, key: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of pairs across components that sizes and sketches allow, of one group's members on two sides.

    A side is (rep, component, n, minor, homes, sketch). Of two minor members only the smaller id counts as
    left. A pair that meets in an earlier home than this group is left to that group.
    """
    rep, component, n, _, homes, bits = left
    rep_2, component_2, n_2, minor_2, homes_2, bits_2 = right
    x_all, y_all = [], []
    for a in range(0, len(rep), 64):
        x = np.arange(a, min(a + 64, len(rep)))[:, None]
        small, large = np.minimum(n[x], n_2), np.maximum(n[x], n_2)
        p, q = np.nonzero((component[x] != component_2) & (small * 100 >= large * percent) & (~minor_2 | (rep[x] < rep_2)))
        p = p + a
        far = np.bitwise_count(bits[p] ^ bits_2[q]).sum(axis=1, dtype=np.int64)
        near = far * (100 + percent) <= (n[p] + n_2[q]) * (100 - percent)
        p, q = p[near], q[near]
        ours = np.cumsum(homes == key, axis=1) > 0  # from this group on: homes that do not count
        earlier = np.where(ours, np.int64(0), homes)[p]
        met = ((earlier[:, :, None] == homes_2[q][:, None, :]) & (earlier != 0)[:, :, None]).any(axis=(1, 2)) if len(p) else np.zeros(0, bool)
        x_all.append(p[~met])
        y_all.append(q[~met])
    none = np.zeros(0, np.int64)
    return np.concatenate(x_all or [none]), np.concatenate(y_all or [none])


def _open_members(members: DataFrame) -> DataFrame:
    """``members`` of groups that span components, with ``minor`` (not of the group's largest component),
    ``homes`` (the keys of the member's largest open groups, in the order of size and key; 0: none) and the
    numbers of blocks; without groups whose members all have the same first home elsewhere, as that group
    compares them."""
    each = members.groupBy("key", "component").agg(F.count("rep").alias("rows"))
    sizes = each.groupBy("key").agg(
        F.sum("rows").alias("rows"), F.max_by("component", F.struct("rows", "component")).alias("major"), F.max("rows").alias("most")
    )
    open_groups = saved(sizes.where("rows > most"), "open-groups")
    listed = members.select("key", "rep").join(open_groups.select("key", "rows"), "key")
    first = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("rows")).alias("rows"), "key"))), 1, HOMES)
    homes = listed.groupBy("rep").agg(F.transform(first, lambda h: h["key"]).alias("homes"))
    homed = saved(listed.join(homes, "rep").select("key", "rep", "homes"), "open-members")
    own = homed.groupBy("key").agg(F.min(F.col("homes")[0]).alias("h1"), F.max(F.col("homes")[0]).alias("h2"))
    blocks = open_groups.join(own.where("h1 <> h2 or h1 = key"), "key").select(
        "key",
        "major",
        F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("all_blocks"),
        F.ceil((F.col("rows") - F.col("most")) / BLOCK_ROWS).cast("int").alias("minor_blocks"),
    )
    padded = F.transform(F.sequence(F.lit(0), F.lit(HOMES - 1)), lambda k: F.coalesce(F.get("homes", k), F.lit(0)))
    return (
        members.join(blocks, "key")
        .join(homed, ["key", "rep"])
        .withColumn("homes", padded)
        .withColumn("minor", F.col("component") != F.col("major"))
    )


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components within a group (key, rep, component, n, sketch), by blocks of bounded size.

    One of the two is outside the group's largest component, so blocks of such members meet blocks of all
    members: with few strays the rows dealt grow with the group, not with its square. A pair that shares several
    groups is given once for those among both members' homes. A task holds one pair of blocks at a time.
    """
    found = _open_members(members)
    block = F.xxhash64("rep")

    def side(df: DataFrame, left: bool, own: str, other: str, blocks: str) -> DataFrame:
        return (
            df.withColumn("left", F.lit(left))
            .withColumn(own, F.pmod(block, F.col("minor_blocks" if left else "all_blocks")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        )

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        open_rows: list[tuple[np.ndarray, ...]] = []
        open_key: tuple[int, ...] | None = None
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def close():
            if open_rows:
                is_left, *columns = (np.concatenate(c) for c in zip(*open_rows))
                left, right = [c[is_left] for c in columns], [c[~is_left] for c in columns]
                p, q = near_pairs(left, right, open_key[0], percent)
                if len(p):
                    found.append((np.minimum(left[0][p], right[0][q]), np.maximum(left[0][p], right[0][q])))
                open_rows.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            key, i, j, rep, component, n = (batch.column(c).to_numpy() for c in ("key", "i", "j", "rep", "component", "n"))
            is_left, minor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("left", "minor"))
            homes = batch.column("homes").flatten().to_numpy().reshape(len(rep), -1)
            bits = batch.column("sketch").flatten().to_numpy().view(np.uint64).reshape(len(rep), -1)
            new = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
            bounds = np.append(np.nonzero(new)[0], len(key)).tolist()
            for a, b in zip(bounds[:-1], bounds[1:]):
                name = (int(key[a]), int(i[a]), int(j[a]))
                if name != open_key:
                    close()
                    open_key = name
                open_rows.append(tuple(c[a:b] for c in (is_left, rep, component, n, minor, homes, bits)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)
                found.clear()
        close()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)

    columns = ["key", "i", "j", "left", "rep", "component", "n", "minor", "homes", "sketch"]
    strays = side(found.where("minor"), True, "i", "j", "all_blocks").select(*columns)
    everyone = side(found, False, "j", "i", "minor_blocks").select(*columns)
    blocks = strays.unionByName(everyone).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return blocks.mapInArrow(run, "a long, b long").distinct()


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, size: int = 5
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    work = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = _first_pass(work, size)
    counts = _merge_pieces(first.where("piece is not null"), np.add, "<u4")
    classes = np.ceil(4 * np.log2(counts.astype(np.float64) + 1)).astype(np.uint8) if len(counts) else np.zeros(1 << COUNT_BITS, np.uint8)
    rows = first.where("piece is null").drop("piece", "data")

    alive = rows.where("doc_id is not null and n > 0")
    classes_of = saved(
        alive.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "set-classes"
    )
    rep_of = saved(alive.select("doc_id", "h1", "h2").join(classes_of, ["h1", "h2"]).select("doc_id", "rep").distinct(), "representatives")
    groups = _groups(_keys(work, classes, size, percent))

    def facts(name: str, n: str, sketch: str) -> DataFrame:
        return classes_of.select(F.col("rep").alias(name), F.col("n").alias(n), F.col("sketch").alias(sketch))

    tried = (
        groups.where("kind = 0")
        .groupBy("a", "b")
        .agg(F.lit(1).alias("one"))
        .join(rep_of.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra")), "a")
        .join(rep_of.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb")), "b")
        .where("ra <> rb")
        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        .distinct()
    )
    tried = saved(_near(tried.join(facts("a", "na", "sa"), "a").join(facts("b", "nb", "sb"), "b"), percent), "first-pairs")
    in_groups = groups.where("kind = 1").select("key", F.col("a").alias("doc_id")).join(rep_of, "doc_id").select("key", "rep").distinct()

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()

    def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs whose ends have different components."""
        named = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        both = pairs.join(named[0], "a", "left").join(named[1], "b", "left")
        return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    sets = _sets(work, ends(tried), size)
    nearest = tried.groupBy("b").agg(F.min_by("a", "distance").alias("a")).select("a", "b")
    links = _verified(nearest, sets, percent)
    labels = components(links)
    more = _verified(saved(across(tried.select("a", "b"), labels), "open-pairs"), sets, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(links)
    marked = (
        in_groups.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    marked = saved(marked, "group-members").join(classes_of.select("rep", "n", "sketch"), "rep")
    second = saved(_across(marked, percent).join(tried, ["a", "b"], "left_anti"), "second-pairs")
    rest = ends(second).join(sets.select("doc_id"), "doc_id", "left_anti")
    if not second.isEmpty():
        more = _verified(second, sets.unionByName(_sets(work, rest, size)), percent)
        if not more.isEmpty():
            labels = components(links.unionByName(more))

    named = (
        classes_of.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    )
    linked = rows.where("n > 0").join(named, ["h1", "h2"], "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, size: int = 5) -> DataFrame:
    """``docs`` with the smallest id of each component only; rows without an id stay, as nothing names them.

    Rows that repeat an id are one document and all stay with it.
    """
    found = similar_documents(docs, id_col, text_col, percent, size)
    gone = found.where("doc_id is not null and component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return packed(docs, F.col(id_col).cast("long").alias("id")).join(gone, F.col("id") == F.col("gone_id"), "left_anti").select("row.*")
