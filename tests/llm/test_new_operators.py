"""Histogram sort, prefix trie and spelling variants against brute force on small tables with every edge case."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelake.llm import histogram_sort, prefix_trie, spelling
from tradelake.llm.queries import op11_histogram_sort, op12_prefix_trie, op13_spelling_variants

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, shard string, slot int, `a.b` int"


# ---------------------------------------------------------------- histogram sort


def _nearest(rows, n):
    """Shard of each row by cumulative bytes: the cut nearest to each target, the smaller of two."""
    order = sorted(range(len(rows)), key=lambda k: (hashlib.md5((rows[k][1] or "").encode()).hexdigest()[:15], -(1 << 63) if rows[k][0] is None else rows[k][0]))
    below = [0]
    for k in order:
        below.append(below[-1] + len((rows[k][1] or "").encode()) + 16)
    out, shard = [], 0
    cuts = [min(range(len(below)), key=lambda k: (abs(below[k] - below[-1] * (j + 1) / n), k)) for j in range(n - 1)]
    for place, k in enumerate(order):
        shard = sum(c <= place for c in cuts)
        out.append((rows[k][0], rows[k][1], shard))
    return out


@pytest.mark.parametrize("task_bytes", [1 << 30, 700])
def test_shards_are_the_nearest_cuts(spark, task_bytes):
    rng = np.random.default_rng(3)
    rows = [(int(i), "x" * int(rng.integers(0, 400)), "s", 1, i) for i in range(150)]
    rows += [(None, None, "s", 1, 0), (None, "", "s", 1, 0), (7, "one row", "s", 1, 7), (-4, "y" * 20_000, "s", 1, 0)]
    rows += [(500, "the same row", "s", 2, 5)] * 120  # a hot key, cut by splitters
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    out = histogram_sort.shard_documents(df, 7, task_bytes=task_bytes)
    assert out.columns == ["doc_id", "text", "a.b", "shard", "slot"] or set(out.columns) == {"doc_id", "text", "a.b", "shard", "slot"}
    got = out.select("doc_id", "text", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text, r.shard) for r in got) == Counter(_nearest([r[:2] for r in rows], 7))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_tolerance_is_kept(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 90).cast("int")).alias("text"))
    sizes = histogram_sort.shard_documents(df, 8, tolerance=0.02).groupBy("shard").agg(F.sum(F.octet_length("text") + 16).alias("b")).collect()
    even = sum(r.b for r in sizes) / 8
    assert len(sizes) == 8 and all(abs(r.b - even) <= 2 * 0.02 * even + 200 for r in sizes)


def test_no_rows_and_one_row(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert histogram_sort.shard_documents(empty, 3).collect() == []
    one = histogram_sort.shard_documents(spark.createDataFrame([(None, None)], "doc_id long, text string"), 3).collect()
    assert len(one) == 1 and one[0].slot == 0


def test_shards_are_written_without_an_exchange(spark, tmp_dir):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    shards = histogram_sort.shard_documents(df, 5)
    histogram_sort.write_shards(shards, tmp_dir + "/shards")
    assert spark.read.parquet(tmp_dir + "/shards").groupBy("shard").count().count() == 5
    assert shards._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_op11_on_the_given_table(spark):
    rows = op11_histogram_sort(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = {d.doc_id: d.text or "" for d in docs}
    expected = {i: s for i, _, s in _nearest([(d.doc_id, d.text) for d in docs], 40)}
    assert len(rows) == len(docs) and {r.doc_id: r.shard for r in rows} == expected
    assert all(r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


# ---------------------------------------------------------------- prefix trie


def _trie(rows, base, head):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {c: tuple(own.get(base(c), [])[: head(c)] + v[head(c) :]) for c, v in own.items()}
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        for k in range(len(v) + 1):
            members[v[:k]].append(c)
    for v in members:
        if v:
            kids[v[:-1]].append(v)
    leaves, saved, out = {}, {}, set()
    for v in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", v[-1][1])) if v else 0
        leaves[v] = sum(leaves[k] for k in kids[v]) or 1
        saved[v] = (len(members[v]) - 1) * words + sum(saved[k] for k in kids[v])
        ends = ",".join(str(c) for c in sorted(members[v]) if len(rebuilt[c]) == len(v))
        parent = min(members[v[:-1]]) if v else None
        out.add((min(members[v]), len(v), parent, len(members[v]), len(kids[v]), leaves[v], saved[v], hashlib.sha256(ends.encode()).hexdigest()))
    return out


NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _head(c):
    return zlib.crc32(str(c).encode()) % 4


def _nodes(df):
    rows = [tuple(r) for r in df.select(*NODE_COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_trie_of_odd_conversations(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(90):
        for t in range(int(rng.integers(0, 6))):
            rows.append((c, t, "ua"[t % 2], ["hello  there", "", None, "yes", "a\tb\nc"][int(rng.integers(0, 5))]))
    rows += [(200 + k, t, "u", "same words here") for k in range(40) for t in range(4)]  # copies
    rows += [(400, t, "u", f"turn {t % 3}") for t in range(3000)]  # a long conversation, over several tasks
    rows += [(401, None, None, None), (401, None, "u", "tie b"), (401, None, "u", "tie a"), (401, 3, "u", "x"), (401, 3, "u", "x"), (None, 1, "u", "nobody's")]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).withColumn("depth", F.lit("other")).repartition(6)
    conv = F.col("conv")
    got = prefix_trie.prefix_trie(df, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
    assert _nodes(got) == _trie(rows, lambda c: c - c % 20, _head)
    own = prefix_trie.prefix_trie(df.where("conv_id < 100"))
    assert _nodes(own) == _trie([r for r in rows if r[0] is not None and r[0] < 100], lambda c: c, lambda c: 0)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).collect() == []


def test_a_collision_is_seen_and_mended(spark, monkeypatch):
    """With fingerprints that ignore the turns, the first attempt must be thrown away."""
    rows = [(c, t, "u", f"{c} {t}") for c in range(6) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = prefix_trie.bases
    tried = []
    monkeypatch.setattr(prefix_trie, "bases", lambda seed: tried.append(seed) or whole(seed))
    keys = prefix_trie._keys
    monkeypatch.setattr(prefix_trie, "_keys", lambda seed: keys(seed) if seed else [F.lit(1).cast("long").alias("k1"), F.lit(2).cast("long").alias("k2")])
    assert _nodes(prefix_trie.prefix_trie(df)) == _trie(rows, lambda c: c, lambda c: 0)
    assert set(tried) == {0, 1}


def test_op12_on_the_given_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert _nodes(op12_prefix_trie(spark, SF)) == _trie(rows, lambda c: c - c % 20, _head)


# ---------------------------------------------------------------- spelling variants


def _variants(rows):
    lower = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    forms, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if v != w and abs(len(v) - len(w)) <= 1 and near(w, v)]
        best = min(others, key=lambda v: (-words[v], v)) if others else None
        forms[w] = best if best and words[best] >= 2 * n else None
        out[w] = [n, len(others), forms[w], words.get(forms[w])]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def _found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_variants_of_made_up_words(spark):
    rng = np.random.default_rng(2)
    rows = [(None, "aaaaa AAAAA aaaaa aaaaaa aaaaaa aaaaaa bbbbb"), (1, None), (2, ""), (3, "ÀÁÂÃÄ àÁÂÃÄ " * 4)]
    stems = ["kitten", "sitting", "mitten", "bitten", "kitte", "letter", "better", "bettor", "aabbaabb", "aabaabb", "xyzzy" * 5]
    for k in range(120):
        words = []
        for _ in range(60):
            w = stems[int(rng.integers(0, len(stems)) ** 2 // len(stems))]
            if rng.random() < 0.3:
                i, c = int(rng.integers(0, len(w))), "abeké"[int(rng.integers(0, 5))]
                w = [w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]][int(rng.integers(0, 3))]
            words.append(w)
        rows.append((10 + k, "-".join(words)))
    rows += [(10, rows[10][1])] * 3  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).repartition(4)
    expected = _variants(rows)
    assert any(v[4] != (v[2] or w) for w, v in expected.items())  # a chain of forms
    assert _found(spelling.spelling_variants(df)) == expected
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_are_cut_between_runs():
    text = ("letter été " * 500) + "x" * 3000 + " end"
    for size in (1, 7, 1000):
        parts = list(spelling.stretches(text, size))
        assert "".join(parts) == text
        assert Counter(r for p in parts for r in re.findall(spelling.RUN, p)) == Counter(re.findall(spelling.RUN, text))


def test_op13_on_the_given_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _found(op13_spelling_variants(spark, SF)) == _variants(rows)
