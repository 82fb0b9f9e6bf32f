"""Shingle join, components, decontamination."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradelake.llm import decontaminate
from tradelake.llm import jaccard_join as J
from tradelake.llm.graph import components


def shingles_by_hand(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components_by_hand(rows):
    """(n, smallest id reachable) of each id; rows of one id are one document."""
    sets = [(i, shingles_by_hand(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(s), root(i)) for i, s in sets}


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    rows = []
    for n in (3, 5, 6, 8, 9, 12, 20, 40, 90, 200, 500):
        base = [word() for _ in range(n)]
        for changes in (0, 0, 1, 1, 2, 3, max(1, n // 30), max(1, n // 20), max(1, n // 12)):
            w = list(base)
            for _ in range(changes):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice([[word()], [], [w[at], word()]])
            rows.append(" ".join(w))
    chain = [word() for _ in range(300)]
    rows += [" ".join(chain[k : k + 100]) for k in range(0, 200, 8)]
    rows += [" ".join(passage + [word() for _ in range(k)]) for k in range(0, 60, 2)]
    rows += ["", None, " \t\n", "one", "ONE", "one two three four", "One  two\tthree\nfour", "x y", "y x"]
    return list(enumerate(rows))


def test_join_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i * 3 % 1009, t, "c", 1) for i, t in rows], "doc_id long, text string, component_id string, n int").repartition(5)
    want = components_by_hand([(i * 3 % 1009, t) for i, t in rows])
    got = J.similar_documents(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    kept = {r.doc_id for r in J.keep_one_of_each(df).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def test_join_edge_rows(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(None, text), (None, "q r s t u v"), (None, None), (4, text), (4, text), (9, text + " i"), (3, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in J.similar_documents(df).collect())
    assert got == sorted([("None", 4, 4), ("None", 2, None), ("None", 0, None), ("4", 4, 4), ("4", 4, 4), ("9", 5, 4), ("3", 0, 3)])
    assert J.similar_documents(df.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in J.keep_one_of_each(df).collect()) == ["3", "4", "4", "None", "None", "None"]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.integers(50, 95))
def test_linked_sets_share_a_cell(n, seed, percent):
    """The pigeonhole bound, for random pairs at or just above the similarity."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**64, n, dtype=np.uint64)
    drop = rng.integers(0, n * (100 - percent) // 100 + 1)
    common = a[drop:]
    most = (100 * len(common)) // percent - n if len(common) else 0
    b = np.unique(np.concatenate([common, rng.integers(0, 2**64, rng.integers(0, most + 1) if most > 0 else 0, dtype=np.uint64)]))
    a = np.unique(a)
    both = len(np.intersect1d(a, b))
    if 100 * both < percent * (len(a) + len(b) - both):
        return
    classes = rng.integers(0, 3, 1 << J.COUNT_BITS).astype(np.uint8)
    assert set(J.cell_keys(a, classes, percent)) & set(J.cell_keys(b, classes, percent))
    far = np.bitwise_count((J.bit_sketch(a) ^ J.bit_sketch(b)).view(np.uint64)).sum()
    assert far <= len(a) + len(b) - 2 * both
    assert (J.long(J.short(a)) == a >> np.uint64(16)).all()


def test_groups_over_several_blocks(spark, monkeypatch):
    """Members of a group that the first pass leaves apart are compared across blocks."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    sets = [np.unique(np.append(base, rng.integers(0, 2**64, 2 + k % 3, dtype=np.uint64))) for k in range(15)]
    rows = [(1, k, k, len(s), J.bit_sketch(s).tolist()) for k, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key long, rep long, component long, n long, sketch array<long>")
    got = {(r.a, r.b) for r in J._across(df, 75).collect()}
    assert got == {(a, b) for a in range(15) for b in range(a + 1, 15)}


def test_pairs_of_several_groups_come_once_and_strays_meet_all(spark, monkeypatch):
    """Whatever groups two members share, their pair is found; groups within others' members are not compared again."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 5)
    rng = random.Random(4)
    noise = np.random.default_rng(4)
    base = noise.integers(0, 2**64, 60, dtype=np.uint64)
    sets = [np.unique(np.append(base, noise.integers(0, 2**64, 2, dtype=np.uint64))) for _ in range(40)]
    component = [k if rng.random() < 0.3 else 0 for k in range(40)]
    groups = {key: rng.sample(range(40), rng.randrange(2, 25)) for key in range(1, 30)}
    groups |= {50 + k: groups[7][: 4 + k] for k in range(5)}
    rows = [(key, k, component[k], len(sets[k]), J.bit_sketch(sets[k]).tolist()) for key, some in groups.items() for k in some]
    df = spark.createDataFrame(rows, "key long, rep long, component long, n long, sketch array<long>")
    want = {(a, b) for some in groups.values() for a in some for b in some if a < b and component[a] != component[b]}
    for homes in (1, 2, 8):
        monkeypatch.setattr(J, "HOMES", homes)
        assert {(r.a, r.b) for r in J._across(df, 75).collect()} == want


def test_one_stray_in_a_large_group(spark):
    """A large component and one stray: the rows dealt to blocks grow with the group, not with its square."""
    n = 20_000
    one = "array_repeat(0L, 16)"
    df = spark.range(n).selectExpr("1L key", "id rep", f"if(id = {n - 1}, {n - 1}L, 0L) component", "40L n", f"{one} sketch")
    found = J._open_members(df)
    assert [tuple(r) for r in found.select("all_blocks", "minor_blocks").distinct().collect()] == [(n // J.BLOCK_ROWS, 1)]
    assert found.where("minor").count() == 1
    assert J._across(df, 75).count() == n - 1


@pytest.mark.parametrize("held", [2, 7, 1000])
def test_groups_longer_than_a_task_holds(spark, monkeypatch, held):
    """However rows are cut, a first member meets all others, and groups of three or more are listed whole."""
    monkeypatch.setattr(J, "HELD_ROWS", held)
    rng = random.Random(held)
    rows = [(rng.randrange(40), rng.randrange(30)) for _ in range(150)] + [(99, k) for k in range(60)] + [(98, 5)] * 9
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = J._groups(spark.createDataFrame(rows, "key long, doc_id long")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = {(r.a, r.b) for r in got if r.kind == 0}
    listed = {}
    for r in got:
        if r.kind == 1:
            listed.setdefault(r.key, set()).add(r.a)
    groups = {}
    for k, d in rows:
        groups.setdefault(k, set()).add(d)
    for members in groups.values():
        lead = min(members)
        assert {(lead, m) for m in members if m != lead} <= pairs
        assert len(members) < 3 or any(members <= m for m in listed.values())
    assert pairs <= {(min(m), x) for m in groups.values() for x in m}


def test_components(spark):
    links = [(k, k + 1) for k in range(20, 60)] + [(100, k) for k in range(101, 130)] + [(5, 100), (7, 6), (9, 8)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 20 for k in range(20, 61)} | {k: 5 for k in [5, *range(100, 130)]} | {6: 6, 7: 6, 8: 8, 9: 8}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def subsequence_by_hand(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], max(row[k + 1], row[k], last + 1 if x == y else 0)
    return row[-1]


@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=20), st.lists(st.sampled_from("abcd"), max_size=30))
def test_common_subsequence(a, b):
    assert decontaminate.common_subsequence(decontaminate.places_of(a), len(a), b) == subsequence_by_hand(a, b)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(3000)]
    common = vocabulary[:30]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary)
    items = [[word() for _ in range(rng.randrange(14, 60))] for _ in range(30)]
    docs, truth = [], {}
    for i in range(400):
        body = [word() for _ in range(rng.randrange(0, 300))]
        if i % 10 == 0:
            k = rng.randrange(30)
            copy = list(items[k])
            if i % 20 == 0:  # a paraphrase: every sixth word replaced
                for at in range(2, len(copy) - 1, 6):
                    copy[at] = word()
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() if rng.random() < 0.1 else w + "," for w in copy]
            truth[i] = k
        docs.append((i, " ".join(body)))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)], truth


def test_leaks(spark, planted, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS_PER_BLOCK", 12)
    docs, items, truth = planted
    df = spark.createDataFrame([(*d, "l", "w") for d in docs] + [(900, None, "l", "w"), (None, items[3][1], "l", "w")], "doc_id long, text string, leaks string, row string")
    bench = spark.createDataFrame([*items, (77, ""), (78, None)], "item_id long, text string")
    got = decontaminate.find_leaks(spark, df, bench)
    assert got.columns == ["doc_id", "text", "row", "leaks"]
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in got.collect()}
    assert len(found) == 402 and found.pop(None) == [3] and found.pop(900) == []
    assert {i: ks for i, ks in found.items() if ks} == {i: [k] for i, k in truth.items()}
    assert all(not r.leaks for r in decontaminate.find_leaks(spark, df, bench.limit(0)).collect())
    assert decontaminate.find_leaks(spark, df.limit(0), bench).count() == 0


def test_paraphrased_leaks_reach_the_alignment(spark, planted):
    """Against brute force: two fifths of the words before the answer replaced, the answer kept."""
    rng = random.Random(21)
    docs, items, _ = planted
    vocabulary = sorted({w for _, text in docs for w in text.split()})
    cases, truth = [], set()
    for i in range(400):
        k, text = items[i % len(items)]
        copy = text.split()
        before = len(copy) - max(3, len(copy) // 5)
        for at in rng.sample(range(before), 2 * before // 5):
            copy[at] = rng.choice(vocabulary)
        body = rng.choice(docs)[1].split()
        at = rng.randrange(len(body) + 1)
        body[at:at] = copy
        cases.append((1000 + i, " ".join(body)))
        item, words = decontaminate.words_of(text), decontaminate.words_of(cases[-1][1])
        if any(decontaminate.leak_ratio(item, decontaminate.places_of(item), words, a) for a in range(0, len(words), decontaminate.STRIDE)):
            truth.add((1000 + i, k))
    df = spark.createDataFrame([*docs, *cases], "doc_id long, text string")
    found = {(r.doc_id, x.item_id) for r in decontaminate.find_leaks(spark, df, spark.createDataFrame(items, "item_id long, text string")).collect() for x in r.leaks}
    assert len(truth) > 300 and len(truth - found) <= len(truth) // 100, len(truth - found)


def test_short_items_are_looked_for_in_fewer_rows():
    """The rows around a passage follow each item's own length, not the longest one's; leaks at any place are found."""
    rng = np.random.default_rng(3)
    word = lambda k: f"w{k}"
    items = [(1, " ".join(word(900 + k) for k in range(12))), (2, " ".join(word(800 + k) for k in range(90)))]
    filler = [word(k) for k in rng.integers(0, 700, 400)]
    texts = [" ".join(filler[:a] + items[which][1].split() + filler[a:]) for which in (0, 1) for a in (0, 1, 15, 16, 31, 200, 400)]
    table = rng.normal(size=(decontaminate.TERMS + 1, decontaminate.KEPT)).astype(np.float32)
    table[-1] = 0
    block = decontaminate.Items(items, table)
    assert [(reach, owners.tolist()) for reach, owners, _, _ in block.by_reach] == [(2, [0]), (6, [1])]
    group = [(k, decontaminate.terms_of(decontaminate.hashes_of(decontaminate.words_of(t)))) for k, t in enumerate(texts)]
    found = block.search(group, lambda k: texts[k])
    assert {k: set(v) for k, v in found.items()} == {k: {1 + (k >= 7)} for k in range(14)}


def test_words_of_no_item_cost_no_comparison(monkeypatch):
    """Documents without an item's words give no pairs; all leaks of brute force over every pair are found."""
    rng = np.random.default_rng(5)
    vocabulary = {f"w{k}": decontaminate.hashes_of([b"w%d" % k])[0] % decontaminate.TERMS for k in range(9000)}
    of_items = list(vocabulary)[:600]
    taken = {vocabulary[w] for w in of_items}
    others = [w for w, term in vocabulary.items() if term not in taken]
    items = [(k, " ".join(rng.choice(of_items, 12 + k))) for k in range(40)]
    table = rng.normal(size=(decontaminate.TERMS + 1, decontaminate.KEPT)).astype(np.float32)
    table[-1] = 0
    block = decontaminate.Items(items, table)
    compared = []

    def all_are_similar(self, vectors, p, q):
        compared.append(len(p))
        return np.ones(len(p), dtype=bool)

    monkeypatch.setattr(decontaminate.Items, "similar", all_are_similar)

    def search(texts):
        return block.search([(k, decontaminate.terms_of(decontaminate.hashes_of(decontaminate.words_of(t)))) for k, t in enumerate(texts)], lambda k: texts[k])

    assert search([" ".join(rng.choice(others, 400)) for _ in range(60)]) == {} and sum(compared) == 0
    texts, truth = [], {}
    for k, (_, text) in enumerate(items):
        copy = [w if rng.random() < 0.75 else str(rng.choice(of_items)) for w in text.split()]
        body = rng.choice(others if k % 2 else of_items, 100).tolist()
        texts.append(" ".join(body[: k * 2] + copy + body[k * 2 :]))
        words = decontaminate.words_of(texts[-1])
        for i, other in items:
            item = decontaminate.words_of(other)
            ratio = max(decontaminate.leak_ratio(item, decontaminate.places_of(item), words, a) for a in range(0, max(1, len(words) - 16), 16))
            if ratio:
                truth.setdefault(k, {})[i] = ratio
    assert len(truth) > 10 and search(texts) == truth
