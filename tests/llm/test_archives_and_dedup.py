"""WARC archives, exact dedup, line dedup."""

import base64
import gzip
import hashlib

import numpy as np
import pytest

from tradelake.llm import exact_dedup
from tradelake.llm.exact_dedup import build_hash, deduplicate, find_slots
from tradelake.llm.line_dedup import drop_repeated_lines
from tradelake.llm.warc import parse_records, read_warc, resolve_revisits, write_warc

LONG = "this line is long enough to count as a repeated one " * 2


def sha1_32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


PAGES = [
    (1, "http://a/x y", "<p>é</p>\r\n\r\nWARC/1.1\r\n"),
    (2, "http://b", "<p>é</p>\r\n\r\nWARC/1.1\r\n"),
    (3, None, None),
    (4, "http://c", ""),
    (None, "http://d", ""),
    (5, "http://e", "only"),
    (5, "http://e", "only"),
    (6, "http://f", "x" * 300_000),
]


@pytest.mark.parametrize("min_bytes", [0, 1])
def test_warc_round_trip(spark, tmp_dir, min_bytes):
    pages = spark.createDataFrame([(*p, "junk", 1) for p in PAGES], "page_id long, url string, html string, payload string, bytes int")
    path = f"{tmp_dir}/w{min_bytes}"
    write_warc(resolve_revisits(pages, min_bytes=min_bytes), path, records_per_file=3)
    got = read_warc(spark, path, with_payload=True).collect()
    assert len(got) == len(PAGES)
    best = {}
    for i, _, t in PAGES:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    responses = {}
    for r in got:
        text = next(t or "" for i, u, t in PAGES if i == r.page_id and (u or "").replace(" ", "%20") == (r.url or ""))
        assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), sha1_32(text))
        if r.record_type == "response":
            assert bytes(r.payload) == text.encode() and r.refers_to is None
            responses[text] = responses.get(text, 0) + 1
            assert len(text) < min_bytes or r.page_id == best[text]
        else:
            assert r.refers_to == best[text] and len(text) >= min_bytes
    assert all(n == 1 for t, n in responses.items() if len(t) >= min_bytes)
    assert responses[""] == (1 if min_bytes == 0 else 3)


def test_warc_empty_and_cut_short(spark, tmp_dir):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    write_warc(resolve_revisits(none), f"{tmp_dir}/none")
    assert read_warc(spark, f"{tmp_dir}/none").count() == 0
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [b for _, b in parse_records(gzip.compress(record) + gzip.compress(record))] == [b"hello"] * 2
    with pytest.raises(ValueError):
        list(parse_records(record[:-6]))


def test_minimal_perfect_hash():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    levels, slots = build_hash(keys)
    assert sorted(slots) == list(range(3000))
    words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 4)
    assert (find_slots(words, levels) == slots).all()
    assert build_hash([])[0] == []


def test_a_first_load_is_dealt_into_groups(spark, monkeypatch):
    merge = exact_dedup._merge

    def small(index, batch):
        assert batch.num_rows < 4000, batch.num_rows
        return merge(index, batch)

    monkeypatch.setattr(exact_dedup, "_merge", small)
    batch = spark.range(12_000).selectExpr("id AS doc_id", "concat('text ', id % 11000) AS text")
    for history in (batch.limit(0), spark.createDataFrame([(-5, "text 3")], "doc_id long, text string")):
        got = deduplicate(history, batch)
        assert got.count() == 12_000 + history.count() and got.where("kept").count() == 11_000


def test_exact_dedup_against_brute_force(spark):
    texts = [None, "", "a", "A", "a ", "b", "b"] + ["hot"] * 40 + [f"t{i % 13}" for i in range(40)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x"), (None, "only null", "x"), (5, "b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    for cut in (-1, 30, 1000):
        old = "doc_id is null" if cut < 0 else f"doc_id <= {cut} or doc_id is null"
        got = deduplicate(df.where(old), df.where(f"not coalesce({old}, true)")).collect()
        assert len(got) == len(rows)
        groups = {}
        for i, t, _ in rows:
            groups.setdefault(t or "", []).append(i)
        by = {}
        for r in got:
            by.setdefault(r.text_sha256, []).append(r)
        assert len(by) == len(groups)
        for text, ids in groups.items():
            mine = by[hashlib.sha256(text.encode()).hexdigest()]
            known = [i for i in ids if i is not None]
            assert {(r.keep_id, r.group_size) for r in mine} == {(max(known) if known else None, len(ids))}
            assert sum(r.kept for r in mine) == 1
            assert {r.doc_id for r in mine if r.kept} == {max(known) if known else None}
    empty = df.limit(0)
    assert deduplicate(empty, empty).count() == 0
    assert deduplicate(empty, df).count() == len(rows)


def lines_by_hand(rows, min_chars=40, min_docs=5):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    keeper = {k: max(h, key=lambda x: (x is not None, x)) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_against_brute_force(spark):
    rows = [(i, f"own {i}\n{LONG}\n  {LONG.upper()}\t\nshort") for i in range(6)]
    rows += [(6, None), (7, ""), (8, "\n\n"), (9, "É" * 40), (10, "é" * 40), (11, LONG), (11, LONG + "\nx"), (None, LONG), (None, "z")]
    rows += [(20 + i, ("é" * 39 + "Z" + "\n") * 3) for i in range(5)] + [(40, "w" * 100_000 + "\n" + LONG), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id long, text string, n_lines int, row string")
    got = drop_repeated_lines(df)
    assert got.columns == ["doc_id", "text", "n_lines", "row", "n_dropped"]
    order = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()), key=order) == sorted(lines_by_hand(rows), key=order)
    assert drop_repeated_lines(df.limit(0)).count() == 0
