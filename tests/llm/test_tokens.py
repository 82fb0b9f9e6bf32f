"""Token files and packing."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradelake.llm import common, packing, pfor, tokens
from tradelake.llm.token_files import read_token_files, write_token_files
from tradelake.llm.tokens import encoder

TEXTS = [
    None,
    "",
    " ",
    "one two, three.\nFour  five\n\n six\t7 don't it's ",
    "Ünïcödé ΑΣ İstanbul été été 日本 語",
    "a" * 5000 + " " + "b c " * 3000,
    "<|endoftext|> x <|startoftext|>",
    "x y z \x1c q\x00r",
    "trailing\n",
    "\nleading",
]


def reference(name, text, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=400), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, dtype=np.uint32)
    data = pfor.encode(ids, percentile)
    assert (pfor.decode(data) == ids).all()
    for k in range(-(-len(ids) // pfor.BLOCK)):
        assert (pfor.block(data, k) == ids[k * pfor.BLOCK : (k + 1) * pfor.BLOCK]).all()


def test_rare_large_ids_do_not_widen_a_block():
    ids = np.array([*range(100, 220), *[50_000] * 8], dtype=np.uint32)
    assert len(pfor.encode(ids, 0.9)) < len(pfor.encode(ids, 1.0)) < ids.nbytes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é.,'\n\t 1Σ日", max_size=30), max_size=5))
def test_words_encode_as_whole_texts(texts):
    for name, spaces in (("byte_bpe_50k.json", "part"), ("word_bpe_49k.json", "dropped")):
        got = encoder(public_tokenizers.path(name), spaces).encode(texts)
        for t, ids in zip(texts, got):
            assert ids.tolist() == reference(name, t, 0)[:-1].tolist(), (name, t)


def docs_of(spark):
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(TEXTS)] + [(9, TEXTS[3], "x", 1), (None, "no id", "x", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids string, n int")


def test_token_files(spark, tmp_dir):
    rows, df = docs_of(spark)
    path = f"{tmp_dir}/tokens"
    write_token_files(df, path, public_tokenizers.path("byte_bpe_50k.json"), "part", 2, ids_per_run=50)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(r[0] for r in rows if r[0] is not None)]
    at, text_of = 0, {r[0]: r[1] for r in rows}
    for r in got:
        ids = reference("byte_bpe_50k.json", text_of[r.doc_id], 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    write_token_files(df.limit(0), path + "0", public_tokenizers.path("byte_bpe_50k.json"), "part", 2)
    assert read_token_files(spark, path + "0").count() == 0


def test_packing_is_one_result(spark):
    """Whatever is asked of it, the plan gives the same pieces, in several ranges as in one."""
    _, df = docs_of(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    columns = ["doc_id", "start", "length", "ids", "sequence_id", "offset"]
    for range_bytes in (200, 1 << 20):
        pieces = packing.pack_documents(df, path, "dropped", 1, length=64, range_bytes=range_bytes).select(*columns)
        first = sorted(map(repr, pieces.collect()))
        assert first == sorted(map(repr, pieces.sort("length", "ids").collect()))
        assert pieces.exceptAll(pieces.repartition(3)).count() == 0
        again = packing.pack_documents(df.repartition(3), path, "dropped", 1, length=64, range_bytes=range_bytes).select("doc_id", "start", "ids")
        ids = b"".join(sorted(r.ids for r in again.collect()))
        assert len(ids) == sum(len(r.ids) for r in pieces.collect())
        ranges = {r.sequence_id >> 36 for r in pieces.collect()}
        assert len(ranges) > 1 if range_bytes == 200 else ranges == {0}


def test_packing(spark):
    rows, df = docs_of(spark)
    pieces = packing.pack_documents(df, public_tokenizers.path("word_bpe_49k.json"), "dropped", 1, length=256).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for i, text in {r[0]: r[1] for r in rows}.items():
        whole = reference("word_bpe_49k.json", text, 1).tobytes()
        copies = sum(r[0] == i for r in rows)
        mine = sorted(by_doc[i], key=lambda p: p.start)
        assert sum(p.length for p in mine) == copies * len(whole) // 4
        assert all(p.ids == whole[4 * p.start : 4 * (p.start + p.length)] and p.doc_tokens == len(whole) // 4 for p in mine)
    for some in by_sequence.values():
        some.sort(key=lambda p: p.offset)
        assert [p.offset for p in some] == np.cumsum([0, *[p.length for p in some[:-1]]]).tolist()
        total = sum(p.length for p in some)
        assert total <= 256 and total & (total - 1) == 0
    assert packing.pack_documents(df.limit(0), public_tokenizers.path("word_bpe_49k.json"), "dropped", 1).count() == 0


def test_hilbert_neighbours():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_key(cells, bits=3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_a_worker_keeps_one_cache(monkeypatch):
    monkeypatch.setattr(common, "_KEPT", {})
    first = common.kept("a", list)
    assert common.kept("a", list) is first
    assert common.kept("b", dict) == {} and list(common._KEPT) == ["b"]
    assert common.kept("a", list) is not first


def test_rare_words_are_encoded_but_not_kept(monkeypatch):
    """Each group has many words of its own; only stems it holds more than once stay, and no more than fit."""
    monkeypatch.setattr(tokens, "MAX_STEMS", 3)
    rare = ["".join(chr(97 + (k * p) % 26) for p in (1, 3, 5, 7, 11)) + chr(97 + k // 26) for k in range(500)]
    rare += ["\0odd", "Ærø###", "ÉTÉ.&&&", "don't", "x9", "日本"]
    texts = [" ".join(rare[a::4] + ["often", "often,", "Often\nwords words", "more", "more", "again", "again."]) for a in range(4)]
    for name, spaces in (("byte_bpe_50k.json", "part"), ("word_bpe_49k.json", "dropped")):
        enc = tokens.WordEncoder(public_tokenizers.path(name), spaces)
        for group in (texts[:2], texts[2:]):
            for text, ids in zip(group, enc.encode(group)):
                assert ids.tolist() == reference(name, text, 0)[:-1].tolist()
        assert len(enc.places) == 3 and not set(enc.places) & set(rare)


def test_a_packing_task_needs_one_python_worker(spark):
    docs = spark.createDataFrame([(k, f"word {k} and more") for k in range(50)], "doc_id long, text string")
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), spaces="dropped", end_id=1)
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and pieces.agg({"length": "sum"}).first()[0] == sum(len(reference("word_bpe_49k.json", r.text, 1)) for r in docs.collect())
