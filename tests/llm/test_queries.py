"""The registered queries and the pipeline on sf0.001, against DuckDB where SQL exists."""

import duckdb
import pytest

import corpus_pipeline
from tradelake.llm import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels")


def canon(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = Q.queries()[name](spark, SF)
    res = con.execute(Q.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(got.columns)
    assert canon(got.select(*names).collect()) == canon(res.fetchall())


def test_ten_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 11))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.fieldNames() == docs.schema.fieldNames(), name
        path = corpus_pipeline.saved(out, f"test-{name}")
        left = {r.doc_id for r in path.select("doc_id").collect()}
        assert left <= ids and (left < ids or name in ("line_dedup", "toxicity", "decontamination")), name
        docs, ids = path, left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == ids
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
    assert all(whole[p.doc_id] == p.doc_tokens for p in pieces)
