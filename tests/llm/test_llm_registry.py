"""The registered queries against their SQL, and the pipeline end to end."""

from __future__ import annotations

import duckdb
import pytest
from llm_helpers import TESTDATA

import __spark_entry__ as contract_module
import corpus_pipeline
from ledgerline.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "labels")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return con


def test_all_are_registered():
    names = contract_module.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(contract_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(session, duck, name):
    got = QUERIES[name](session, TESTDATA)
    columns = sorted(got.columns)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    rows = [dict(zip(names, r, strict=True)) for r in expected.fetchall()]
    assert sorted(names) == columns
    assert sorted(repr([r[c] for c in columns]) for r in got.collect()) == sorted(
        repr([r[c] for c in columns]) for r in rows
    )


def test_pipeline(session, documents, tmp_path):
    docs, kept = documents, []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(session, docs, TESTDATA).write.parquet(f"{tmp_path}/{n}")
        out = session.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert out.columns == documents.columns, name
            kept.append({r["doc_id"] for r in out.select("doc_id").collect()})
        docs = out
    assert kept[0] >= kept[1] >= kept[2] >= kept[3]
    assert len(kept[2]) > 100
    assert {r["doc_id"] for r in docs.collect()} == kept[3]
    run = corpus_pipeline.run(session, TESTDATA)
    assert sorted(map(repr, run.collect())) == sorted(map(repr, docs.collect()))
