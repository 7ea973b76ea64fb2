from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_helpers import TESTDATA  # noqa: E402

from ledgerline.llm.tables import prepare, table  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(session):
    return table(session, TESTDATA, "documents")


@pytest.fixture
def docs(session):
    """Rows of (doc_id, text, source), with columns whose names operators use inside."""

    def make(rows):
        schema = "doc_id long, text string, source string, size long, hub long, key string, line int"
        others = ["copies", "one", "own", "other", "gone", "email", "__key", "__copies", "node", "KEY_"]
        schema += "".join(f", {name} string" for name in others)
        full = [(i, t, s, 7, 8, "k", 9, *others) for i, t, s in rows]
        return session.createDataFrame(full, schema)

    return make
