from __future__ import annotations

import math
import random

import numpy as np
import pytest
from llm_helpers import TESTDATA, rows_of
from pyspark.errors import PythonException

from ledgerline.llm import topk
from ledgerline.llm.tables import table
from ledgerline.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, query_id long"


def brute(rows, k=5, every=50):
    usable = {
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, q in usable:
        if i % every == 0:
            scores = {(-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q)}
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def frame(session, rows):
    return session.createDataFrame([(i, v, 1, "s", 0) for i, v in rows], SCHEMA)


def vectors(seed, n=500, dims=20):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    made = centers[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, dims))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(made)]


@pytest.mark.parametrize(("queries", "rows"), [(512, 16384), (3, 40)])
def test_matches_all_pairs(session, monkeypatch, queries, rows):
    monkeypatch.setattr(topk, "QUERY_BLOCK", queries)
    monkeypatch.setattr(topk, "ROW_BLOCK", rows)
    monkeypatch.setattr(topk, "SEED", 16)
    held = vectors(1)
    # Ties and copies; a third of the rows is one vector.
    held += [(1000 + i, held[7][1]) for i in range(250)]
    assert sorted(rows_of(exact_top_k(frame(session, held), every=50))) == brute(held)


def test_given_vectors(session):
    given = table(session, TESTDATA, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in given.collect()]
    assert sorted(rows_of(exact_top_k(given))) == brute(rows)


def test_awkward_rows(session):
    good = vectors(2, 30, 4)
    odd = [(None, [1.0] * 4), (50, None), (100, [1.0, None, 1.0, 1.0]), (150, [math.nan] * 4), (200, [math.inf] * 4),
           (250, [1.0, 2.0]), (251, [1.0, 2.0]), (300, []), (301, []), (350, [1.0] * 3), (0, good[0][1]), (-50, [0.5] * 4),
           (400, [1e6, -1e6, 3.0, 1.0]), (401, [1e6, 1e6, 0.0, 0.0])]
    rows = [*good, *odd]
    assert sorted(rows_of(exact_top_k(frame(session, rows)))) == brute(rows)
    assert exact_top_k(frame(session, [])).count() == 0


def test_numbers_beyond_doubles_are_exact(session):
    rows = [(0, [1e7, 1.0]), (1, [1e7, 0.00390625]), (2, [1e7, 0.0]), (3, [-1e7, 5.0]), (4, [1.0, 1.0])]
    assert sorted(rows_of(exact_top_k(frame(session, rows)))) == brute(rows)


def test_scores_beyond_64_bits_are_refused(session):
    rows = [(0, [1e9, 1.0]), (1, [1e9, 2.0])]
    with pytest.raises(PythonException, match="do not fit 64 bits"):
        exact_top_k(frame(session, rows)).collect()


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_bounds_prune_and_lose_nothing(monkeypatch, scale):
    rng = np.random.default_rng(4)
    rows = (scale * rng.normal(size=(40, 3000)) * np.linspace(3, 0.1, 40)[:, None] * 256).astype(np.int64)
    queries = rows.T[::300].copy()
    monkeypatch.setattr(topk, "RAISED", 3000)
    for q, (at, score) in zip(queries, topk._bounded_top(queries, rows, 5), strict=True):
        exact = q.astype(object) @ rows.astype(object)
        order = sorted(range(3000), key=lambda j: -exact[j])[:5]
        assert set(order) <= set(at.tolist())
        assert [int(s) for s in score] == [exact[j] for j in at]
