from __future__ import annotations

import random
import re

import pytest
from llm_helpers import AWKWARD, rows_of

from ledgerline.llm import mixing
from ledgerline.llm.mixing import mix_sources, targets


def shared_out(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by repeated sharing: what is above a bound goes back to the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    bound = {s: repeats * sizes[s] for s in names}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        spare = total - sum(bound[s] for s in stopped)
        by = sum(weight[s] for s in names if s not in stopped)
        target = {s: bound[s] if s in stopped else spare * weight[s] / by for s in names}
        above = {s for s in names if target[s] > bound[s]}
        if not above:
            return target
        stopped |= above


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def corpus(seed, n=400):
    rng = random.Random(seed)
    sources = ["a"] * 12 + ["b", "c", "d", "é", None]
    return [(i, "w " * rng.randint(0, 60), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_those_of_repeated_sharing(session, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, rng.randint(1, 1000)]) for s in [*"abcdefghij", None]}
    frame = session.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(frame, (5, 2, 1), 1.5, 2).collect()}
    assert got == pytest.approx(shared_out(sizes))


@pytest.mark.parametrize("bucket", [4096, 7])
def test_sources_come_near_their_targets(docs, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = corpus(1)
    out = mix_sources(docs(rows)).figures().collect()
    assert sorted(r["doc_id"] for r in out) == list(range(400))
    sizes: dict = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want, source = shared_out(sizes), {i: s for i, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        s = source[r["doc_id"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert (r["source_size"], r["target"]) == (sizes[s], pytest.approx(want[s]))
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    assert 0 <= 1.5 * sum(sizes.values()) - sum(taken.values()) <= 60


def test_groups_do_not_change_the_result(docs, monkeypatch):
    rows = corpus(2)
    whole = sorted(rows_of(mix_sources(docs(rows)).figures()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    assert sorted(rows_of(mix_sources(docs(rows[::-1])).figures())) == whole


def test_as_many_sources_as_documents(docs, monkeypatch):
    """Sources of one document end at one time, and the budget ends among them."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([0, 5, 5, 5, rng.randint(1, 40)]), f"s{i}") for i in range(150)]
    out = mix_sources(docs(rows)).figures().collect()
    sizes = {s: size(t) for _, t, s in rows}
    want = shared_out(sizes)
    assert {r["doc_id"]: r["target"] for r in out} == pytest.approx(
        {i: want[s] for i, _, s in rows}
    )
    offers = sorted(
        ((turn + 1) * size(t) / want[s] if want[s] else 0.0, names, turn, i, size(t))
        for i, t, s in rows
        for names in [sorted(sizes).index(s)]
        for turn in (0, 1)
    )
    left, taken = 1.5 * sum(sizes.values()), dict.fromkeys(range(150), 0)
    for _, _, _, i, words in offers:
        left -= words
        if left < 0:
            break
        taken[i] += words
    assert {r["doc_id"]: r["taken"] for r in out} == taken


def test_rows_repeated_very_often(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rows = [(1, "a b c", "x")] * 50 + [(2, "d e", "x"), (3, "f", "y")] * 8
    out = [r["doc_id"] for r in mix_sources(docs(rows)).figures().collect()]
    assert sorted(out) == sorted(i for i, _, _ in rows)


@pytest.mark.parametrize("rows", [0, 1, 7, 60])
def test_running_totals(session, monkeypatch, rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rng = random.Random(rows)
    given = [(rng.randint(0, 9), i, rng.randint(0, 99)) for i in range(rows)]
    frame = session.createDataFrame(given, "a long, b long, c long")
    got = {r["b"]: r["before_c"] for r in mixing.running(frame, ["a", "b"], ["c"]).collect()}
    upto = 0
    for _, b, c in sorted(given):
        assert got.pop(b) == upto
        upto += c
    assert not got


def test_documents_follow_the_figures(docs):
    rows = [*corpus(3, 60), *AWKWARD]
    mix = mix_sources(docs(rows))
    out = mix.documents(docs(rows))
    assert out.columns == docs(rows).columns
    taken = sum(r["taken"] for r in mix.figures().collect())
    assert sum(size(r["text"]) for r in out.collect()) == taken


def test_awkward_rows(docs):
    out = mix_sources(docs(AWKWARD)).figures().collect()
    assert len(out) == len(AWKWARD)
    same = [r for r in out if r["doc_id"] == 5]
    assert len(same) == 2 and same[0] == same[1]
    assert mix_sources(docs([])).figures().count() == 0
    assert mix_sources(docs([])).documents(docs([])).count() == 0
    blank = mix_sources(docs([(1, None, "a"), (2, " ", None)])).figures()
    assert {r["taken"] for r in blank.collect()} == {0}


def test_columns_of_any_name_stay(docs):
    rows = corpus(6, 40)
    frame = docs(rows)
    given = {r["doc_id"]: tuple(r) for r in frame.collect()}
    out = mix_sources(frame).documents(frame)
    assert out.columns == frame.columns
    assert all(tuple(r) == given[r["doc_id"]] for r in out.collect())
