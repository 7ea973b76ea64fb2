"""Repeated passages against counting every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import AWKWARD, rows_of

from ledgerline.llm import substring
from ledgerline.llm.queries import op11_relative_lempel_ziv
from ledgerline.llm.substring import Reference, anchor_words, anchors, repeated_passages, spans_of


def words_of(text):
    return (text or "").encode().split()


def brute(rows, window):
    count = Counter()
    for _, text in rows:
        words = words_of(text)
        count.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if count[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def check(session, rows, window):
    frame = session.createDataFrame(
        [(i, t, "k", 2, 3, 4) for i, t in rows],
        "doc_id long, text string, key string, n_words int, class_id int, place int",
    )
    found = repeated_passages(frame, window=window, keep_text=True)
    assert found.columns == ["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept"]
    got = found.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    assert sorted(map(repr, rows_of(got))) == sorted(map(repr, brute(rows, window)))
    for row in found.collect():
        assert sum(s["end"] - s["first"] for s in row["spans"]) == row["n_removed"]


def texts(seed, n, passages, vocabulary=400):
    """Random words with shared passages set in at random, some of them cut short."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    shared = [[word() for _ in range(rng.randint(5, 60))] for _ in range(passages)]
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            low = rng.randint(0, len(passage) // 2)
            at = rng.randint(0, len(words))
            words[at:at] = passage[low : rng.randint(low, len(passage))]
        out.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    return out


@given(st.integers(2, 40), st.lists(st.integers(0, 5), min_size=40, max_size=120))
@settings(max_examples=200, deadline=None)
def test_every_window_holds_an_anchor(window, numbers):
    words = [b"w%d" % n for n in numbers]
    at, hashes = anchors(words, window)
    size, _ = anchor_words(window)
    assert size <= window
    for i in range(len(words) - window + 1):
        inside = (at >= i) & (at <= i + window - size)
        assert inside.any()
        alone, same = anchors(words[i : i + window], window)  # chosen by their words alone
        assert list(alone + i) == list(at[inside]) and list(same) == list(hashes[inside])


@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=4, max_size=14), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_factors_and_their_ends(held):
    held = [list(x) for x in dict.fromkeys(map(tuple, held))]
    block = Reference(held, 4)
    count = Counter(tuple(w[i : i + 4]) for w in held for i in range(len(w) - 3))
    for number, words in enumerate(held):
        expected = [i for i in range(len(words) - 3) if count[tuple(words[i : i + 4])] > 1]
        assert block.repeated(number) == expected


def test_spans():
    assert spans_of(np.array([0, 1, 5, 20]), 5) == [(0, 10), (20, 25)]
    assert spans_of(np.array([0, 6]), 5) == [(0, 5), (6, 11)]
    assert spans_of(np.array([], dtype=int), 5) == []


@pytest.mark.parametrize(("seed", "window"), [(1, 8), (2, 20), (3, 35), (4, 2)])
def test_shared_passages(session, seed, window):
    check(session, texts(seed, 80, 6), window)


def test_few_words(session):
    # So few different words that windows repeat everywhere, within one text too.
    check(session, texts(5, 30, 2, vocabulary=2), 8)
    check(session, texts(6, 30, 2, vocabulary=1), 8)


def test_windows_of_crowded_anchors_are_counted(session, monkeypatch):
    monkeypatch.setattr(substring, "PIECES_MOST", 2)
    monkeypatch.setattr(substring, "TASK_PIECES", 5)
    check(session, texts(7, 120, 2), 8)


def test_awkward_rows(session):
    rows = [(i, t) for i, t, _ in AWKWARD]
    long = " ".join(f"x{i % 97}y{i % 89}" for i in range(9000))
    rows += [(None, long), (None, long), (11, "start " + long), (12, "a " * 34), (13, "b " * 35), (14, "c " * 36)]
    rows += [(15, " ".join(f"d{i}" for i in range(35))), (15, "\n".join(f"d{i}" for i in range(35)))]
    rows += [(16, "é ü \xa0 " * 40), (17, "ideo　graphic " * 40)]
    check(session, rows, 35)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "too short")]])
def test_nothing_repeats(session, rows):
    check(session, rows, 35)


def test_windows_have_two_words(session):
    with pytest.raises(ValueError, match="two words"):
        repeated_passages(session.createDataFrame([], "doc_id long, text string"), window=1)


def test_given_documents(session, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = rows_of(op11_relative_lempel_ziv(session, "/root/testdata/sf0.001"))
    expected = [r[:4] for r in brute(rows, 35)]
    assert sorted(got) == sorted(expected)
    assert sum(r[2] for r in got) > 0
