"""Spelling variants against comparing all words with one another."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import AWKWARD, rows_of

from ledgerline.llm import spelling
from ledgerline.llm.spelling import Grams, near_words, spelling_variants, word_counts

LETTERS = "abcdeéß"


def edits(word, letters=LETTERS):
    """All strings one edit away."""
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b}
    out |= {a + c + b[1:] for a, b in cut if b for c in letters}
    out |= {a + c + b for a, b in cut for c in letters}
    return out - {word}


def counted(rows, drop_every):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def brute(rows, drop_every=97):
    words = counted(rows, drop_every)
    letters = sorted({c for w in words for c in w})
    near = {w: sorted(x for x in edits(w, letters) if x in words) for w in words}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 2 * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def check(session, rows, drop_every=97):
    frame = session.createDataFrame(
        [(i, t, 1, "w", "f") for i, t in rows], "doc_id long, text string, n int, word string, form string"
    )
    got = spelling_variants(frame, drop_every=drop_every)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(repr, rows_of(got))) == sorted(map(repr, brute(rows, drop_every)))


def invented(seed, n):
    """Words of a few syllables and their misspellings, with counts that fall off."""
    rng = random.Random(seed)
    parts = ["la", "tion", "re", "é", "en", "tra", "ß", "ou"]
    out = []
    for _ in range(n):
        word = "".join(rng.choice(parts) for _ in range(rng.randint(2, 5)))
        out += [word] * rng.choice([1, 3, 7, 20])
        if rng.random() < 0.6:
            out += [rng.choice(sorted(edits(word)))] * rng.choice([1, 3, 4])
    rng.shuffle(out)
    return out


@given(st.lists(st.text(LETTERS, min_size=5, max_size=10), max_size=40), st.integers(0, 6), st.data())
@settings(max_examples=400, deadline=None)
def test_an_edit_leaves_a_merged_list_in_common(words, often, data):
    total = Counter(
        w[p : p + s] for w in words for s in range(2, 5) for p in range(len(w) - s + 1)
    )
    grams = Grams.pruned(dict(total), often)
    word = data.draw(st.sampled_from(words) if words else st.text(LETTERS, min_size=5, max_size=8))
    other = data.draw(st.sampled_from(sorted(edits(word))))
    whole = grams.decompose(word)
    shared = Counter(g for _, g in whole) & Counter(g for _, g in grams.decompose(other))
    assert sum(shared.values()) >= len(whole) - grams.bound(word, whole)
    (mine, enough), (theirs, also) = grams.lists(word), grams.lists(other)
    if enough or also:
        longer = len(other) - len(word)
        assert any(g == h and q - p in (0, longer) for p, g in mine for q, h in theirs)


def test_the_dictionary_extends_frequent_grams_only():
    counts = {"ab": 10, "abc": 7, "abd": 3, "abcd": 7, "cd": 3, "cde": 3}
    grams = Grams.pruned(counts, 4)
    assert grams.longer == {"abc", "abcd"}  # "abd" is rare, "cd" is not extended
    assert grams.left == {"ab": 3, "abc": 0, "abcd": 7, "cd": 3}
    assert grams.decompose("abcde") == [(0, "abcd"), (3, "de")]


def test_invented_words(session):
    words = invented(3, 500)
    check(session, [(i, " ".join(words[i::7]).title()) for i in range(7)] + [(7, " ".join(words))])


def test_long_lists_and_small_blocks(session, monkeypatch):
    words = invented(4, 300)
    rows = [(i, " ".join(words[i::5])) for i in range(5)]
    for most in (0, 30):
        monkeypatch.setattr(spelling, "LIST_MOST", most)
        monkeypatch.setattr(spelling, "BLOCK_ROWS", 100)
        monkeypatch.setattr(spelling, "TILE", 50)
        check(session, rows, 11)


def test_given_documents(session, documents):
    check(session, [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()])


def test_awkward_rows(session):
    rows = [(i, t) for i, t, _ in AWKWARD]
    rows += [(None, "Straße straße strasse strase ×÷×÷× ÀÉÎÕÜ àéîõü " * 4), (9, "a" * 3000 + " ")] * 3
    check(session, rows)
    check(session, rows, None)


def test_chains_lead_to_the_last_form(session):
    counts = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "aihgf": 48, "jihgf": 96}
    rows = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    check(session, rows, None)
    frame = session.createDataFrame(rows, "doc_id long, text string")
    assert {r["root"] for r in spelling_variants(frame).collect()} == {"jihgf"}


def test_ties_go_by_code_point(session):
    rows = [(1, "abcde " * 3 + "abcdf abcdg " * 6 + "ébcde " * 6)]
    check(session, rows, None)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a b c")]])
def test_no_words(session, rows):
    check(session, rows)


def test_near_words_go_both_ways(session):
    words = session.createDataFrame([("abcde", 4), ("abcdf", 9), ("xyzzy", 9)], "word string, n long")
    assert sorted(rows_of(near_words(words))) == [
        ("abcde", 4, "abcdf", 9),
        ("abcdf", 9, "abcde", 4),
    ]


def test_word_counts_without_letters_left_out(session):
    frame = session.createDataFrame([(1, "Words words WORDS wörds")], "doc_id long, text string")
    assert rows_of(word_counts(frame)) == [("words", 3)]
