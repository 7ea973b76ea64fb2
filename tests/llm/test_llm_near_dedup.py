from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_helpers import AWKWARD, rows_of

from ledgerline.llm import near_dedup
from ledgerline.llm.components import components
from ledgerline.llm.near_dedup import band_rows, keep_one, near_duplicates, signature


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    last = max(1, len(words) - size + 1)
    return frozenset(tuple(words[i : i + size]) for i in range(last))


def grouped(rows, size, num, den):
    """The group of each row, by comparing every pair of texts."""
    sets = [shingles(t, size) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    return sets, [root(i) for i in range(len(rows))]


def all_rows(rows, size, num, den):
    """What near_duplicates returns, sorted."""
    sets, group = grouped(rows, size, num, den)
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        names = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        name = min(names) if sets[i] and names else doc_id
        out.append((doc_id, len(sets[i]), name, name is None or name == doc_id))
    return sorted(out, key=repr)


def brute(rows, size, num, den):
    """doc_id: (set size, smallest reachable doc_id), for distinct ids."""
    return {i: (n, c) for i, n, c, _ in all_rows(rows, size, num, den)}


def one_of_each(rows, size, num, den):
    """What keep_one returns: its doc_ids and texts, sorted."""
    sets, group = grouped(rows, size, num, den)
    out = [(i, t) for (i, t, _), s in zip(rows, sets) if not s]
    for g in {group[i] for i in range(len(rows)) if sets[i]}:
        members = [rows[i] for i in range(len(rows)) if group[i] == g]
        order = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).digest())
        out.append(min(members, key=order)[:2])
    return sorted(out, key=repr)


def near_copies(seed, groups=8, copies=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(5, 120))
        for c in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((g * 100 + c, " ".join(words), "s"))
    rng.shuffle(rows)
    return rows


def got(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


@pytest.mark.parametrize(("size", "num"), [(3, 85), (5, 80)])
def test_matches_all_pairs(docs, size, num):
    rows = near_copies(size)
    found = near_duplicates(docs(rows), words=size, threshold=(num, 100))
    assert got(found) == brute(rows, size, num, 100)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def test_clusters_of_many_parts_lose_no_link(docs, monkeypatch):
    """Parts of a few texts: links across parts are only found by the second pass."""
    monkeypatch.setattr(near_dedup, "PART_TEXTS", 4)
    monkeypatch.setattr(near_dedup, "PART_SHINGLES", 300)
    monkeypatch.setattr(near_dedup, "PART_SHINGLES_AGAIN", 300)
    rows = near_copies(9, groups=3, copies=40)
    found = near_duplicates(docs(rows), words=3, threshold=(85, 100))
    assert got(found) == brute(rows, 3, 85, 100)


def test_awkward_rows(docs):
    found = near_duplicates(docs(AWKWARD), words=3, threshold=(85, 100))
    out = sorted(rows_of(found), key=repr)
    assert len(out) == len(AWKWARD)
    assert out.count((5, 6, 5, True)) == 2 and (6, 6, 5, False) in out
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)} <= set(out)
    assert (None, 0, None, True) in out and (None, 1, None, True) in out
    assert out == all_rows(AWKWARD, 3, 85, 100)
    kept = keep_one(docs(AWKWARD), words=3)
    assert kept.columns == docs(AWKWARD).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5]


def test_empty_table(docs):
    assert near_duplicates(docs([]), words=3).count() == 0
    assert keep_one(docs([]), words=3).count() == 0


def shared_ids(seed=4):
    """Near copies whose doc_ids are shared, null or repeated, and rows without words."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, rng.randrange(9), i]), t, s) for i, t, s in near_copies(seed, 6, 9)]
    rows += rng.choices(rows, k=12) + [(None, "", "s"), (None, "", "s"), (3, None, "s"), (3, " ", "s")]
    rows += [(7, "text one of an id", "s"), (7, "another text of it", "s"), (1, "text one of an id", "s")]
    rng.shuffle(rows)
    return rows


def test_texts_are_grouped_not_ids(docs):
    rows = shared_ids()
    found = near_duplicates(docs(rows), words=3, threshold=(85, 100))
    assert sorted(rows_of(found), key=repr) == all_rows(rows, 3, 85, 100)


def test_one_row_of_each_group_stays(docs):
    rows = shared_ids()
    expected = one_of_each(rows, 3, 85, 100)
    for order in (rows, rows[::-1]):
        kept = keep_one(docs(order), words=3, threshold=(85, 100))
        assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == expected


def test_a_unique_text_of_a_shared_id_stays(docs):
    rows = [(7, "text a of some words", "s"), (7, "quite another text b", "s"), (1, "text a of some words", "s")]
    kept = keep_one(docs(rows), words=5, threshold=(80, 100)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, rows[0][1]), (7, rows[1][1])]


def test_rows_that_differ_elsewhere_keep_their_columns(session):
    names = ["doc_id", "text", "key", "node", "row", "hash", "stays", "n", "__gone"]
    rows = [(1, "the same words here", *"abcdefg"), (1, "the same words here", *"hijklmn"), (2, "alone it is", *"opqrstu")]
    frame = session.createDataFrame(rows, names)
    first = keep_one(frame, words=3)
    assert first.columns == names
    got = sorted(rows_of(first))
    assert len(got) == 2 and set(got) <= set(rows) and (2, "alone it is", *"opqrstu") in got
    assert sorted(rows_of(keep_one(session.createDataFrame(rows[::-1], names), words=3))) == got


def test_texts_longer_than_a_part(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "PART_SHINGLES", 50)
    monkeypatch.setattr(near_dedup, "PART_SHINGLES_AGAIN", 50)
    monkeypatch.setattr(near_dedup, "PLACED_BYTES", 100)
    placed = []
    links = near_dedup._links
    monkeypatch.setattr(near_dedup, "_links", lambda t, p, *a: placed.append(p.count()) or links(t, p, *a))
    long = [f"w{i}" for i in range(2000)]
    rows = [(1000 + i, " ".join(long[i:]), "s") for i in range(6)] + near_copies(11, 2, 6)
    found = near_duplicates(docs(rows), words=3, threshold=(85, 100))
    assert got(found) == brute(rows, 3, 85, 100)
    assert placed[0] <= 3 * len(rows)  # the long hub is not dealt to every 50 shingles


def test_short_texts_are_one_shingle(docs):
    rows = [(1, "Two words", ""), (2, "two  WORDS", ""), (3, "words two", ""), (4, "two words more", "")]
    assert got(near_duplicates(docs(rows), words=3)) == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4)}


def test_a_signature_estimates_the_similarity():
    pool = np.random.default_rng(1).integers(0, 1 << 63, 1500, dtype=np.uint64)
    a, b = signature(pool[:1000], 2000), signature(pool[250:1250], 2000)
    assert abs((a == b).mean() - 750 / 1250) < 0.03


def test_bands_find_pairs_at_the_threshold():
    for threshold in (0.8, 0.85):
        r = band_rows(threshold)
        assert (1 - threshold**r) ** (120 // r) <= 1e-6


def test_components_of_chains_and_stars(session):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    loose = [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)]
    edges = [*chain, *star, *loose, (7, 7)]
    rng.shuffle(edges)
    label = {r["node"]: r["component"] for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {n: label.get(n, n) for n in parent} == {n: root(n) for n in parent}
