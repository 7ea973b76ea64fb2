from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from llm_helpers import AWKWARD, rows_of
from tokenizers import Tokenizer

from ledgerline.llm import packing
from ledgerline.llm.packing import pack_documents, sum_of_squares

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, out, capacity=1024):
    """Every token of every row is in one place, and sequences have no gap and no overlap."""
    want = []
    for doc_id, text, _ in rows:
        ids = ids_of(text)
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want.append((doc_id, i, a, b - a, crc))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in out)
    sequences: dict[int, list] = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_places_every_token_once(session, documents):
    rows = [(r["doc_id"], r["text"], None) for r in documents.collect()]
    out = pack_documents(documents, PATH).collect()
    used = check(rows, out)
    least = -(-sum(r["length"] for r in out) // 1024)
    assert used <= 1.03 * least


def test_shards_pack_by_themselves(docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 20)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("one two three".split(), k=rng.randint(0, 900))), "") for i in range(90)]
    check(rows, pack_documents(docs(rows), PATH).collect())


def test_long_documents_and_equal_rows_are_spread(docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 16)
    monkeypatch.setattr(packing, "HOT_ROWS", 8)
    rows = [(1, "word " * 9000, ""), (2, "other " * 7000, "")] + [(None, "the same", "")] * 60
    out = pack_documents(docs(rows), PATH, capacity=256).collect()
    check(rows, out, 256)
    shards = {r["sequence_id"] >> 40 for r in out if r["doc_id"] is None}
    assert len(shards) > 3
    assert len({r["sequence_id"] >> 40 for r in out if r["doc_id"] == 1}) > 3


def plain_rule(sizes, capacity):
    """The open gaps after the rule, every choice tried out and the squares summed anew."""
    gaps: list[int] = []
    for size in sorted(sizes, reverse=True):
        def cost(i):
            left = gaps[:i] + gaps[i + 1 :] if i is not None else list(gaps)
            gap = (gaps[i] if i is not None else capacity) - size
            left += [gap]
            squares = sum(left.count(g) ** 2 for g in set(left) if g)
            return squares, gap
        fits = [i for i, g in enumerate(gaps) if g >= size]
        best = min([*fits, None], key=cost)
        if best is None:
            gaps.append(capacity - size)
        else:
            gaps[best] -= size
        gaps = [g for g in gaps if g]
    return sorted(gaps)


def test_each_choice_makes_the_sum_of_squares_smallest(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(packing, "_tightest", lambda sizes, items, capacity: [[i] for i in items])
    for _ in range(60):
        sizes = [rng.randint(1, 24) for _ in range(rng.randint(1, 60))]
        sequences = sum_of_squares(sizes, 24)
        # Full sequences come first; the items of the others follow one by one.
        full = [s for s in sequences if sum(sizes[i] for i in s) == 24]
        loose = sum(sizes[i] for s in sequences for i in s) - 24 * len(full)
        gaps = plain_rule(sizes, 24)
        assert loose == 24 * len(gaps) - sum(gaps)


def test_awkward_rows(docs):
    special = [(7, "a<|endoftext|>b 😀 \u00a0x", ""), (8, "x" * 5000, ""), (9, " " * 3000 + "y", "")]
    rows = [*AWKWARD, *special]
    check(rows, pack_documents(docs(rows), PATH).collect())
    assert pack_documents(docs([]), PATH).count() == 0


def test_ids_on_request(docs):
    rows = [(1, "some words to cut into pieces " * 60, "")]
    out = sorted(pack_documents(docs(rows), PATH, capacity=100, keep_ids=True).collect(), key=lambda r: r["piece"])
    assert [i for r in out for i in r["ids"]] == ids_of(rows[0][1])
    check(rows, out, 100)


def test_sum_of_squares_is_near_the_least_number():
    rng = random.Random(5)
    for _ in range(20):
        sizes = [rng.choice([rng.randint(1, 64), rng.randint(1, 20)]) for _ in range(rng.randint(1, 400))]
        sequences = sum_of_squares(sizes, 64)
        assert sorted(i for s in sequences for i in s) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in s) <= 64 for s in sequences)
        assert len(sequences) <= 1.1 * -(-sum(sizes) // 64) + 2
