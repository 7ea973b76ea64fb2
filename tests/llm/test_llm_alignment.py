"""Token alignment against whole-text encodings by the tokenizers' own libraries."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import AWKWARD, rows_of
from tokenizers import Tokenizer

from ledgerline.llm import alignment
from ledgerline.llm.alignment import Aligner, align_tokens, alignment_summary, shared_groups
from ledgerline.llm.queries import PIECE_MODEL, TOKENIZER

ODD = [
    "a  b", "a\n\nb \n c", "\t\ta b", "a\r\nb", "x <s> </s> <|endoftext|> <unk> y", "　a　b",
    "  a", "a  ", "\n", "\n\na", "\na", " \na", "a ▁b", "\x1c \x1d\n!\x1c a", "ﬁ ①②", "中文字符 测试 文字",
    "é é", "a\x00b", " ​ x", "👩‍👩‍👧 🏳️‍🌈", "x" * 300 + " y", "\xa0 \xa0x\xa0 y", "ab" * 2000,
    "中" * 500,
]


class Plain:
    """Whole texts, encoded at once, with cuts from the sets of ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(TOKENIZER)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def tokens(self, text):
        """(ids, bytes) of A and of B, or nothing."""
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False)
        a_bytes = [bytes(self.byte[c] for c in t) for t in a.tokens]
        b = self.b.encode(text)
        b_bytes = []
        for piece in map(self.b.id_to_piece, b):
            if len(piece) == 6 and piece.startswith("<0x"):
                b_bytes.append(bytes.fromhex(piece[3:5]))
            else:
                b_bytes.append(piece.replace("▁", " ").encode())
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return None
        return (a.ids, a_bytes), (b, b_bytes)

    def groups(self, text):
        found = self.tokens(text)
        if not found:
            return []
        ends = []
        for _, tokens in found:
            at, out = 0, []
            for t in tokens:
                at += len(t)
                out.append(at)
            ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        out, low = [], 0
        for cut in cuts:
            out.append(tuple(
                [i for i, e in zip(side[0], e_of) if low < e <= cut]
                for side, e_of in zip(found, ends)
            ))
            low = cut
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def summary(plain, rows):
    """The contract's columns by counting everything one by one."""
    grouped = [(i, plain.groups(t)) for i, t in rows]
    links = [[(a, b) for left, right in g for a in left for b in right] for _, g in grouped]
    count = defaultdict(int)
    for found in links:
        for pair in set(found):
            count[pair] += 1
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, groups), found in zip(grouped, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            i,
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            len(found),
            sum(count[p] == best[p[0]] for p in found),
            sum(count[p] for p in found),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


@given(st.lists(st.integers(1, 60), unique=True), st.lists(st.integers(1, 60), unique=True))
@settings(max_examples=300, deadline=None)
def test_groups_end_at_every_common_end(a, b):
    a, b = sorted({*a, 61}), sorted({*b, 61})
    groups = shared_groups(a, b)
    assert [a[a1 - 1] for _, a1, _, _ in groups] == sorted(set(a) & set(b))
    assert [b[b1 - 1] for *_, b1 in groups] == sorted(set(a) & set(b))
    assert [g[0] for g in groups] == [0, *(g[1] for g in groups[:-1])]
    assert [g[2] for g in groups] == [0, *(g[3] for g in groups[:-1])]


def test_looks_each_end_up_once(monkeypatch):
    looked = []
    find = alignment.bisect_left
    monkeypatch.setattr(alignment, "bisect_left", lambda *a: looked.append(a[1]) or find(*a))
    n = 2000  # the only common ends are the first few, far from the middle
    a = [*range(1, 6), *range(10, 10 + 2 * n, 2), 10 * n]
    b = [*range(1, 6), *range(11, 11 + 2 * n, 2), 10 * n]
    assert len(shared_groups(a, b)) == 6
    assert len(looked) == len(set(looked)) <= len(a)


def test_no_ends():
    assert shared_groups([], []) == []


@given(st.lists(st.text(alphabet="ab é中\n\t\r　\xa0\x1c.,'1▁<s>", max_size=30), max_size=4))
@settings(max_examples=150, deadline=None)
def test_chunks_encode_as_whole_texts(plain_aligner, texts):
    plain, aligner = plain_aligner
    for text, (counts, held, _, _) in zip(texts, aligner.documents(texts)):
        groups = plain.groups(text)
        assert held == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        assert counts[2] == len(groups)


@pytest.fixture(scope="module")
def plain_aligner(plain):
    return plain, Aligner(TOKENIZER, PIECE_MODEL)


def test_forgetting_changes_nothing(plain, documents, monkeypatch):
    texts = [r["text"] for r in documents.limit(40).collect()]
    aligner = Aligner(TOKENIZER, PIECE_MODEL)
    expected = [held for _, held, _, _ in Aligner(TOKENIZER, PIECE_MODEL).documents(texts)]
    monkeypatch.setattr(alignment, "CHUNKS_KEPT", 50)
    for _ in range(2):
        got = [held for t in texts for _, held, _, _ in aligner.documents([t])]
        assert got == expected


def check(session, plain, rows):
    frame = session.createDataFrame(
        [(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n_a int, pairs int, key int"
    )
    got = alignment_summary(frame, TOKENIZER, PIECE_MODEL)
    assert got.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert sorted(map(repr, rows_of(got))) == sorted(map(repr, summary(plain, rows)))


def test_awkward_rows(session, plain):
    rows = [(i, t) for i, t, _ in AWKWARD] + [(100 + i, t) for i, t in enumerate(ODD)]
    check(session, plain, rows)


def test_rare_pairs_are_joined(session, plain, documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]
    rows += rows[:5] + [(None, rows[7][1])]
    for most in (0, 40):
        monkeypatch.setattr(alignment, "FREQUENT_PAIRS", most)
        check(session, plain, rows)


def test_empty_table(session, plain):
    check(session, plain, [])


def test_groups_on_request(session, plain, documents):
    rows = documents.limit(5)
    got = align_tokens(rows, TOKENIZER, PIECE_MODEL, keep_groups=True).collect()
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    for row in got:
        assert [(g["a"], g["b"]) for g in row["groups"]] == plain.groups(texts[row["doc_id"]])


def test_pairs_of_a_long_group_are_counted(plain):
    random.seed(5)
    text = "".join(random.choice("①②③④⑤") for _ in range(400))
    aligner = Aligner(TOKENIZER, PIECE_MODEL)
    a = aligner.a.encode_ordinary(" " + text)
    counts, _, pairs, large = aligner.aligned(a, [*range(3, 3 + len(a) - 1), 40])
    assert counts[3] >= len(pairs) // 8 and large is not None
