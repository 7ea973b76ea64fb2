from __future__ import annotations

import hashlib
import random

import numpy as np
from llm_helpers import AWKWARD, rows_of

from ledgerline.llm.fingerprint import FACTORS, Fingerprint, edited, fingerprints, of_text
from ledgerline.llm.shingles import hash_words, mix


def brute(rows):
    """doc_id: what the fingerprints of whole texts say."""
    named = sorted(((i, t or "") for i, t, _ in rows if i is not None), reverse=True)
    out = {}
    for n, (doc_id, text) in enumerate(named):
        after = named[(n + 1) % len(named)][1]
        changed = edited(text, after)
        a, b, c = of_text(text), of_text(changed), of_text(after)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out[doc_id] = (len(text), sha, str(a), str(b), a.likeness(b), a.likeness(c))
    return out


def plain(text):
    """The lanes by whole numbers, a paragraph and a run at a time."""
    exact, sketch = [0] * 16, [0] * 256
    for line in text.encode().split(b"\n"):
        held = hashlib.blake2b(line).digest() + hashlib.blake2b(line, person=b"more").digest()
        for lane in range(16):
            exact[lane] += int.from_bytes(held[8 * lane : 8 * lane + 8], "little")
        words = [int(hash_words([w])[0]) for w in line.split()]
        size = min(3, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            run = sum(int(f) * w for f, w in zip(FACTORS, words[at : at + size], strict=False))
            run = int(mix(np.array([run % 2**64], dtype=np.uint64))[0])
            sketch[(run >> 40) % 256] += -1 if run >> 63 else 1
    return [x % 2**64 for x in exact], sketch


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
    both = dot(a[1], a[1]) + dot(b[1], b[1])
    return min(1.0, max(0.0, 2 * dot(a[1], b[1]) / both)) if both else 0.0


def test_matches_whole_numbers(docs):
    """The query's fingerprints and likeness against lanes that were added up plainly."""
    rng = random.Random(11)
    texts = ["", "a", "a b", "\n\n", "a b c\nd e f g\n", "é ü\nß"]
    texts += ["\n".join(" ".join(rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(rng.randint(1, 12))) for _ in range(30)]
    got = {r["doc_id"]: r for r in fingerprints(docs([(i, t, "") for i, t in enumerate(texts)])).collect()}
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        after = texts[i - 1]
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        own, own_changed, following = plain(text), plain(changed), plain(after)
        for column, want in (("fingerprint", own), ("edited_fingerprint", own_changed)):
            held = Fingerprint.parse(got[i][column])
            assert held.exact.tolist() == want[0]
            assert held.sketch.view(np.int32).tolist() == want[1]
        assert got[i]["near_edited"] == plain_likeness(own, own_changed)
        assert got[i]["near_next"] == plain_likeness(own, following)


def test_matches_whole_texts(documents):
    rows = [(r["doc_id"], r["text"], None) for r in documents.collect()]
    got = {r[0]: r[1:] for r in rows_of(fingerprints(documents))}
    assert got == brute(rows)
    near = np.array([r[4:] for r in got.values() if r[0] > 500])
    assert near[:, 0].mean() > 0.5 > 0.1 > near[:, 1].mean()


def test_awkward_rows(docs):
    rows = [r for r in AWKWARD if r != AWKWARD[7]]
    out = rows_of(fingerprints(docs(rows)))
    assert {r[0]: r[1:] for r in out if r[0] is not None} == brute(rows)
    alone = {r[1]: r for r in out if r[0] is None}
    assert alone[10][2] == hashlib.sha256(b"no id h").hexdigest()
    assert alone[0][5:] == (1.0, 1.0)
    twice = rows_of(fingerprints(docs(AWKWARD)))
    assert len(twice) == len(AWKWARD)
    assert fingerprints(docs([])).count() == 0
    one = rows_of(fingerprints(docs([(1, "abcdef", "")])))
    assert one[0][2] == hashlib.sha256(b"abcdab").hexdigest()


def test_sums_do_not_depend_on_order_and_can_be_undone():
    rng = random.Random(2)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(60)]
    whole = of_text("\n".join(lines))
    mixed = of_text("\n".join(rng.sample(lines, 60)))
    assert str(whole) == str(mixed)
    parts = of_text("\n".join(lines[:25])) + of_text("\n".join(lines[25:]))
    assert str(parts) == str(whole)
    assert str(whole - of_text(lines[3])) == str(of_text("\n".join(lines[:3] + lines[4:])))
    assert str(Fingerprint.parse(str(whole))) == str(whole)
    assert str(of_text("a b c\nd")) != str(of_text("a b c d"))


def test_likeness_follows_the_share_of_common_runs():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    a, b = rng.choices(words, k=900), rng.choices(words, k=900)
    for share in (0.0, 0.3, 0.6, 0.9):
        cut = int(900 * share)
        got = of_text(" ".join(a)).likeness(of_text(" ".join(a[:cut] + b[cut:])))
        assert abs(got - share) < 0.2


def test_one_run_very_often(docs):
    """Counts of a lane beyond 16 bits: two thirds of the text stay."""
    text = "spam " * 100_000
    after = " ".join(f"w{i}" for i in range(60_000))
    whole, changed = of_text(text), of_text(edited(text, after))
    assert 0.9 < whole.likeness(changed) < 0.95
    assert Fingerprint.parse(str(whole)).likeness(Fingerprint.parse(str(changed))) == whole.likeness(changed)
    got = {r["doc_id"]: r["near_edited"] for r in fingerprints(docs([(2, text, ""), (1, after, "")])).collect()}
    assert got[2] == whole.likeness(changed)
