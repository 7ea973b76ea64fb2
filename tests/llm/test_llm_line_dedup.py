from __future__ import annotations

import random

from llm_helpers import AWKWARD, rows_of
from pyspark.sql import functions as F

from ledgerline.llm.line_dedup import (
    MIN_WORDS,
    NEAR_WORDS,
    deduplicate_lines,
    edits,
    repeated_lines,
)


def distance(a, b):
    """Edit distance over words, in full."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def words(line):
    return [w for w in line.encode().split()]


def brute(rows):
    lines = sorted(
        {
            (i, n, tuple(words(line)))
            for i, t, _ in rows
            if i is not None and t is not None
            for n, line in enumerate(t.split("\n"))
        }
    )
    first, out = {}, []
    for i, n, ws in lines:
        if len(ws) < MIN_WORDS:
            continue
        if ws in first:
            out.append((i, n, *first[ws], 0))
            continue
        near = [
            at
            for other, at in first.items()
            if min(len(ws), len(other)) >= NEAR_WORDS
            and abs(len(ws) - len(other)) <= 1
            and distance(ws, other) == 1
        ]
        if near:
            out.append((i, n, *min(near), 1))
        first[ws] = (i, n)
    return sorted(out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = "red blue green old new big small north south river hill road".split()
    pool = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) for _ in range(40)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 9)):
            ws = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(ws) + 1)
                change = rng.choice(["in", "out", "swap"])
                if change == "in":
                    ws.insert(at, rng.choice(vocabulary))
                elif ws and at < len(ws):
                    ws[at : at + 1] = [] if change == "out" else [rng.choice(vocabulary)]
            lines.append(rng.choice([" ", "  ", "\t"]).join(ws))
        rows.append((i, "\n".join(lines), "s"))
    return rows


def test_matches_all_pairs(docs):
    for seed in (1, 2):
        rows = corpus(seed)
        want = brute(rows)
        assert {r[4] for r in want} == {0, 1}
        assert sorted(rows_of(repeated_lines(docs(rows)))) == want


def test_counters_in_templates(docs):
    """One bucket of many lines that all differ in one word: the earliest stays."""
    rows = [(i, f"page {i} of the long report on the state of the roads", "") for i in range(50)]
    out = sorted(rows_of(repeated_lines(docs(rows))))
    assert out == [(i, 0, 0, 0, 1) for i in range(1, 50)]


def test_equal_lines_of_one_or_two_words(docs):
    """Scripts without spaces and long tokens make lines of one word."""
    for line in ("Les.", "two words", "这一行没有空格但是很长" * 9, "https://a.example/" + "x" * 500):
        rows = [(1, f"{line}\n\nother", ""), (2, f"\n {line}\t", ""), (3, line, "")]
        assert sorted(rows_of(repeated_lines(docs(rows)))) == [(2, 1, 1, 0, 0), (3, 0, 1, 0, 0)]
        out = deduplicate_lines(docs(rows)).collect()
        assert [(r["doc_id"], r["text"]) for r in out] == [(1, rows[0][1])]


def test_short_lines_within_one_word(docs):
    """Inserted, deleted and replaced words at both ends, from 3 words to the halves' 8."""
    rng = random.Random(5)
    pool = [" ".join(rng.choices("a b c d e f".split(), k=n)) for n in (2, 3, 4) for _ in range(12)]
    for n in (7, 8, 9):
        ws = [f"w{n}{i}" for i in range(n)]
        pool += [" ".join(x) for x in (ws, ws[1:], ws[:-1], ["x", *ws], [*ws, "x"], ["y", *ws[1:]])]
    rows = [(i, t, "") for i, t in enumerate(pool)]
    out = sorted(rows_of(repeated_lines(docs(rows))))
    assert out == brute(rows)
    three = [(1, "alpha beta gamma", ""), (2, "alpha beta delta", ""), (3, "alpha beta", ""), (4, "alpha", "")]
    assert rows_of(repeated_lines(docs(three))) == [(2, 0, 1, 0, 1)]


def test_documents_lose_those_lines(docs):
    rows = corpus(3)
    gone = {(i, n) for i, n, *_ in brute(rows)}
    want = {}
    for i, t, _ in rows:
        lines = t.split("\n")
        kept = [line for n, line in enumerate(lines) if (i, n) not in gone]
        if len(kept) == len(lines) or "".join(kept).strip():
            want[i] = "\n".join(kept)
    out = deduplicate_lines(docs(rows))
    assert out.columns == docs(rows).columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want


def test_awkward_rows(docs):
    out = deduplicate_lines(docs(AWKWARD)).collect()
    # The text of document 6 stood in 5 before; the repeated row is one document.
    assert sorted(r["doc_id"] or 0 for r in out) == [0, 0, 1, 2, 3, 4, 5, 5]
    assert sorted(rows_of(repeated_lines(docs(AWKWARD)))) == brute(AWKWARD)
    assert deduplicate_lines(docs([])).count() == 0


def test_one_id_with_two_texts_keeps_what_is_new(docs):
    rows = [(1, "a line that both documents hold here", ""), (2, "a line that both documents hold here", ""),
            (2, "something else that nobody has said before", "")]
    out = deduplicate_lines(docs(rows)).collect()
    assert sorted(r["text"] for r in out) == sorted([rows[0][1], rows[2][1]])


def test_edits(session):
    rng = random.Random(1)
    pairs = [
        ([rng.choice("ab") for _ in range(rng.randint(1, 5))], [rng.choice("ab") for _ in range(rng.randint(1, 5))])
        for _ in range(300)
    ]
    frame = session.createDataFrame(pairs, "a array<string>, b array<string>")
    for r in frame.withColumn("e", edits(F.col("a"), F.col("b"))).collect():
        assert (r["e"] <= 1) == (distance(r["a"], r["b"]) <= 1)
        assert (r["e"] == 0) == (r["a"] == r["b"])


def test_columns_of_any_name_stay(docs):
    frame = docs([(1, "a line of words\nand one more here", "s"), (2, "a line of words\nother words here", "s")])
    out = deduplicate_lines(frame)
    assert out.columns == frame.columns
    got = {r["doc_id"]: tuple(r) for r in out.collect()}
    given = {r["doc_id"]: tuple(r) for r in frame.collect()}
    assert got[1] == given[1]
    assert got[2] == (2, "other words here", *given[2][2:])
