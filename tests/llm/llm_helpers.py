"""Rows that every operator must stand."""

from __future__ import annotations

TESTDATA = "/root/testdata/sf0.001"

# Nulls in any column, empty and blank texts, a long text, a repeated row.
LONG = "\n".join(f"line {i} holds some words of a very long text number {i * i}" for i in range(250)) + "\n" + "and on " * 1500
AWKWARD = [
    (None, None, None),
    (None, "no id here", "a"),
    (1, None, "a"),
    (2, "", None),
    (3, " \n\t ", "b"),
    (4, LONG, "b"),
    (5, "same row twice, word for word the same", "c"),
    (5, "same row twice, word for word the same", "c"),
    (6, "same row twice, word for word the same", "c"),
]


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]
