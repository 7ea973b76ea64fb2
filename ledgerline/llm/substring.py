"""Passages that occur more than once, by relative Lempel-Ziv factors.

A document is factored against blocks of reference text: from each place, greedily, the
longest stretch that the reference holds elsewhere.  What lies inside a factor of a
window's length or more is repeated, and windows across a factor's end are looked up by
themselves.  All documents are reference and are factored, so the work is dealt out by
content:

* *Anchors* are runs of words chosen by their own words alone (closed syncmers: a run is
  one if the smallest hash of its short runs is at either end).  Every window holds one
  at least, and equal windows hold equal anchors at equal places.
* Anchors are counted over all documents.  A window with an anchor that occurs once
  cannot occur twice; the windows left are a small part of the text.
* Windows left that follow one another and begin with the same anchor are a *piece*.
  Equal pieces are one.  The different pieces of an anchor are a block of reference, and
  each is factored against the others there.

Documents of one text are one class and are factored once.  An anchor with very many
different pieces is no block: their windows are counted by their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shingles import hash_words, mix
from ledgerline.session import materialize

WINDOW = 35
SHORT = 3  # words in the runs whose smallest hash chooses an anchor
PIECES_MOST = 1 << 12  # different pieces of an anchor that are one block of reference
TASK_PIECES = 1 << 15  # pieces that a task factors
ROWS = 64
_FACTOR = 0x9E3779B97F4A7C15


def anchor_words(window: int) -> tuple[int, int]:
    """Words of an anchor and of its short runs, so that every window holds an anchor.

    Of any ``anchor - short`` runs one after the other at least one is an anchor.
    """
    short = max(1, min(SHORT, window // 8))
    return (window + 1 + short) // 2, short


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words, from doubled ones."""
    total = np.zeros(max(len(hashes) - size + 1, 0), dtype=np.uint64)
    part, factor, have, done, scale = hashes, _FACTOR, 1, 0, 1
    while size:
        if size & 1:
            total += part[done : done + len(total)] * np.uint64(scale)
            done, scale = done + have, scale * factor % (1 << 64)
        size >>= 1
        if size:
            part = part[:-have] + np.uint64(factor) * part[have:]
            factor, have = factor * factor % (1 << 64), 2 * have
    return mix(total)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` values."""
    part, have = values, 1
    while 2 * have <= size:
        part, have = np.minimum(part[:-have], part[have:]), 2 * have
    n = len(values) - size + 1
    return np.minimum(part[:n], part[size - have :][:n])


def anchors(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text, and their hashes."""
    if len(words) < window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    size, short = anchor_words(window)
    hashes = hash_words(words)
    shorts = _runs(hashes, short)
    least = _least(shorts, size - short + 1)
    n = len(least)
    at = np.flatnonzero((shorts[:n] == least) | (shorts[size - short :][:n] == least))
    return at, _runs(hashes, size)[at].view(np.int64)


def windows_left(n: int, at: np.ndarray, shared: np.ndarray, window: int) -> np.ndarray:
    """The windows, by their first word, all of whose anchors are marked as shared."""
    size, _ = anchor_words(window)
    change = np.zeros(n - window + 2, dtype=np.int64)
    once = at[~shared]
    np.add.at(change, np.maximum(once - (window - size), 0), 1)
    np.add.at(change, np.minimum(once, n - window) + 1, -1)
    return np.flatnonzero(np.cumsum(change)[:-1] == 0)


def pieces(left: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """First window, number of windows and first anchor of each piece."""
    if not len(left):
        return
    first = np.searchsorted(at, left)
    new = np.flatnonzero((np.diff(left, prepend=-2) != 1) | (np.diff(first, prepend=-1) != 0))
    for i, j in zip(new, [*new[1:], len(left)], strict=True):
        yield int(left[i]), int(j - i), int(first[i])


class Reference:
    """A block of reference: different pieces, with an index of all their windows."""

    def __init__(self, held: list[list[bytes]], window: int) -> None:
        self.held, self.window = held, window
        self.index: dict[tuple[bytes, ...], list[tuple[int, int]]] = {}
        for number, words in enumerate(held):
            for i in range(len(words) - window + 1):
                self.index.setdefault(tuple(words[i : i + window]), []).append((number, i))

    def elsewhere(self, number: int, i: int) -> list[tuple[int, int]]:
        words = self.held[number]
        found = self.index.get(tuple(words[i : i + self.window]), [])
        return [place for place in found if place != (number, i)]

    def longest(self, number: int, i: int) -> int:
        """Words from place ``i`` of a piece that also stand elsewhere, if a window does."""
        words, most = self.held[number], 0
        for other, j in self.elsewhere(number, i):
            theirs, length = self.held[other], self.window
            while i + length < len(words) and words[i + length : i + length + 1] == theirs[j + length : j + length + 1]:
                length += 1
            most = max(most, length)
        return most

    def repeated(self, number: int) -> list[int]:
        """The windows of a piece that occur elsewhere, from its factors and their ends."""
        out: list[int] = []
        i, last = 0, len(self.held[number]) - self.window
        while i <= last:
            length = self.longest(number, i)
            if not length:
                i += 1
                continue
            inside = i + length - self.window
            out.extend(range(i, inside + 1))
            # Windows that begin in the factor and end after it may stand elsewhere too.
            across = range(inside + 1, min(i + length - 1, last) + 1)
            out.extend(j for j in across if self.elsewhere(number, j))
            i += length
        return out


def spans_of(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """The words that sorted windows cover, as ranges."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts, prepend=starts[0] - window - 1) > window)
    ends = [*(new[1:] - 1), len(starts) - 1]
    return [(int(starts[i]), int(starts[j]) + window) for i, j in zip(new, ends, strict=True)]


def _key(text: Column) -> Column:
    """128 bits by which equal texts meet."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _texts(part: pa.RecordBatch) -> list[bytes | None]:
    return part.column("text").cast(pa.binary()).to_pylist()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _listed(arrays: list[np.ndarray], of: pa.DataType) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays)).cast(of))


def _anchored(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            found = []
            for text in _texts(part):
                words = (text or b"").split()
                found.append((len(words), *anchors(words, window)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    part.column("doc_id"),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    _listed([at for _, at, _ in found], pa.int32()),
                    _listed([h for _, _, h in found], pa.int64()),
                ],
                names=["key", "doc_id", "n_words", "at", "hashes"],
            )

    return run


_PIECE = pa.list_(
    pa.struct([
        ("at", pa.int32()), ("size", pa.int32()), ("anchor", pa.int64()),
        ("id1", pa.int64()), ("id2", pa.int64()),
    ])
)
_PIECE_DDL = "array<struct<at: int, size: int, anchor: long, id1: long, id2: long>>"


def _signed(digest: bytes) -> tuple[int, int]:
    return (
        int.from_bytes(digest[:8], "little", signed=True),
        int.from_bytes(digest[8:], "little", signed=True),
    )


def _cut(window: int) -> Callable:
    """Texts with their pieces, where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            rows, found = [], []
            shared_at = part.column("shared").to_pylist()
            for row, (text, shared) in enumerate(zip(_texts(part), shared_at, strict=True)):
                words = text.split()
                at, hashes = anchors(words, window)
                marked = np.isin(at, np.array(shared, dtype=np.int64))
                ends = np.cumsum([len(w) + 1 for w in words])
                joined, held = b" ".join(words), []
                for first, size, anchor in pieces(windows_left(len(words), at, marked, window), at):
                    low = int(ends[first - 1]) if first else 0
                    digest = xxhash.xxh3_128_digest(joined[low : int(ends[first + size + window - 2]) - 1])
                    id1, id2 = _signed(digest)
                    held.append({"at": first, "size": size, "anchor": int(hashes[anchor]), "id1": id1, "id2": id2})
                if held:
                    rows.append(row)
                    found.append(held)
            if rows:
                kept = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*(kept.column(c) for c in ("class_id", "key", "text")), pa.array(found, _PIECE)],
                    names=["class_id", "key", "text", "pieces"],
                )

    return run


def _fetched(window: int) -> Callable:
    """The words of the wanted pieces of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("anchor", pa.int64()), ("id1", pa.int64()), ("id2", pa.int64()),
            ("several", pa.bool_()), ("words", pa.string()),
        ])
        for part in _parts(batches):
            out = []
            for text, wanted in zip(_texts(part), part.column("wanted").to_pylist(), strict=True):
                words = text.split()
                for w in wanted:
                    held = b" ".join(words[w["at"] : w["at"] + w["size"] + window - 1])
                    out.append({
                        "anchor": w["anchor"], "id1": w["id1"], "id2": w["id2"],
                        "several": w["several"], "words": held.decode(),
                    })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _factored(window: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The repeated windows of pieces that occur once, in the blocks of their anchors."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["id1", "id2"]).sort_values(["anchor", "id1", "id2"])
        out = []
        for _, group in rows.groupby("anchor", sort=False):
            block = Reference([w.encode().split() for w in group["words"]], window)
            keys = zip(group["id1"], group["id2"], group["several"], strict=True)
            for number, (id1, id2, several) in enumerate(keys):
                found = [] if several else block.repeated(number)
                if found:
                    out.append((id1, id2, found))
        return pd.DataFrame(out, columns=["id1", "id2", "windows"])

    return run


def _windowed(window: int) -> Callable:
    """All windows of pieces, by a 128-bit hash of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            columns: list[list] = [[], [], [], [], [], []]
            held = (part.column(c).to_pylist() for c in ("id1", "id2", "several", "words"))
            for id1, id2, several, text in zip(*held, strict=True):
                words = text.encode().split()
                for i in range(len(words) - window + 1):
                    w1, w2 = _signed(xxhash.xxh3_128_digest(b" ".join(words[i : i + window])))
                    for column, value in zip(columns, (id1, id2, several, i, w1, w2), strict=True):
                        column.append(value)
            if columns[0]:
                types = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=["id1", "id2", "several", "i", "w1", "w2"],
                )

    return run


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_SPANS_DDL = "array<struct<first: long, end: long>>"
_RESULT_DDL = f"n_words long, n_removed long, spans {_SPANS_DDL}, kept_sha256 string, kept string"


def _result(part: pa.RecordBatch, names: list[str], spans: list, keep_text: bool) -> pa.RecordBatch:
    """Words, words removed, their spans and what is kept, for some texts."""
    counts, removed, digests, kept = [], [], [], []
    for text, covered in zip(_texts(part), spans, strict=True):
        words = (text or b"").split()
        left, low = [], 0
        for first, end in covered:
            left += words[low:first]
            low = end
        left += words[low:]
        joined = b" ".join(left)
        counts.append(len(words))
        removed.append(len(words) - len(left))
        digests.append(hashlib.sha256(joined).hexdigest())
        kept.append(joined.decode() if keep_text else None)
    held = [[{"first": a, "end": b} for a, b in covered] for covered in spans]
    return pa.RecordBatch.from_arrays(
        [
            *(part.column(n) for n in names),
            pa.array(counts, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(held, _SPANS),
            pa.array(digests, pa.string()),
            pa.array(kept, pa.string()),
        ],
        names=[*names, "n_words", "n_removed", "spans", "kept_sha256", "kept"],
    )


def _covered(window: int, keep_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            spans = [
                spans_of(np.unique(np.array(starts, dtype=np.int64)), window)
                for starts in part.column("starts").to_pylist()
            ]
            yield _result(part, ["key"], spans, keep_text)

    return run


def _whole(keep_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield _result(part, ["doc_id", "key"], [[]] * part.num_rows, keep_text)

    return run


def _repeated_windows(unlike: DataFrame, window: int) -> DataFrame:
    """``id1``, ``id2``, ``windows``: repeated windows of pieces that occur once.

    ``unlike`` has the different pieces of the anchors that have several.
    """
    sizes = materialize(unlike.groupBy("anchor").agg(F.count("*").alias("n")), "anchor-sizes")
    sized = unlike.join(sizes.hint("merge"), "anchor")
    blocks = max(1, unlike.count() // TASK_PIECES)
    factored = (
        sized.where(F.col("n") <= PIECES_MOST)
        .drop("n")
        .withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(_factored(window), "id1 long, id2 long, windows array<int>")
    )
    many = sized.where(F.col("n") > PIECES_MOST).select("id1", "id2", "several", "words")
    if many.isEmpty():
        return factored
    windows = materialize(
        many.mapInArrow(
            _windowed(window), "id1 long, id2 long, several boolean, i int, w1 long, w2 long"
        ),
        "windows",
    )
    again = materialize(
        windows.groupBy("w1", "w2")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("w1", "w2"),
        "again",
    )
    counted = (
        windows.where("NOT several")
        .join(again.hint("merge"), ["w1", "w2"])
        .groupBy("id1", "id2")
        .agg(F.collect_set("i").alias("windows"))
    )
    return factored.union(counted)


def repeated_passages(docs: DataFrame, *, window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """Per document the words that lie in a window of words which occurs anywhere else.

    ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (ranges of word numbers, from 0,
    end exclusive), ``kept_sha256`` (of the words outside them, joined by one space) and,
    on request, that text as ``kept`` (else null).  Words are runs without ASCII white
    space, as they are.  A window that begins at two places of one document counts, and
    so do overlapping ones.  Windows are judged on the input: all copies are covered.

    Null and empty texts, and texts of fewer words than a window, have no spans.  Rows of
    one text, repeated rows included, cover one another whole.  Null doc_ids stay.  A very
    long text is one row of anchors and pieces.  Other columns are ignored; an empty
    table gives an empty result.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", _key(F.col("text")))
    classes = materialize(
        keyed.where(F.length("text") >= 2 * window - 1)
        .mapInArrow(
            _anchored(window),
            "key binary, doc_id long, n_words long, at array<int>, hashes array<long>",
        )
        .where(F.col("n_words") >= window)
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("rep"),
            F.first("at").alias("at"),
            F.first("hashes").alias("hashes"),
        )
        .withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    rows = classes.select("class_id", F.explode(F.arrays_zip("at", "hashes")).alias("x")).select(
        "class_id", "x.at", F.col("x.hashes").alias("anchor")
    )
    shared = materialize(
        rows.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "shared"
    )
    marked = (
        rows.join(shared.hint("merge"), "anchor")
        .groupBy("class_id")
        .agg(F.collect_list("at").alias("shared"))
        .join(classes.select("class_id", "key", "rep"), "class_id")
    )
    marked = materialize(marked, "marked")
    texts = materialize(
        keyed.join(marked.hint("merge"), "key")
        .where(F.col("doc_id").eqNullSafe(F.col("rep")))
        .select("class_id", "key", "text", "shared")
        .mapInArrow(_cut(window), f"class_id long, key binary, text string, pieces {_PIECE_DDL}"),
        "pieces",
    )
    placed = texts.select("class_id", F.explode("pieces").alias("p")).select(
        "class_id", "p.*", F.xxhash64("class_id", "p.at").alias("place")
    )
    # Places are compared, not counted: rows of one text without a doc_id come together.
    different = materialize(
        placed.groupBy("id1", "id2").agg(
            F.first("anchor").alias("anchor"),
            F.min("place").alias("place"),
            (F.min("place") < F.max("place")).alias("several"),
        ),
        "different",
    )
    unlike_anchors = different.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = different.join(unlike_anchors, "anchor").select("id1", "id2", "place", "several")
    found_at = (
        placed.join(materialize(wanted, "wanted").hint("merge"), ["id1", "id2", "place"])
        .groupBy("class_id")
        .agg(F.collect_list(F.struct("at", "size", "anchor", "id1", "id2", "several")).alias("wanted"))
    )
    unlike = materialize(
        texts.select("class_id", "text")
        .join(found_at, "class_id")
        .mapInArrow(
            _fetched(window), "anchor long, id1 long, id2 long, several boolean, words string"
        )
        .dropDuplicates(["id1", "id2"]),
        "unlike",
    )
    once = _repeated_windows(unlike, window)
    several = different.where("several").select(
        "id1", "id2", F.lit(None).cast("array<int>").alias("windows")
    )
    hits = materialize(several.union(once), "hits")
    every = F.sequence(F.lit(0), F.col("size") - 1)
    starts = (
        placed.join(hits.hint("merge"), ["id1", "id2"])
        .select("class_id", F.transform(F.coalesce("windows", every), lambda i: F.col("at") + i).alias("s"))
        .groupBy("class_id")
        .agg(F.flatten(F.collect_list("s")).alias("starts"))
    )
    covered = (
        texts.select("class_id", "key", "text")
        .join(starts, "class_id")
        .select("key", "text", "starts")
        .mapInArrow(_covered(window, keep_text), f"key binary, {_RESULT_DDL}")
        .dropDuplicates(["key"])
    )
    copied = classes.where("copies > 1").select("key", F.lit(True).alias("copied"))
    found = covered.select("key", F.struct("n_removed", "spans", "kept_sha256", "kept").alias("found"))
    changed = materialize(found.join(copied, "key", "full"), "changed")
    whole = keyed.select("doc_id", "key", "text").mapInArrow(
        _whole(keep_text), f"doc_id long, key binary, {_RESULT_DDL}"
    )
    joined = whole.join(changed.hint("merge"), "key", "left")
    all_gone = F.col("copied").eqNullSafe(True)
    empty = F.lit("").alias("kept") if keep_text else F.lit(None).cast("string")

    def chosen(name: str, copied_value: Column) -> Column:
        return F.when(all_gone, copied_value).otherwise(F.coalesce(f"found.{name}", name)).alias(name)

    return joined.select(
        "doc_id",
        "n_words",
        chosen("n_removed", F.col("n_words")),
        chosen("spans", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))),
        chosen("kept_sha256", F.sha2(F.lit("").cast("binary"), 256)),
        chosen("kept", empty),
    )
