"""Alignment of the tokens of two tokenizers by divide and conquer at shared cuts.

Both tokenizers cover the same bytes, so a byte offset at which a token of each ends is
a cut that no link crosses.  A range of tokens is divided at a common end near its
middle, which a bisection of the other side's ends finds, and both halves are divided
in turn; a range without a common end inside is a group, and each of its tokens is
linked to each of the other side.

No token goes on from anything else into a space or line break: A's pattern parts them,
and B's pieces are tested for it when the model is loaded.  So these places are cuts in
every text; texts are divided there first, and a worker keeps what it has found for the
chunks it met last.

How many documents hold a pair of ids is counted over all documents.  A bounded number
of the most frequent pairs, which make up most of every document, is broadcast; the
others are joined by their pair.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.packing import byte_level_encoding
from ledgerline.session import materialize

ROWS = 256
CHUNK_CHARS = 48  # longer chunks are not kept
CHUNKS_KEPT = 1 << 19  # chunks that a worker remembers, some 200 MB
COUNTED_AT_ONCE = 1 << 22  # pairs that a task holds while it counts
FREQUENT_PAIRS = 1 << 20  # pairs broadcast at most, 16 bytes each
A_BITS = 16  # a pair is the id of A above that many bits for the id of B
SPACE, MARK = " ", "▁"
_SPACE_BEFORE_CUT = re.compile(r"\s[ \n]")

Group = tuple[int, int, int, int]


def shared_groups(a_ends: list[int], b_ends: list[int]) -> list[Group]:
    """Ranges ``(a0, a1, b0, b1)`` of tokens between neighbouring common ends, in order.

    Both lists rise and have the same last value.  Each end of A is looked up once at
    most: what lies between the middle and the cut found holds no other cut.
    """
    out: list[Group] = []
    todo = [(0, len(a_ends), 0, len(b_ends), 0, len(a_ends) - 1)] if a_ends else []
    while todo:
        a0, a1, b0, b1, low, high = todo.pop()  # ends low to high - 1 may be cuts
        last, middle, found = b1 - 1, (low + high) // 2, False
        if b0 < last:
            for far in range(max(high - middle, middle - low + 1)):
                for k in (middle - far, middle + far) if far else (middle,):
                    if low <= k < high:
                        j = bisect_left(b_ends, a_ends[k], b0, last)
                        if j < last and b_ends[j] == a_ends[k]:
                            found = True
                            break
                if found:
                    break
        if not found:
            out.append((a0, a1, b0, b1))
            continue
        above = k + 1 if k >= middle else middle + far
        todo.append((k + 1, a1, j + 1, b1, above, high))
        todo.append((a0, k + 1, b0, j + 1, low, middle - far))
    return out


def _piece_bytes(piece: str) -> bytes:
    byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace(MARK, SPACE).encode()


class Aligner:
    """Both tokenizers, with what their tokens stand for.

    A chunk is named by its text without the space it begins with, or by a tuple of its
    whole text where it begins with several white characters.
    """

    def __init__(self, byte_bpe: str, piece_bpe: str) -> None:
        import sentencepiece

        self.a = byte_level_encoding(byte_bpe)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(rf"[^{MARK}]{MARK}|\n", p) for p in pieces):
            raise ValueError(f"{piece_bpe}: a piece goes on over the start of a word or line")
        self.b_bytes = [_piece_bytes(p) for p in pieces]
        self.a_size = [len(self.a.decode_single_token_bytes(i)) for i in range(self.a.n_vocab)]
        self.b_size = [len(b) for b in self.b_bytes]
        # What is known of chunks, by their number; number 0 is a chunk without tokens.
        self.number: dict[str | tuple[str], int] = {}
        self.groups: list[str] = [""]
        self.pairs: list[bytes] = [b""]
        self.counts = np.zeros((1, 4), dtype=np.int64)
        self.large: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.uses = np.zeros(1, dtype=np.int64)

    @staticmethod
    def chunks(text: str) -> list[str | tuple[str]]:
        """Space and text, divided before each space or line break that follows none."""
        names = text.replace("\n", " \n").split(SPACE)
        if not _SPACE_BEFORE_CUT.search(text) and text[0] not in " \n":
            return names
        merged: list[str] = []
        for name in names:
            chunk = name if name[:1] == "\n" else SPACE + name
            if merged and merged[-1][-1].isspace():
                merged[-1] += chunk
            else:
                merged.append(chunk)
        return [(c,) if c[1:2].isspace() or len(c) == 1 else c.removeprefix(SPACE) for c in merged]

    def encode(self, chunks: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of A and B per chunk; None where B's bytes are not the chunk's.

        Those of A always are, as its tokens are made of bytes.
        """
        mark = self.b.piece_to_id(MARK)
        # B puts a space before every text, which stays apart before a line break.
        given = [c[1:] if c[0] == SPACE else c for c in chunks]
        bytes_of, encode = self.b_bytes.__getitem__, self.a.encode_ordinary
        for chunk, b in zip(chunks, self.b.encode(given, num_threads=1), strict=True):
            if chunk[0] != SPACE:
                if b[:1] != [mark]:
                    raise ValueError("a line break was joined to the space before the text")
                b = b[1:]
            elif chunk == SPACE:  # at the end of a text; B gives nothing for an empty one
                b = [mark]
            same = b"".join(map(bytes_of, b)) == chunk.encode()
            yield (encode(chunk), b) if same else None

    def aligned(self, a: list[int], b: list[int]) -> tuple:
        """Counts of A, B, groups and links, the groups as text, all pairs, pairs counted."""
        a_ends = list(accumulate(map(self.a_size.__getitem__, a)))
        b_ends = list(accumulate(map(self.b_size.__getitem__, b)))
        if a_ends == b_ends:  # every end is a cut
            n = len(a)
            pairs = [x << A_BITS | y for x, y in zip(a, b)]
            texts = [f"{x}|{y}" for x, y in zip(a, b)]
            return (n, n, n, n), ";".join(texts), array("q", pairs).tobytes(), None
        groups = shared_groups(a_ends, b_ends)
        texts, pairs, links, large = [], [], 0, []
        for a0, a1, b0, b1 in groups:
            if a1 - a0 == b1 - b0 == 1:
                x, y = a[a0], b[b0]
                texts.append(f"{x}|{y}")
                pairs.append(x << A_BITS | y)
                links += 1
                continue
            left, right = a[a0:a1], b[b0:b1]
            texts.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            links += len(left) * len(right)
            if len(left) * len(right) <= 256:
                pairs += [x << A_BITS | y for x in left for y in right]
            else:
                (x, m), (y, n) = (np.unique(np.array(i), return_counts=True) for i in (left, right))
                large.append(((x[:, None] << A_BITS | y).ravel(), np.outer(m, n).ravel()))
        counts = (len(a), len(b), len(groups), links)
        return counts, ";".join(texts), array("q", pairs).tobytes(), large

    def learn(self, names: set[str | tuple[str]]) -> None:
        """Number the chunks that are not known yet."""
        new = [n for n in names if n not in self.number]
        whole = [n[0] if type(n) is tuple else n if n[:1] == "\n" else SPACE + n for n in new]
        numbers: list[tuple[int, int, int, int]] = []
        for name, ids in zip(new, self.encode(whole), strict=True):
            if ids is None:
                self.number[name] = 0
                continue
            counts, groups, pairs, large = self.aligned(*ids)
            self.number[name] = at = len(self.groups)
            numbers.append(counts)
            self.groups.append(groups)
            self.pairs.append(pairs)
            if large:
                self.large[at] = large
        if numbers:
            self.counts = np.concatenate([self.counts, np.array(numbers, dtype=np.int64)])
            self.uses = np.append(self.uses, np.zeros(len(numbers), dtype=np.int64))

    def forget(self) -> None:
        """Keep the chunks used most, none of them long, if there are very many."""
        if len(self.groups) <= CHUNKS_KEPT:
            return
        often = np.argsort(-self.uses, kind="stable")[: CHUNKS_KEPT // 2]
        stay = set(often.tolist())
        kept = [(n, i) for n, i in self.number.items() if i in stay and i and len(n) <= CHUNK_CHARS]
        self.number = {n: at for at, (n, _) in enumerate(kept, start=1)}
        order = [0, *(i for _, i in kept)]
        for held in (self.groups, self.pairs):
            held[:] = [held[i] for i in order]
        self.counts, self.uses = self.counts[order], self.uses[order] // 2
        self.large = {at: self.large[i] for at, i in enumerate(order) if i in self.large}

    def documents(self, texts: list[str | None]) -> Iterator[tuple]:
        """Per text the counts, the groups as text, its distinct pairs and their links."""
        divided = [self.chunks(t) if t else [] for t in texts]
        self.forget()
        self.learn({c for t in divided for c in t})
        none = np.empty(0, dtype=np.int64)
        for chunks in divided:
            found = list(map(self.number.__getitem__, chunks))
            at = np.array(found, dtype=np.int64)
            if not found or not at.all():
                yield (0, 0, 0, 0), "", none, none
                continue
            np.add.at(self.uses, at, 1)
            pairs = np.frombuffer(b"".join(map(self.pairs.__getitem__, found)), dtype=np.int64)
            distinct, links = np.unique(pairs, return_counts=True)
            more = [x for i in found if i in self.large for x in self.large[i]] if self.large else []
            if more:
                every = np.concatenate([distinct, *(x[0] for x in more)])
                weight = np.concatenate([links, *(x[1] for x in more)])
                distinct, where = np.unique(every, return_inverse=True)
                links = np.zeros(len(distinct), dtype=np.int64)
                np.add.at(links, where, weight)
            held = ";".join(map(self.groups.__getitem__, found))
            yield tuple(self.counts[at].sum(axis=0).tolist()), held, distinct, links


@lru_cache(maxsize=2)
def _aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    return Aligner(byte_bpe, piece_bpe)


def _parsed(groups: str) -> list[dict[str, list[int]]]:
    sides = [g.split("|") for g in groups.split(";")] if groups else []
    return [{"a": [*map(int, a.split(","))], "b": [*map(int, b.split(","))]} for a, b in sides]


_GROUPS = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
_ALIGNED = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
    ("links", pa.list_(pa.int64())),
]
_ALIGNED_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, links array<long>"
)


def _aligned(byte_bpe: str, piece_bpe: str, keep_groups: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_bpe, piece_bpe)
        schema = pa.schema(_ALIGNED + [("groups", _GROUPS)] * keep_groups)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = list(aligner.documents(part.column("text").to_pylist()))
                if not found:
                    continue
                counts, held, pairs, links = zip(*found)
                digests = [hashlib.sha256(h.encode()).hexdigest() if h else "" for h in held]
                numbers = [pa.array(c, pa.int64()) for c in zip(*counts)]
                offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c), pa.int64()))
                    for c in (pairs, links)
                ]
                arrays = [part.column("doc_id"), *numbers, pa.array(digests, pa.string()), *lists]
                if keep_groups:
                    arrays.append(pa.array([_parsed(h) for h in held], _GROUPS))
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def align_tokens(
    docs: DataFrame, byte_bpe: str, piece_bpe: str, *, keep_groups: bool = False
) -> DataFrame:
    """The tokens of both tokenizers for space and text, in groups between shared cuts.

    ``byte_bpe`` (A) is a byte-level BPE file of the ``tokenizers`` library whose ids
    follow the ranks of its merges, ``piece_bpe`` (B) a ``sentencepiece`` BPE model that
    puts a space before the text.  One row per document: ``doc_id``, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links`` (occurrence pairs within groups), ``groups_sha256`` (of the
    groups as ``a1,a2|b1;a3|b2``; '' without tokens), its distinct ``pairs`` (the id of A
    times 65536 plus that of B) with their ``links``, and on request the ``groups``.

    Names of special tokens are ordinary text.  Null and empty texts, and texts that
    either tokenizer does not give back byte by byte, have no tokens.  A very long text
    is divided at its words and lines; only its distinct pairs are held beside it.
    Repeated rows get one row each, null doc_ids stay, other columns are ignored, and an
    empty table gives an empty result.
    """
    groups = ", groups array<struct<a: array<int>, b: array<int>>>" if keep_groups else ""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _aligned(byte_bpe, piece_bpe, keep_groups), _ALIGNED_DDL + groups
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with the number of rows that hold them, for some rows at a time."""

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "docs"])

    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        held.append(batch.column("pairs").flatten().to_numpy())
        size += len(held[-1])
        if size >= COUNTED_AT_ONCE:
            yield counts(held)
            held, size = [], 0
    if size:
        yield counts(held)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``docs``: how many rows of ``align_tokens`` hold an id pair linked."""
    parts = aligned.select("pairs").mapInArrow(_counted, "pair long, docs long")
    return parts.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The pairs above a number of documents that at most ``most`` pairs reach."""
    step = F.floor(F.log2("docs") * 8)  # some 500 steps, whatever the counts are
    sizes = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    above, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        above = row["step"]
    return counts.where(step >= above if above is not None else F.lit(False))


def _looked_up(table) -> Callable:
    """Sums over the frequent pairs of a row; its other pairs with the best of their A id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs, links = (batch.column(c).flatten().to_numpy() for c in ("pairs", "links"))
            sizes = batch.column("pairs").value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            hit = known[at] == pairs
            count = np.where(hit, docs[at], 0)
            top = best[pairs >> A_BITS]
            sums = np.zeros((2, batch.num_rows), dtype=np.int64)
            np.add.at(sums[0], row, count * links)
            np.add.at(sums[1], row, np.where(hit & (count == top), links, 0))
            rest = np.bincount(row[~hit], minlength=batch.num_rows)
            offsets = pa.array(np.concatenate([[0], np.cumsum(rest)]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(c[~hit])) for c in (pairs, links, top)
            ]
            kept = [batch.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sums[0]), pa.array(sums[1]), *lists],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                       "count_sum", "n_best", "pairs", "links", "top"],
            )

    return run


def alignment_summary(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """Per document what ``align_tokens`` counts, and how usual its links are.

    A pair of ids counts the documents (rows) that hold it linked.  ``n_best`` are a
    document's links whose pair has the highest count that any pair with their A id has,
    ties included; ``count_sum`` is the sum of the counts over its links.  Rows and their
    values as in ``align_tokens``; without tokens all numbers are 0.
    """
    spark = docs.sparkSession
    aligned = materialize(align_tokens(docs, byte_bpe, piece_bpe), "aligned")
    counts = materialize(pair_counts(aligned), "pair-counts")
    # Bounded by the vocabulary of A, and by FREQUENT_PAIRS.
    tops = counts.groupBy(F.shiftright("pair", A_BITS).alias("a")).agg(F.max("docs").alias("docs"))
    best = np.zeros(1 << 17, dtype=np.int64)
    tops = tops.toArrow()
    best[tops.column("a").to_numpy()] = tops.column("docs").to_numpy()
    frequent = _frequent(counts, FREQUENT_PAIRS)
    table = frequent.toArrow()
    pair, docs_of = (table.column(c).to_numpy() for c in ("pair", "docs"))
    order = np.argsort(pair)
    none = np.array([-1])
    shared = spark.sparkContext.broadcast(
        (pair[order], docs_of[order], best) if len(pair) else (none, none, best)
    )
    looked = materialize(
        aligned.mapInArrow(
            _looked_up(shared),
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "count_sum long, n_best long, pairs array<long>, links array<long>, top array<long>",
        ),
        "looked-up",
    )
    # Equal groups have equal pairs, so rows are named by the digest of their groups.
    key = F.unhex(F.substring("groups_sha256", 1, 32)).alias("key")
    rare = (
        looked.where(F.size("pairs") > 0)
        .select(key, F.explode(F.arrays_zip("pairs", "links", "top")).alias("x"))
        .select("key", F.col("x.pairs").alias("pair"), "x.links", "x.top")
        .distinct()
    )
    sums = (
        rare.join(counts.join(frequent.select("pair"), "pair", "left_anti"), "pair")
        .groupBy("key")
        .agg(
            F.sum(F.col("docs") * F.col("links")).alias("rare_sum"),
            F.sum(F.when(F.col("docs") == F.col("top"), F.col("links")).otherwise(0)).alias("rare_best"),
        )
    )
    return looked.withColumn("key", key).join(sums, "key", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
