"""Packing of tokenised documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize

SHARD_PIECES = 1 << 15  # pieces that one task packs, about
HOT_ROWS = 1 << 10  # equal pieces beyond are spread over the shards
ROWS = 256


def _printable_bytes() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes.

    Visible Latin-1 characters stand for themselves; the other bytes, in order,
    are written as the code points from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def byte_level_encoding(path: str):
    """A byte-level BPE file of the ``tokenizers`` library as an encoding of ``tiktoken``.

    It gives the same ids four times as fast where every merge's id follows its rank;
    other files are refused.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte_of = _printable_bytes()
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in spec["model"]["vocab"].items()
        if token not in special
    }
    merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"])
    ids = [spec["model"]["vocab"][m] for m in merged]
    if ids != sorted(ids) or spec.get("normalizer"):
        raise ValueError(f"{path}: ids do not follow the ranks of the merges")
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def _encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids; names of special tokens in a text are these tokens."""
    encoding = byte_level_encoding(path)
    special = encoding.special_tokens_set
    return lambda text: np.asarray(
        encoding.encode_to_numpy(text, allowed_special=special, disallowed_special=()),
        dtype="<u4",
    )


def _pieces(path: str, end: int, most: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out: list[tuple] = []
                columns = (part.column(c).to_pylist() for c in ("doc_id", "text"))
                for doc_id, text in zip(*columns, strict=True):
                    ids = np.append(encode(text or ""), np.array([end], dtype="<u4"))
                    first = len(ids) % most or most
                    bounds = [0, *range(first, len(ids) + 1, most)]
                    for i in range(len(bounds) - 1):
                        cut = ids[bounds[i] : bounds[i + 1]]
                        held = (cut,) if keep_ids else ()
                        out.append(
                            (doc_id, i, bounds[i], len(cut), zlib.crc32(cut.tobytes()), *held)
                        )
                if out:
                    arrays = [pa.array(c, t) for c, t in zip(zip(*out), _types(keep_ids))]
                    yield pa.RecordBatch.from_arrays(arrays, names=_names(keep_ids))

    return run


def _names(keep_ids: bool) -> list[str]:
    return ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids


def _types(keep_ids: bool) -> list[pa.DataType]:
    whole = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return whole + [pa.list_(pa.int32())] * keep_ids


def pieces(
    docs: DataFrame, tokenizer: str, *, end: int = 2, capacity: int = 1024, keep_ids: bool = False
) -> DataFrame:
    """The pieces of at most ``capacity`` tokens of every document.

    A document is its token ids and then ``end``.  Only documents beyond the
    capacity are cut; all their pieces are full but for the first.
    """
    held = ", ids array<int>" if keep_ids else ""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer, end, capacity, keep_ids),
        f"doc_id long, piece int, start long, length long, ids_crc32 long{held}",
    )


def _tightest(sizes: list[int], items: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the open sequence with the least room that takes it."""
    open_: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)
    out: list[list[int]] = []
    for i in sorted(items, key=lambda i: -sizes[i]):
        gap = sizes[i] + int((count[sizes[i] :] > 0).argmax())
        if count[gap]:
            count[gap] -= 1
            sequence = open_[gap].pop()
        else:
            gap, sequence = capacity, []
            out.append(sequence)
        sequence.append(i)
        left = gap - sizes[i]
        if left:
            count[left] += 1
            open_[left].append(sequence)
    return out


def sum_of_squares(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items (indexes of ``sizes``) by sequence.

    Each item, the longest first, goes where the sum over all residual gaps of
    the squared number of open sequences with that gap becomes smallest, a new
    sequence being one of the choices; the tightest gap wins a tie.  Sequences
    that this leaves with a gap are emptied again, and their items are placed by
    tightest fit: the rule keeps gaps various while items still come, which at
    the end leaves sequences half full.
    """
    open_: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)
    done: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        if size == capacity:
            done.append([i])
            continue
        # Change of the sum for each gap from size to capacity - 1.  A full
        # sequence is no longer counted, so the gap that fits exactly only loses one.
        have, after = count[size:capacity], count[: capacity - size]
        change = 2 * (after - have) + 2
        change[0] = 1 - 2 * have[0]
        change = np.where(have > 0, change, np.iinfo(np.int64).max)
        best = int(change.argmin())
        if change[best] <= 2 * count[capacity - size] + 1:
            gap = size + best
            count[gap] -= 1
            sequence = open_[gap].pop()
        else:
            gap, sequence = capacity, []
        sequence.append(i)
        if gap == size:
            done.append(sequence)
        else:
            count[gap - size] += 1
            open_[gap - size].append(sequence)
    rest = [i for at in open_ for sequence in at for i in sequence]
    return done + _tightest(sizes, rest, capacity)


def _packed(capacity: int, columns: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        rows = rows.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]
        ).reset_index(drop=True)
        sequences = sum_of_squares(rows["length"].tolist(), capacity)
        order = np.array([i for s in sequences for i in s])
        sequence = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        out = rows.loc[order].assign(sequence_id=(shard << 40) + sequence)
        ends = out.groupby("sequence_id")["length"].cumsum()
        return out.assign(offset=ends - out["length"])[columns]

    return run


def pack(pieces: DataFrame, *, capacity: int = 1024) -> DataFrame:
    """``pieces`` with the sequence each one goes to and its place there.

    Pieces are dealt by hash to shards of some ``SHARD_PIECES``, and each shard is packed
    by itself: the number of tasks grows with the pieces, and the room that shards lose
    against one packing of all is a few sequences each.  Equal rows share a hash; where
    there are very many of them, they are dealt by their place in the table instead.
    """
    held = materialize(pieces.withColumn("salt", F.monotonically_increasing_id()), "cut")
    shards = max(1, math.ceil(held.count() / SHARD_PIECES))
    same = ["doc_id", "piece", "ids_crc32"]
    sizes = held.groupBy(*same).agg(F.count("*").alias("rows")).where(F.col("rows") > HOT_ROWS)
    hot = materialize(sizes.select(F.xxhash64(*same).alias("hash")).distinct(), "hot")
    hashed = held.withColumn("hash", F.xxhash64(*same))
    rows = hashed.join(hot.withColumn("is_hot", F.lit(True)), "hash", "left")
    key = F.when(F.col("is_hot"), F.xxhash64("hash", "salt")).otherwise(F.col("hash"))
    fields = [*pieces.columns, "sequence_id", "offset"]
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return (
        rows.withColumn("shard", F.pmod(key, F.lit(shards)))
        .drop("hash", "is_hot")
        .groupBy("shard")
        .applyInPandas(_packed(capacity, fields), schema)
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    end: int = 2,
    capacity: int = 1024,
    keep_ids: bool = False,
) -> DataFrame:
    """Documents as pieces in sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (the document's
    tokens before it), ``length``, ``ids_crc32`` (of its ids as little-endian
    32-bit words), ``sequence_id``, ``offset`` (its place, gapless from 0), and its
    ``ids`` on request.  A null or empty text is the end token alone.  A very long text
    is many pieces, which go to shards of their own.  A repeated row is packed each time
    it occurs, and a null doc_id is carried along.  Other columns are ignored.  An empty
    table has no pieces.
    """
    cut = pieces(docs, tokenizer, end=end, capacity=capacity, keep_ids=keep_ids)
    return pack(cut, capacity=capacity)
