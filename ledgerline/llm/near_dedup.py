"""Near-duplicate groups by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum
and its maximum, so half the hash evaluations fill a signature.  Values are
banded; texts that share a band are candidates, and every link is confirmed on
the full shingle sets.

Copies of one text are one class, which is the node of every link: a doc_id only names
the classes it is in.  A bucket of the banding is not expanded into pairs: it names one
hub, the class that shares most buckets, and hubs gather their buckets into clusters.  Tasks hold a bounded part
of a cluster, compare all texts of that part at once and return a spanning
forest of the links.  Where a cluster has several parts, what is still not in
its main component is then compared with every other text of the cluster.  So no
link between two candidates is lost, and only links that join something are
written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.shingles import shingle_sets
from ledgerline.session import materialize

PERMUTATIONS = 60
MISS = 1e-6  # chance at most that a pair at the threshold shares no band
# Shingles and texts that one task compares, in the first pass and in the second.
PART_SHINGLES, PART_SHINGLES_AGAIN, PART_TEXTS = 1 << 15, 1 << 16, 1 << 10
VOCABULARY = 4096  # shingles counted at once
PLACED_BYTES = 8 << 20  # shingle sets that go to Spark at once
ROWS = 256


def band_rows(threshold: float, values: int = 2 * PERMUTATIONS, miss: float = MISS) -> int:
    """The longest bands that still find a pair at the threshold but for ``miss``."""
    fit = [r for r in range(1, values + 1) if (1 - threshold**r) ** (values // r) <= miss]
    if not fit:
        raise ValueError(f"{values} signature values cannot find pairs at {threshold}")
    return max(fit)


def signature(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Minimum and maximum of the hashes under each permutation, side by side."""
    rng = np.random.default_rng(20240607)
    a = rng.integers(0, 1 << 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, permutations, dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    low = np.full(permutations, np.iinfo(np.uint32).max, dtype=np.uint32)
    high = np.zeros(permutations, dtype=np.uint32)
    for i in range(0, len(x), VOCABULARY):
        hashed = a[:, None] * x[None, i : i + VOCABULARY] + b[:, None]
        # Odd factors keep the order of low bits; this stirs high bits into them.
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x2C1B3C6D)
        low = np.minimum(low, hashed.min(axis=1))
        high = np.maximum(high, hashed.max(axis=1))
    return np.stack([low, high], axis=1).ravel()


def _bands(sig: np.ndarray, rows: int) -> np.ndarray:
    n = len(sig) // rows
    out = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in sig[: n * rows].reshape(n, rows).T:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _features(size: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                digests, sizes, bands = [], [], []
                for digest, shingles in shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), size):
                    digests.append(digest)
                    sizes.append(len(shingles))
                    bands.append(_bands(signature(shingles), rows) if len(shingles) else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("key"),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "key", "digest", "n_shingles", "bands"],
                )

    return run


def _placed_sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """The rows, each a place of a text, with the shingle set in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n in _PLACED.names if n != "shingles"]
        known, held = None, b""
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            begin, sets, bytes_ = 0, [], 0
            for row, node in enumerate(nodes):
                if node != known:  # rows of one text follow one another
                    ((_, shingles),) = shingle_sets([texts[row].as_py()], size)
                    known, held = node, shingles.tobytes()
                sets.append(held)
                bytes_ += len(held)
                if bytes_ >= PLACED_BYTES or row + 1 == len(nodes):
                    part = batch.slice(begin, len(sets))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(n) for n in names), pa.array(sets, pa.binary())],
                        names=[*names, "shingles"],
                    )
                    begin, sets, bytes_ = row + 1, [], 0

    return run


_PLACED = pa.schema(
    [
        ("hub", pa.int64()),
        ("part", pa.int64()),
        ("probe", pa.bool_()),
        ("component", pa.int64()),
        ("node", pa.int64()),
        ("shingles", pa.binary()),
    ]
)
_PLACED_DDL = (
    "hub long, part long, probe boolean, component long, node long, shingles binary"
)


def _common(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets in ``rows`` with all sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.diff(np.append(starts, len(values)))
    token = np.repeat(np.cumsum(counts > 1) - 1, counts)
    shared = np.repeat(counts > 1, counts)
    token, owner = token[shared], owner[shared]
    out = np.zeros((len(rows), len(sets)), dtype=np.float32)
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, VOCABULARY):
        lo, hi = np.searchsorted(token, [at, at + VOCABULARY])
        block = np.zeros((len(sets), VOCABULARY), dtype=np.float32)
        block[owner[lo:hi], token[lo:hi] - at] = 1
        out += block[rows] @ block.T
    return out.astype(np.int64)


def _least_reached(linked: np.ndarray, probes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Per group the smallest group that links between its members and others reach."""
    label = np.arange(group.max() + 1)
    while True:
        before = label.copy()
        of = label[group]
        np.minimum.at(label, group[probes], np.where(linked, of, len(label)).min(axis=1))
        back = np.where(linked, label[group[probes]][:, None], len(label)).min(axis=0)
        np.minimum.at(label, group, back)
        label = label[label]
        if (label == before).all():
            return label


def _linked(num: int, den: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What links inside one place join: the probes are compared with everything there."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "probe"], kind="stable").drop_duplicates(
            "node", keep="last"
        )
        sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"]]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        probes = np.flatnonzero(rows["probe"].to_numpy())
        if not len(probes):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        names, group = np.unique(rows["component"].to_numpy(), return_inverse=True)
        common = _common(sets, probes)
        union = sizes[probes][:, None] + sizes[None, :] - common
        linked = (den * common >= num * union) & (common > 0)
        label = _least_reached(linked, probes, group)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": names[moved], "b": names[label[moved]]})

    return run


def _links(texts: DataFrame, places: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Confirmed links between the classes that meet at a place (hub, part)."""
    # A text with very many places is a split join, not a list of its places.
    return (
        materialize(places, "places")
        .join(texts.hint("merge"), "node")
        .mapInArrow(_placed_sets(size), _PLACED_DDL)
        .groupBy("hub", "part")
        .applyInPandas(_linked(num, den), "a long, b long")
    )


def _parts(shingles: Column, texts: Column, most: Column) -> Column:
    return F.greatest(F.ceil(shingles / most), F.ceil(texts / PART_TEXTS))


def _clusters(classes: DataFrame) -> DataFrame:
    """``hub``, ``node``, ``n_shingles``: each pair that shares a band shares a hub."""
    rows = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    # Tables of their own, here and below, so that joins on hot keys can be split.
    sizes = materialize(
        rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes"
    )
    members = materialize(rows.join(sizes, "bucket"), "members")
    score = members.groupBy("node").agg(F.sum("n").alias("score"))
    hubs = materialize(
        members.join(score, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("score", (-F.col("node")).alias("least"))).alias("most"))
        .select("bucket", (-F.col("most.least")).alias("hub")),
        "hubs",
    )
    return members.join(hubs, "bucket").select("hub", "node", "n_shingles").distinct()


def _key(text: Column) -> Column:
    """128 bits by which equal texts meet."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


@dataclass(frozen=True)
class _Groups:
    """``rows``: ``doc_id``, ``key``, ``n_shingles``, ``node`` of every row, the last null
    without words; ``names``: ``node``, ``component`` (a node), ``name`` (its least doc_id)."""

    rows: DataFrame
    names: DataFrame


def _groups(docs: DataFrame, words: int, threshold: tuple[int, int]) -> _Groups:
    num, den = threshold
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    given = given.withColumn("key", _key(F.col("text")))
    features = materialize(
        given.mapInArrow(
            _features(words, band_rows(num / den)),
            "doc_id long, key binary, digest binary, n_shingles long, bands array<long>",
        ),
        "features",
    )
    classes = materialize(
        features.where("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("name"),
            F.min("key").alias("key"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    clusters = materialize(_clusters(classes), "clusters")
    # One text of each class that has a candidate; copies are dropped before the shuffle.
    wanted = clusters.select("node").distinct().join(classes.select("node", "key"), "node")
    texts = materialize(
        given.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
        .join(wanted, "key")
        .select("node", "text"),
        "texts",
    )

    # The first pass: every part of a cluster holds its hub and compares all it has.  A
    # part is twice the hub at least, so that hubs add no more than half of what is dealt.
    hub_size = F.max(F.when(F.col("node") == F.col("hub"), F.col("n_shingles")).otherwise(0))
    parts = materialize(
        clusters.groupBy("hub")
        .agg(
            _parts(
                F.sum("n_shingles") - hub_size,
                F.count("*"),
                F.greatest(F.lit(PART_SHINGLES), 2 * hub_size),
            ).alias("parts")
        )
        .where("parts > 0"),
        "parts",
    )
    dealt = clusters.join(parts, "hub")
    place = F.pmod(F.xxhash64("node"), F.col("parts"))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    first = dealt.select(
        "hub",
        F.explode(F.when(F.col("node") == F.col("hub"), everywhere).otherwise(F.array(place)))
        .alias("part"),
        F.lit(True).alias("probe"),
        F.col("node").alias("component"),
        "node",
    )
    links = materialize(_links(texts, first, words, num, den), "links")

    # The second pass: clusters of several parts that are not one component yet.
    large = dealt.where("parts > 1")
    if not large.isEmpty():
        label = components(links)
        large = materialize(
            large.join(label.withColumnRenamed("component", "reached"), "node", "left").select(
                "hub", "node", "n_shingles", F.coalesce("reached", "node").alias("component")
            ),
            "large",
        )
        weights = large.groupBy("hub", "component").agg(
            F.sum("n_shingles").alias("w"),
            F.count("*").alias("n"),
            F.max("n_shingles").alias("longest"),
        )
        main = weights.groupBy("hub").agg(
            F.max(F.struct("w", "component", "n")).alias("most"),
            F.sum("w").alias("w"),
            F.sum("n").alias("n"),
            F.greatest(F.lit(PART_SHINGLES_AGAIN), 2 * F.max("longest")).alias("room"),
        ).select(
            "hub",
            F.col("most.component").alias("main"),
            _parts(F.col("w"), F.col("n"), F.col("room")).alias("parts"),
            _parts(
                F.col("w") - F.col("most.w"), F.col("n") - F.col("most.n"), F.col("room")
            ).alias("probe_parts"),
        ).where("probe_parts > 0")
        main = materialize(main, "main")
        held = large.join(main, "hub")
        of = F.pmod(F.xxhash64("node"), F.col("parts"))
        as_probe = F.pmod(F.xxhash64("node", F.lit(1)), F.col("probe_parts"))
        members = held.select(
            "hub", "node", "component", F.lit(False).alias("probe"),
            F.explode(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("probe_parts") - 1),
                    lambda i: i * F.col("parts") + of,
                )
            ).alias("part"),
        )
        probes = held.where("component <> main").select(
            "hub", "node", "component", F.lit(True).alias("probe"),
            F.explode(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                    lambda i: as_probe * F.col("parts") + i,
                )
            ).alias("part"),
        )
        second = members.unionByName(probes).select("hub", "part", "probe", "component", "node")
        links = links.union(materialize(_links(texts, second, words, num, den), "links"))

    reached = components(links).withColumnRenamed("component", "reached")
    labelled = materialize(
        classes.select("node", "name")
        .join(reached, "node", "left")
        .select("node", "name", F.coalesce("reached", "node").alias("component")),
        "labelled",
    )
    least = materialize(labelled.groupBy("component").agg(F.min("name").alias("name")), "names")
    nodes = classes.select("digest", "node")
    rows = features.drop("bands").join(nodes.hint("merge"), "digest", "left").drop("digest")
    return _Groups(rows, labelled.drop("name").join(least.hint("merge"), "component"))


def near_duplicates(
    docs: DataFrame, *, words: int = 5, threshold: tuple[int, int] = (80, 100)
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``.

    Two texts are linked if ``den * |A & B| >= num * |A | B|`` for their sets of distinct
    shingles, with ``threshold = (num, den)``; texts of the same words are one class and
    always linked.  ``component_id`` is the smallest doc_id that links reach, and
    ``kept`` tells whether it is the row's own.

    Null and empty texts, and texts of white space, have no shingles: they stay alone,
    with their own doc_id as component_id.  Repeated rows get one row each, with equal
    results.  Rows that share a doc_id are linked by their texts only, and each text has
    its own component.  Rows without a doc_id are linked like others but name nothing:
    where no link reaches a doc_id, component_id is null and they are kept.  A very long
    text is compared in a part of its own size.  Other columns are ignored.  An empty
    table gives an empty result.  Of two texts at the threshold that are no copies,
    banding misses one pair in a million (``MISS``).
    """
    found = _groups(docs, words, threshold)
    own = F.col("node").isNull()
    component = F.when(own, F.col("doc_id")).otherwise(F.col("name"))
    # Joined by node through tables of their own, so that a hot class is split.
    return found.rows.join(materialize(found.names, "components").hint("merge"), "node", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (component.isNull() | component.eqNullSafe(F.col("doc_id"))).alias("kept"),
    )


def keep_one(
    docs: DataFrame, *, words: int = 5, threshold: tuple[int, int] = (80, 100)
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns.

    It is the row with the smallest doc_id; of rows that share it or have none, the one
    whose text has the smallest SHA-256, and of equal texts the one whose columns hash
    lowest, so a rerun keeps the same.  Rows without words are in no group and all stay,
    repeated ones too.  A text without near duplicates always stays, whatever other rows
    have its doc_id.  Ties, very long texts and the empty table are as in
    ``near_duplicates``; columns may have any names.
    """
    found = _groups(docs, words, threshold)
    names = materialize(found.names, "components")
    every = materialize(found.rows, "rows")
    rows = every.where("node IS NOT NULL").join(names.hint("merge"), "node")
    # The order is by doc_id, nulls last, and then by key.
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    kept = materialize(
        rows.groupBy("component")
        .agg(F.min(at).alias("at"))
        .select("at.doc_id", "at.key"),
        "kept",
    ).withColumn("stays", F.lit(True))
    sizes = every.where("node IS NOT NULL").groupBy("key", "doc_id").agg(F.count("*").alias("n"))
    repeated = materialize(sizes.where("n > 1"), "repeated")
    wordless = every.where("node IS NULL AND key IS NOT NULL").select("key").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(
        row.alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _key(F.col("text")).alias("key"),
        F.xxhash64(row).alias("hash"),
    )
    same = lambda other: (held["key"] == other["key"]) & held["doc_id"].eqNullSafe(other["doc_id"])
    of_groups = held.join(kept.hint("merge"), same(kept)).select(held["*"])
    single = of_groups.join(repeated.hint("merge"), same(repeated), "left_anti")
    several = (
        of_groups.join(repeated.hint("merge"), same(repeated), "left_semi")
        .groupBy("doc_id", "key")
        .agg(F.min_by("row", "hash").alias("row"))
    )
    alone = held.join(materialize(wordless, "wordless").hint("merge"), "key", "left_semi")
    out = single.select("row").unionAll(several.select("row")).unionAll(alone.select("row"))
    return out.unionAll(held.where("key IS NULL").select("row")).select("row.*")
