"""Homomorphic multiset fingerprints of documents.

A paragraph (a line) is hashed to a wide vector, and a document's fingerprint is
the sum of its paragraphs' vectors modulo powers of two.  So the order of
paragraphs does not matter, a paragraph is inserted or deleted by adding or
subtracting its vector, and fingerprints of parts add up to that of the whole.

The vector has two parts.  Sixteen lanes modulo 2^64 come from the hash of the
whole paragraph; they tell equality.  256 lanes modulo 2^32 hold a count sketch:
each run of three words of the paragraph adds 1 or -1 to one lane.  The scalar
product of two sketches estimates how many such runs two documents share.  It holds as
long as no lane counts 2^31 runs, which a text of 2 GB, Spark's longest, cannot have.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shingles import hash_words, mix

EXACT_LANES, SKETCH_LANES, RUN = 16, 256, 3
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
ROWS = 256
RANGES_A_PARTITION = 4


@dataclass(frozen=True)
class Fingerprint:
    exact: np.ndarray
    sketch: np.ndarray

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.sketch - other.sketch)

    def __str__(self) -> str:
        held = self.exact.astype("<u8").tobytes() + self.sketch.astype("<u4").tobytes()
        return base64.b64encode(held).decode()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        held = base64.b64decode(text)
        cut = 8 * EXACT_LANES
        return cls(
            np.frombuffer(held[:cut], "<u8").astype(np.uint64),
            np.frombuffer(held[cut:], "<u4").astype(np.uint32),
        )

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal multisets of paragraphs; else the estimated share of common runs."""
        if (self.exact == other.exact).all():
            return 1.0
        a, b = (x.sketch.view(np.int32).astype(np.float64) for x in (self, other))
        both = float(a @ a + b @ b)
        return min(1.0, max(0.0, 2 * float(a @ b) / both)) if both else 0.0


def of_text(text: str) -> Fingerprint:
    """The fingerprint of a text's paragraphs; an empty text is one empty paragraph."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    blake = hashlib.blake2b
    digests = b"".join(blake(x).digest() + blake(x, person=b"more").digest() for x in lines)
    hashed = np.frombuffer(digests, dtype="<u8").reshape(len(lines), EXACT_LANES)
    exact = hashed.sum(axis=0, dtype=np.uint64)

    split = [x.split() for x in lines]
    counts = np.array([len(x) for x in split])
    words = hash_words([w for x in split for w in x])
    line = np.repeat(np.arange(len(lines)), counts)
    n = len(words) - RUN + 1
    runs = np.empty(0, dtype=np.uint64)
    if n > 0:
        total = sum(words[i : i + n] * FACTORS[i] for i in range(RUN))
        runs = total[line[:n] == line[RUN - 1 :]]
    starts = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < RUN)):
        short = words[starts[i] : starts[i] + counts[i]] * FACTORS[: counts[i]]
        runs = np.append(runs, short.sum(dtype=np.uint64))
    runs = mix(runs)
    lane = (runs >> np.uint64(40)) % np.uint64(SKETCH_LANES)
    sign = 1.0 - 2.0 * (runs >> np.uint64(63)).astype(np.float64)
    sketch = np.bincount(lane.astype(np.int64), sign, SKETCH_LANES).astype(np.int64)
    return Fingerprint(exact, sketch.astype(np.uint32))


def edited(text: str, other: str) -> str:
    """The last third of the code points replaced by as many of ``other``, or all of it."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def _of_edited(whole: Fingerprint, text: str, after: str) -> Fingerprint:
    """The edited text's fingerprint from that of the text: only changed lines are hashed."""
    start = text.rfind("\n", 0, len(text) - len(text) // 3) + 1
    return whole - of_text(text[start:]) + of_text(after[start:])


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(doc_id, text: str, own: Fingerprint, other: str, next_: Fingerprint) -> tuple:
    after = edited(text, other)
    changed = _of_edited(own, text, after)
    digest = hashlib.sha256(after.encode("utf-8")).hexdigest()
    return (
        doc_id,
        len(text),
        digest,
        str(own),
        str(changed),
        own.likeness(changed),
        own.likeness(next_),
    )


def _against_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (bucket, copy, doc_id descending); a copy ends its bucket."""
    nothing = of_text("")
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*out), _OUT, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=_OUT)

    last = None  # bucket, doc_id, text, fingerprint
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            columns = (part.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text"))
            for bucket, copy, doc_id, text in zip(*columns, strict=True):
                text = text or ""
                own = of_text(text)
                if last and last[0] == bucket:
                    out.append(_compared(*last[1:], text, own))
                    last = None
                if doc_id is None:
                    out.append(_compared(None, text, own, "", nothing))
                elif not copy:
                    last = (bucket, doc_id, text, own)
            if out:
                yield flush()


def _count_above(values: list[int], of: Column) -> Column:
    """How many of some descending whole numbers are greater; two short scans a row."""
    if not values:
        return F.lit(0)
    step = math.isqrt(len(values)) + 1
    chunks = [values[i : i + step] for i in range(0, len(values), step)]
    literal = lambda xs: F.array(*[F.lit(int(x)).cast("long") for x in xs])
    above = lambda xs: F.size(F.filter(xs, lambda x: x > of))
    full = above(literal([c[-1] for c in chunks]))
    nested = F.array(*[literal(c) for c in chunks])
    rest = F.coalesce(above(F.get(nested, full)), F.lit(0))
    return F.least(full * step + rest, F.lit(len(values)))


def _in_order(docs: DataFrame, partitions: int) -> DataFrame:
    """Documents dealt to ranges of descending doc_id, each with the head of the next.

    The driver holds the bounds of the ranges and one doc_id for each, so as many
    numbers as there are ranges.
    """
    ranges = partitions * RANGES_A_PARTITION
    ids = docs.select("doc_id").where("doc_id IS NOT NULL")
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = ids.stat.approxQuantile("doc_id", probabilities, 0.25 / ranges)
    bounds = sorted({int(x) for x in cuts}, reverse=True)
    bucket = _count_above(bounds, F.col("doc_id"))
    heads = ids.groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("head")).collect()
    heads = sorted((r["bucket"], r["head"]) for r in heads)
    known = [None] * (len(bounds) + 1)
    before = [None] * (len(bounds) + 1)
    for i, (b, head) in enumerate(heads):
        known[b], before[b] = head, heads[i - 1][0]
    literal = lambda xs, kind: F.array(*[F.lit(x).cast(kind) for x in xs])
    own = F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(ranges)))
    own = own.otherwise(bucket).cast("long")
    here = docs.withColumn("own", own)
    is_head = F.get(literal(known, "long"), F.col("own")) == F.col("doc_id")
    place = lambda b, copy: F.struct(b.cast("long").alias("bucket"), F.lit(copy).alias("copy"))
    copied = F.when(is_head, place(F.get(literal(before, "long"), F.col("own")), True))
    places = F.filter(F.array(place(F.col("own"), False), copied), lambda x: x.isNotNull())
    return (
        here.select("doc_id", "text", F.explode(places).alias("at"))
        .select("at.bucket", "at.copy", "doc_id", "text")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "copy", F.desc("doc_id"), "text")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint, and its likeness to an edited text and to the next one's.

    One row per row of ``docs``: ``doc_id``, ``n_chars`` (code points),
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``.  The next document has the next smaller doc_id, after the last
    comes the first; in an edited text the last third of the code points is replaced
    by as many of the next document (or all of it).

    A null text is an empty one.  Rows with one doc_id follow each other by text.
    Rows without a doc_id are in no order: their next document is an empty text.  A
    single document is its own next.  Other columns are ignored, ``n_chars``
    included.  An empty table gives an empty result.  One shuffle moves the texts, to
    ranges of doc_id that are read as streams of single rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _in_order(texts, partitions).mapInArrow(_against_next, _OUT_DDL)
