"""Quality scores from how well a text compresses with good and with bad examples.

Pairs of zstandard dictionaries are built, from segments of good and of bad labelled
texts, one pair for each length of segments: short ones hold words and marks, long ones
turns of whole sentences.  A text is compressed with both dictionaries of a pair, and the
difference of the sizes is normalised by their sum and by the text's length.  These
differences, and nothing else of the text, are calibrated to a probability by a logistic
regression on labelled texts that went into no dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import materialize

CUT = 0.3  # a score from here on counts as good
# What a fit may use at most: labelled texts a class, and segments of them a class and length.
SAMPLE_TEXTS, SAMPLE_SEGMENTS = 6000, 2500
SEGMENT_BYTES = (128, 512, 2048)
DICTIONARY_BYTES, LEVEL = 112_640, 3
ROWS = 256
RIDGE = 0.03  # by five folds of the calibration half

Dictionary = tuple[bytes, bool]  # and whether it was trained
Pairs = tuple[tuple[Dictionary, Dictionary], ...]  # of good and of bad texts


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see: those with a CRC-32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _compressor(dictionary: bytes, trained: bool) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=kind) if dictionary else None
    if data:
        data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=data,
        write_content_size=False,
        write_dict_id=False,
        write_checksum=False,
    )


def dictionary(segments: list[bytes]) -> Dictionary:
    """A trained dictionary, or the segments themselves where they are too few to train on."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, segments, level=LEVEL)
        return trained.as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(segments)[-DICTIONARY_BYTES:], False


def _differences(pairs: Pairs) -> Callable[[bytes], np.ndarray]:
    """Each pair's normalised size differences of a text, and their products of two."""
    made = [(_compressor(*good), _compressor(*bad)) for good, bad in pairs]
    first, second = np.triu_indices(2 * len(pairs))

    def run(text: bytes) -> np.ndarray:
        plain = []
        for by_good, by_bad in made:
            a, b = len(by_good.compress(text)), len(by_bad.compress(text))
            plain += [(b - a) / (b + a), (b - a) / (len(text) + 16)]
        found = np.array(plain)
        return np.concatenate([found, found[first] * found[second]])

    return run


@dataclass(frozen=True)
class QualityModel:
    pairs: Pairs
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the first one is the intercept
    constant: float | None = None  # the score of every text where a class has no labels

    def scorer(self) -> Callable[[bytes], float]:
        if self.constant is not None:
            return lambda _: self.constant
        differences = _differences(self.pairs)

        def run(text: bytes) -> float:
            x = (differences(text) - self.center) / self.scale
            return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -50, 50))))

        return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights by Newton's method, each step halved until it lowers the loss.

    The ridge holds the weights (but the intercept) where classes part cleanly.
    """
    x = np.column_stack([np.ones(len(x)), x])
    held = np.diag([1e-6, *np.full(x.shape[1] - 1, ridge)])

    def loss(w: np.ndarray) -> float:
        margin = x @ w
        return float(weight @ (np.logaddexp(0, margin) - y * margin) + w @ held @ w / 2)

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + held
        step = np.linalg.solve(curve, x.T @ (weight * (y - p)) - held @ w)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _segments(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [
                    (good, text[i : i + length])
                    for good, text in zip(part.column("good").to_pylist(), _texts(part), strict=True)
                    for i in range(0, len(text), length)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.bool_()),
                        pa.array([r[1] for r in rows], pa.binary()),
                    ],
                    names=["good", "segment"],
                )

    return run


def _featured(pairs: Pairs) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differences = _differences(pairs)
        for batch in batches:
            found = [differences(t).tolist() for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), pa.array(found, pa.list_(pa.float64()))],
                names=["good", "x"],
            )

    return run


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """A model of ``labels.quality`` (0 or 1) on the texts of ``docs``.

    Rows that ``held_out`` marks are not used, and of the rest at most
    ``SAMPLE_TEXTS`` documents a class, the first by a hash of the id; each class
    then weighs as much as it has labels.  Of the whole texts of one half of them,
    ``SAMPLE_SEGMENTS`` segments a class and length make the dictionaries; the other half
    is what the differences are calibrated on.  Of a class with a single text there is no
    dictionary.  A doc_id with several texts counts with the smallest one.  A doc_id with several labels counts with
    the more frequent one.  These bounds are what the driver gathers at most.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(doc_id)
        .agg((F.avg("quality") >= 0.5).alias("good"))
    )
    counts = {r["good"]: r["n"] for r in usable.groupBy("good").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    nothing = np.zeros(0)

    def constant() -> QualityModel:
        share = counts.get(True, 0) / total if total else 0.5
        return QualityModel((), nothing, nothing, nothing, share)

    if len(counts) < 2:
        return constant()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [
        usable.where(F.col("good") == good).orderBy(*order).limit(SAMPLE_TEXTS)
        for good in (True, False)
    ]
    # Broadcast: at most two times SAMPLE_TEXTS ids.
    ids = F.broadcast(chosen[0].union(chosen[1]))
    texts = materialize(
        docs.select(doc_id, F.col("text").cast("string").alias("text"))
        .join(ids, "doc_id")
        .groupBy("doc_id", "good")
        .agg(F.min("text").alias("text")),
        "labelled",
    )
    # Every second one of a class, so that both halves have each class that has two.
    turn = F.row_number().over(Window.partitionBy("good").orderBy(*order))
    halves = texts.select("doc_id", "good").select("doc_id", (turn % 2 == 1).alias("calibrates"))
    sample = texts.join(F.broadcast(halves), "doc_id")

    def segments(good: bool, length: int) -> list[bytes]:
        cut = sample.where(~F.col("calibrates") & (F.col("good") == good)).select("good", "text")
        held = (
            cut.mapInArrow(_segments(length), "good boolean, segment binary")
            .orderBy(F.xxhash64("segment"), "segment")
            .limit(SAMPLE_SEGMENTS)
        )
        return [bytes(r["segment"]) for r in held.collect()]

    pairs = tuple(
        (dictionary(segments(True, length)), dictionary(segments(False, length)))
        for length in SEGMENT_BYTES
    )
    rows = (
        sample.where("calibrates")
        .select("good", "text")
        .mapInArrow(_featured(pairs), "good boolean, x array<double>")
        .collect()
    )
    y = np.array([r["good"] for r in rows], dtype=float)
    if not len(rows) or y.min() == y.max():
        return constant()
    x = np.array([r["x"] for r in rows])
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weight = np.where(y == 1, counts[True] / y.sum(), counts[False] / (len(y) - y.sum()))
    weights = _logistic((x - center) / scale, y, weight * len(y) / total)
    return QualityModel(pairs, center, scale, weights)


def _scored(model: QualityModel) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = model.scorer()
        for texts in batches:
            held = texts.cast(pa.binary())
            yield pa.array([score(t.as_py() or b"") for t in held], pa.float64())

    return run


def quality_score(text: Column, model: QualityModel) -> Column:
    """The probability that a whole text is good; a null text is an empty one."""
    return F.arrow_udf(_scored(model), "double")(text.cast("string"))


def quality_scores(docs: DataFrame, labels: DataFrame, *, cut: float = CUT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    The score looks at the text alone; see ``fit_quality`` for what it is learnt
    from.  Null and empty texts are scored as empty ones, very long ones as a whole.  Repeated rows get equal
    scores; a null doc_id stays, is not held out, and no label belongs to it.  Without
    labels of both classes every text gets the share of good labels, 0.5 without any.
    An empty table gives an empty result.  Other columns are ignored.
    """
    score = quality_score(F.col("text"), fit_quality(docs, labels))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, *, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``cut``, with their columns.

    Scores are those of ``quality_scores``: a null text is an empty one, equal rows go or
    stay together, a score equal to ``cut`` stays, an empty table stays empty.
    """
    score = quality_score(F.col("text"), fit_quality(docs, labels))
    return docs.where(score >= cut)
