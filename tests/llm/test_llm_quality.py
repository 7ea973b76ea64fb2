from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from llm_helpers import AWKWARD, TESTDATA, rows_of

from ledgerline.llm.quality import fit_quality, held_out, keep_good, quality_scores
from ledgerline.llm.tables import table


def labelled(n, seed=1):
    rng = random.Random(seed)
    words = "the river runs along old stone walls where many people walk in summer".split()
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choices(words, k=rng.randint(30, 200)))
        rows.append((i, text if good else " | ".join(text.upper().split()) + "!!!", "s"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_tells_held_out_rows_apart(session, docs):
    rows, labels = labelled(600)
    out = quality_scores(docs(rows), session.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out.collect() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out.collect())
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.collect())


def test_scores_are_probabilities(session, docs):
    """With a tenth of the labels wrong, scores stay off 0 and 1 and match the shares."""
    rng = random.Random(8)
    rows, labels = labelled(1500, seed=2)
    noisy = [(i, 1 - q if rng.random() < 0.1 else q, t) for i, q, t in labels]
    frame = session.createDataFrame(noisy, "doc_id long, quality int, toxic int")
    out = quality_scores(docs(rows), frame).collect()
    truth = {i: q for i, q, _ in noisy}
    for good in (0, 1):
        held = [r for r in out if r["held_out"] and r["predicted"] == good]
        share = sum(truth[r["doc_id"]] for r in held) / len(held)
        assert abs(sum(r["score"] for r in held) / len(held) - share) < 0.1
    assert sum(0.01 < r["score"] < 0.99 for r in out) > len(out) / 2


def test_held_out_labels_are_not_read(session, docs):
    rows, labels = labelled(200)
    frame = lambda ls: session.createDataFrame(ls, "doc_id long, quality int, toxic int")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (sorted(rows_of(quality_scores(docs(rows), frame(x)))) for x in (labels, flipped))
    assert a == b


def test_the_given_labels(session, documents):
    out = quality_scores(documents, table(session, TESTDATA, "labels"))
    assert out.count() == documents.count() and out.where("score IS NULL").count() == 0


def test_awkward_rows(session, docs):
    rows, labels = labelled(200)
    odd = [(1000 + (i or 0), t, s) for i, t, s in AWKWARD if i is not None] + AWKWARD[:2]
    odd_labels = [(None, 1, 0), (1001, None, 0), (1002, 7, 0), (1003, 1, 0), (1003, 0, 0), (99999, 1, 0)]
    frame = session.createDataFrame([*labels, *odd_labels], "doc_id long, quality int, toxic int")
    out = quality_scores(docs(rows + odd), frame).collect()
    assert len(out) == len(rows) + len(odd) and all(r["score"] is not None for r in out)
    empty = {r["score"] for r in out if r["doc_id"] in (1001, 1002)}
    assert len(empty) == 1
    kept = keep_good(docs(rows + odd), frame)
    assert kept.columns == docs([]).columns and 0 < kept.count() < len(rows) + len(odd)
    assert quality_scores(docs([]), frame).count() == 0


def plain_score(model, text):
    """The score from the fitted parts alone: compress, divide, multiply, add up."""
    data, sizes = text.encode(), []
    for pair in model.pairs:
        for raw, trained in pair:
            kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
            held = zstandard.ZstdCompressionDict(raw, dict_type=kind) if raw else None
            made = zstandard.ZstdCompressor(
                level=3, dict_data=held, write_content_size=False, write_dict_id=False
            )
            sizes.append(len(made.compress(data)))
    x = []
    for good, bad in zip(sizes[::2], sizes[1::2], strict=True):
        x += [(bad - good) / (bad + good), (bad - good) / (len(data) + 16)]
    x += [x[i] * x[j] for i in range(len(x)) for j in range(i, len(x))]
    z = model.weights[0]
    for value, center, scale, weight in zip(x, model.center, model.scale, model.weights[1:], strict=True):
        z += weight * (value - center) / scale
    return 1 / (1 + math.exp(-max(-50, min(50, z))))


def test_scores_follow_from_the_fitted_parts(documents, session):
    labels = table(session, TESTDATA, "labels")
    model = fit_quality(documents, labels)
    assert len(model.pairs) == 3 and model.constant is None
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    got = {r["doc_id"]: r["score"] for r in quality_scores(documents, labels).collect()}
    want = {i: plain_score(model, t) for i, t in texts.items()}
    assert got == pytest.approx(want, abs=1e-9)


def test_a_class_of_one_text_is_calibrated(session, docs):
    """Both classes have labels, so the score is no constant; hot ids are read once."""
    rows, labels = labelled(60)
    few = [r for r in labels if r[1] == 1]
    bad = next(r for r in labels if r[1] == 0 and zlib.crc32(str(r[0]).encode()) % 5)
    frame = session.createDataFrame([*few, bad], "doc_id long, quality int, toxic int")
    again = [rows[few[0][0]]] * 500
    model = fit_quality(docs(rows + again), frame)
    assert model.constant is None and np.isfinite(model.weights).all()
    assert (model.center == fit_quality(docs(rows), frame).center).all()


def test_labels_of_one_class_or_none(session, docs):
    schema = "doc_id long, quality int"
    for labels, share in (([(2, 1), (3, 1)], 1.0), ([], 0.5)):
        out = quality_scores(docs([(1, "x", "")]), session.createDataFrame(labels, schema)).collect()
        assert out[0]["score"] == share
