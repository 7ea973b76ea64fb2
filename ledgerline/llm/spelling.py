"""Spelling variants: words one edit apart, found by an index of variable-length grams.

A dictionary of grams is built over all words.  Two letters are a gram always; a gram
that occurs often is extended by the letters that mostly follow it, a gram that occurs
seldom is not (``gram_dictionary``).  A word is decomposed into the longest grams of the
dictionary that do not lie within one another.  For each place of an edit, the dictionary
tells which of the word's grams it may change, those around the place included; the most
that any place changes is the word's bound.  Two words one edit apart therefore share all
their grams but so many as the bound of either, and the lists of the bound's number of
rarest grams and one more are all that has to be merged.  Words that meet in a list, at
places one edit can give, are compared letter by letter.

Words whose bound covers all their grams, and grams with very long lists, cannot be
merged that way.  Such words are compared with one another over all forms with one letter
left out, of which no more words than there are letters share one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize

RUN = re.compile("[a-zÀ-ÿ]+")
SHORTEST, LONGEST = 2, 4  # letters in a gram
# A gram is extended if more than one in so many words' worth of occurrences is its own.
SHARE, SELDOM = 256, 8
LIST_MOST = 1 << 17  # words in a list that is merged
BLOCK_ROWS = 1 << 16  # list entries that one task merges, but for a longer list
COUNTED_AT_ONCE = 1 << 19  # words or grams a task holds while it counts
TILE = 1 << 22  # letters compared at once

Gram = tuple[int, str]


def _flushed(counts: Counter, key: str) -> pa.RecordBatch:
    arrays = [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=[key, "n"])


def _words(shortest: int, drop_every: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                # Lower-cased as bytes, which changes A to Z only.
                found = Counter(RUN.findall((text or "").encode().lower().decode()))
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    if drop_every:
                        h = zlib.crc32(word.encode(), start)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) >= COUNTED_AT_ONCE:
                    yield _flushed(total, "word")
                    total.clear()
        if total:
            yield _flushed(total, "word")

    return run


def word_counts(
    docs: DataFrame, *, shortest: int = 5, least: int = 3, drop_every: int | None = None
) -> DataFrame:
    """``word``, ``n``: runs of letters up to U+00FF in all texts, with A-Z lower-cased.

    Words of at least ``shortest`` code points that occur ``least`` times are returned.
    With ``drop_every``, a letter is left out of all occurrences of a run in a document
    where the number divides h, the crc32 of ``doc_id:run``: the letter h modulo the
    run's length.  A null doc_id is written as nothing there.  Null and empty texts have
    no words; repeated rows count each time; long texts are counted like short ones.
    """
    parts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(
        _words(shortest, drop_every), "word string, n long"
    )
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            for size in range(SHORTEST, LONGEST + 1):
                total.update([word[p : p + size] for p in range(len(word) - size + 1)])
        if len(total) >= COUNTED_AT_ONCE:
            yield _flushed(total, "gram")
            total.clear()
    if total:
        yield _flushed(total, "gram")


@dataclass
class Grams:
    """The dictionary: grams beyond the shortest, and how often each gram is left over."""

    longer: set[str] = field(default_factory=set)
    left: dict[str, int] = field(default_factory=dict)
    starts: set[str] = field(default_factory=set)  # what a longer gram begins with
    ends: set[str] = field(default_factory=set)  # what it ends with

    @staticmethod
    def pruned(counts: dict[str, int], often: int) -> Grams:
        """Grams that occur more than ``often`` are extended; rare extensions are pruned.

        The rarest extensions go first, as long as what a gram stands for itself does
        not exceed ``often``.
        """
        grams = Grams()
        by_start: dict[str, list[tuple[int, str]]] = {}
        for gram, n in counts.items():
            if len(gram) > SHORTEST:
                by_start.setdefault(gram[:-1], []).append((n, gram))
        level = [g for g in counts if len(g) == SHORTEST]
        grams.left = {g: counts[g] for g in level}
        while level:
            following = []
            for gram in level:
                if counts[gram] <= often:
                    continue
                own = counts[gram] - sum(n for n, _ in by_start.get(gram, []))
                for n, longer in sorted(by_start.get(gram, [])):
                    if own + n <= often:
                        own += n
                    else:
                        grams.left[longer] = n
                        following.append(longer)
                grams.left[gram] = own
            grams.longer.update(following)
            level = following
        for gram in grams.longer:
            grams.starts.update(gram[:i] for i in range(1, len(gram)))
            grams.ends.update(gram[i:] for i in range(1, len(gram)))
        return grams

    def decompose(self, word: str) -> list[Gram]:
        """The longest gram from each place, but for those within the one before."""
        out: list[Gram] = []
        end = 0
        for p in range(len(word) - SHORTEST + 1):
            for size in range(min(LONGEST, len(word) - p), SHORTEST, -1):
                if word[p : p + size] in self.longer:
                    break
            else:
                size = SHORTEST
            if p + size > end:
                end = p + size
                out.append((p, word[p:end]))
        return out

    def bound(self, word: str, grams: list[Gram]) -> int:
        """The most grams that one inserted, deleted or replaced letter can change.

        A gram that does not hold the place may change too: one before it, if a gram of
        the dictionary may now begin at or before it and reach the place; one after it,
        if a gram that reaches the place may now end at or after its end.
        """
        length, worst = len(word), 0
        for at in range(2 * length + 1):
            left, right = at // 2, (at + 1) // 2  # between letters, or a letter
            if at % 2:
                left, right = at // 2, at // 2 + 1
            first = next(
                (p for p in range(max(0, left - LONGEST + 1), left) if word[p:left] in self.starts),
                left,
            )
            last = next(
                (q for q in range(min(length, right + LONGEST - 1), right, -1) if word[right:q] in self.ends),
                right,
            )
            changed = 0
            for p, gram in grams:
                q = p + len(gram)
                if q <= left:
                    changed += p >= first
                elif p >= right:
                    changed += q <= last
                else:
                    changed += 1
            worst = max(worst, changed)
        return worst

    def lists(self, word: str) -> tuple[list[Gram], bool]:
        """The grams whose lists are merged for a word, and whether they are enough."""
        grams = self.decompose(word)
        bound = self.bound(word, grams)
        grams.sort(key=lambda g: (self.left.get(g[1], 0), g[1], g[0]))
        return grams[: bound + 1], bound < len(grams)


def gram_dictionary(words: DataFrame, *, share: int = SHARE) -> Grams:
    """The gram dictionary of a table of words.

    A gram is frequent if its count exceeds one ``share``-th of the number of words, so
    there are at most ``share`` times 3 times the mean length of them, each with no
    more extensions than there are letters: the size does not grow with the table.
    Only the frequent grams' extensions and the pairs of letters come to the driver.
    """
    often = max(SELDOM, words.count() // share)
    counts = materialize(
        words.select("word")
        .mapInArrow(_grams_of, "gram string, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    parents = counts.where(F.col("n") > often).select(F.col("gram").alias("start"))
    start = F.expr("substring(gram, 1, length(gram) - 1)")
    longer = counts.where(F.length("gram") > SHORTEST).withColumn("start", start)
    wanted = longer.join(parents, "start").select("gram", "n").union(
        counts.where(F.length("gram") == SHORTEST)
    )
    return Grams.pruned({r["gram"]: r["n"] for r in wanted.collect()}, often)


def _decomposed(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: Grams = shared.value
        schema = pa.schema([
            ("word", pa.string()), ("n", pa.int64()), ("enough", pa.bool_()),
            ("lists", pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.string())]))),
        ])
        for batch in batches:
            out = []
            for word, n in zip(*(batch.column(c).to_pylist() for c in ("word", "n"))):
                lists, enough = grams.lists(word)
                out.append({
                    "word": word, "n": n, "enough": enough,
                    "lists": [{"pos": p, "gram": g} for p, g in lists],
                })
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _letters(words: Iterable[str]) -> np.ndarray:
    held = [w.encode("latin-1") for w in words]
    return np.frombuffer(b"".join(held), dtype=np.uint8).reshape(len(held), -1)


def _replaced(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``x`` that differ in one letter, each pair once."""
    n, length = x.shape
    step = max(1, TILE // (n * length))
    for at in range(0, n - 1, step):
        i, j = np.nonzero((x[at : at + step, None, :] != x[None, at:, :]).sum(axis=2) == 1)
        once = i < j
        yield i[once] + at, j[once] + at


def _inserted(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``x`` that are a row of ``y`` without one letter."""
    length = x.shape[1]
    step = max(1, TILE // (len(y) * length))
    for at in range(0, len(x), step):
        part = x[at : at + step, None, :]
        front = np.logical_and.accumulate(part == y[None, :, :-1], axis=2).sum(axis=2)
        back = np.logical_and.accumulate((part == y[None, :, 1:])[:, :, ::-1], axis=2).sum(axis=2)
        i, j = np.nonzero(front + back >= length)
        yield i + at, j


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words among those that meet in a list at places that one edit can give."""
    rows = rows.sort_values(["gram", "length", "pos", "word"], kind="stable")
    words, ns = rows["word"].to_numpy(), rows["n"].to_numpy()
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for _, at in rows.reset_index(drop=True).groupby("gram", sort=False).indices.items():
        lengths, places = rows["length"].to_numpy()[at], rows["pos"].to_numpy()[at]
        new = np.flatnonzero((np.diff(lengths, prepend=-1) != 0) | (np.diff(places, prepend=-1) != 0))
        cells = {
            (lengths[i], places[i]): at[i:j] for i, j in zip(new, [*new[1:], len(at)], strict=True)
        }
        letters = {cell: _letters(words[held]) for cell, held in cells.items()}
        for (length, place), held in cells.items():
            if len(held) > 1:
                for i, j in _replaced(letters[length, place]):
                    a.append(held[i])
                    b.append(held[j])
            for moved in (0, 1):
                other = (length + 1, place + moved)
                if other in cells:
                    for i, j in _inserted(letters[length, place], letters[other]):
                        a.append(held[i])
                        b.append(cells[other][j])
    none = np.empty(0, dtype=np.int64)
    i, j = np.concatenate([none, *a]), np.concatenate([none, *b])
    found = pd.DataFrame({"word": words[i], "n": ns[i], "other": words[j], "other_n": ns[j]})
    return found.drop_duplicates(["word", "other"])


_PAIRS = "word string, n long, other string, other_n long"


def _left_out(words: DataFrame) -> DataFrame:
    """Near words by their forms with one letter left out."""
    # At most as many words as there are letters share a form with a place; a word has no
    # more forms than letters.
    place = F.explode(F.sequence(F.lit(1), F.length("word"))).alias("i")
    without = F.expr("concat(substring(word, 1, i - 1), substring(word, i + 1))")
    forms = words.select("word", "n", place).withColumn("form", F.xxhash64(without))
    theirs = forms.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "i", "form")
    replaced = forms.join(theirs, ["form", "i"]).where(F.col("word") < F.col("other"))
    whole = words.select(
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.xxhash64("word").alias("form")
    )
    both = replaced.select("word", "n", "other", "other_n").union(
        forms.join(whole, "form").select("word", "n", "other", "other_n")
    )
    return both.where(F.levenshtein("word", "other") == 1)


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``other``, ``other_n``: all words one edit apart, in both directions.

    ``words`` has each ``word`` once, with its count ``n``, in letters up to U+00FF.  An
    edit inserts, deletes or replaces one letter.
    """
    spark = words.sparkSession
    grams = spark.sparkContext.broadcast(gram_dictionary(words))
    # Spread again: a few tasks would do all the work where the table is a few files.
    spread = words.repartition(max(spark.sparkContext.defaultParallelism, words.count() // 20_000), "word")
    decomposed = materialize(
        spread.mapInArrow(
            _decomposed(grams),
            "word string, n long, enough boolean, lists array<struct<pos: int, gram: string>>",
        ),
        "decomposed",
    )
    rows = decomposed.select("word", "n", F.explode("lists").alias("x")).select(
        "word", "n", "x.pos", "x.gram", F.length("word").alias("length")
    )
    sizes = rows.groupBy("gram").count()
    # There are no more long lists than entries by LIST_MOST, and no more than grams.
    long = [r["gram"] for r in sizes.where(F.col("count") > LIST_MOST).select("gram").collect()]
    blocks = max(1, rows.count() // BLOCK_ROWS)
    merged = (
        rows.where(~F.col("gram").isin(long) if long else F.lit(True))
        .withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(lambda part: _merged(part), _PAIRS)
    )
    in_long = F.exists("lists", lambda x: x.gram.isin(long)) if long else F.lit(False)
    beside = _left_out(decomposed.where(~F.col("enough") | in_long).select("word", "n"))
    once = merged.union(beside)
    turned = once.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"),
        F.col("word").alias("other"), F.col("n").alias("other_n"),
    )
    return once.union(turned).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: where the forms lead, by doubling the step.

    Each form has twice the count of its word, and counts are below 2 ** 63, so no chain
    is longer than 63 steps and seven doublings reach the end of all.
    """
    at = materialize(forms, "roots")
    for _ in range(7):
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        at = materialize(moved, "roots")
        if not at.agg(F.max("moved")).first()[0]:
            break
        at = at.drop("moved")
    return at.select("word", "root")


def spelling_groups(words: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for each row of ``words``.

    The form of a word is the one of its near words (``near_words``) with the largest
    count, ties to the first in code-point order, if that count is at least twice the
    word's; else null.  The root is where the forms lead from the word, the word itself
    if it has none.
    """
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
    )
    near = materialize(words.join(best, "word", "left"), "near-words")
    has = -F.col("best.less") >= 2 * F.col("n")
    formed = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("best.other")).alias("form"),
        F.when(has, -F.col("best.less")).alias("form_n"),
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame, *, shortest: int = 5, least: int = 3, drop_every: int | None = None
) -> DataFrame:
    """``spelling_groups`` of the words of all documents (``word_counts``).

    What ``word_counts`` says of nulls, empty and long texts and repeated rows holds;
    ties go by code point.  An empty table has no words, other columns are ignored.
    """
    words = word_counts(docs, shortest=shortest, least=least, drop_every=drop_every)
    return spelling_groups(materialize(words, "words"))
