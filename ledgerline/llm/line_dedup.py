"""Removal of lines that occur earlier, word for word or but for one word.

A line is its words.  Equal lines meet by hash.  Lines that differ by one inserted,
deleted or replaced word meet in their deletion neighbourhoods: every variant of a
line with one word left out is a hashed key, and two lines within the bound share a
key.  Variants of all lines would be many times the text, so lines that cannot have
a partner are put aside first: with one edit, either the first or the last half of
the words is untouched, and only lines that share such a half with another one are
expanded, over the words of the other half.  Halves of short lines are too common to
tell much, and their variants are few, so short lines are expanded directly.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import unused
from ledgerline.session import materialize

MIN_WORDS = 1  # every line that is not blank is judged
NEAR_WORDS = 3  # lines of so many words may differ by one
SPACE = r"[\x20\x09-\x0D]+"
STEP = 8  # halves are rounded down to half this many words


def normal(line: Column) -> Column:
    """The words of a line with single spaces between them.

    Most lines are that already, which plain searches tell; a pattern is run for the
    others.  Texts are kept whole, as arrays of words would cost several times as much.
    """
    odd = [line.contains(c) for c in ("  ", "\t", "\v", "\f", "\r")]
    odd += [line.startswith(" "), line.endswith(" ")]
    tidy = F.trim(F.regexp_replace(line, SPACE, " "))
    return F.when(reduce(or_, odd), tidy).otherwise(line)


def _count(normal: Column) -> Column:
    spaces = F.octet_length(normal) - F.octet_length(F.replace(normal, F.lit(" "), F.lit("")))
    return F.when(normal == "", 0).otherwise(spaces + 1)


def _first(normal: Column, n: Column) -> Column:
    """The first n words, or the last -n."""
    return F.call_function("substring_index", normal, F.lit(" "), n)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``line`` (from 0), ``words`` (as one text), ``n`` of the lines judged."""
    return (
        docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line", "t"),
        )
        # By way of one-element arrays: a filter on a generated column is not rewritten to
        # the expression behind it, which would then run several times a line.
        .select("doc_id", "line", F.explode(F.array(normal(F.col("t")))).alias("words"))
        .select("*", F.explode(F.array(_count(F.col("words")))).alias("n"))
        .where(F.col("n") >= MIN_WORDS)
    )


def _hashes() -> list[Column]:
    return [F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2")]


def _halves() -> Column:
    """The halves that a line offers: how many words, and from which end.

    Lines of n and n + 1 words must offer the same number, so where it steps up the
    smaller one is offered too.  Up to ``STEP`` words that is a half of no words.
    """
    here = (F.floor(F.col("n") / STEP) * (STEP // 2)).cast("int")
    below = (F.floor((F.col("n") - 1) / STEP) * (STEP // 2)).cast("int")
    sizes = F.array_distinct(F.array(here, below))
    halves = F.flatten(
        F.transform(
            sizes,
            lambda h: F.array(
                F.struct(h.alias("h"), F.lit(True).alias("front")),
                F.struct(h.alias("h"), F.lit(False).alias("front")),
            ),
        )
    )
    return F.filter(halves, lambda half: (half.h > 0) | half.front)


def _half_rows(lines: DataFrame) -> DataFrame:
    """A row for each half offered, ``key`` being the hash of that half.

    For a half of no words, which all short lines share, it is that of the line, so
    that they do not meet in one task.
    """
    h, front = F.col("half.h"), F.col("half.front")
    half = _first(F.col("words"), F.when(h == 0, F.col("n")).when(front, h).otherwise(-h))
    return (
        lines.where(F.col("n") >= NEAR_WORDS)
        .withColumn("half", F.explode(_halves()))
        .withColumn("key", F.xxhash64(h, front, half))
    )


def _rest() -> Column:
    """The words beside the half."""
    left = F.col("n") - F.col("half.h")
    return _first(F.col("words"), F.when(F.col("half.front"), -left).otherwise(left))


def _without(words: Column, i: Column) -> Column:
    return F.concat(F.slice(words, F.lit(1), i - 1), F.slice(words, i + 1, F.size(words)))


def _variants(near: DataFrame) -> DataFrame:
    """A row per variant: ``role`` tells what a line that shares ``variant`` is to it.

    Lines that share a ``same`` variant have one word left out at one place, so each
    is one replacement from the others.  A ``whole`` line is what a ``longer`` one
    becomes without a word.
    """
    # A hash runs on from one array to the next, so the words before the gap and those
    # after it hash like one array that lacks the word.
    words = F.split("first.rest", " ", -1)
    place = F.sequence(F.lit(1), F.size("words"))
    before = lambda i: F.slice("words", F.lit(1), i - 1)
    after = lambda i: F.slice("words", i + 1, F.size("words"))

    def variant(role: str, *held: Column) -> Column:
        return F.struct(F.xxhash64("key", *held).alias("variant"), F.lit(role).alias("role"))

    same = F.transform(place, lambda i: variant("same", i, before(i), after(i)))
    longer = F.transform(place, lambda i: variant("longer", F.lit(-1), before(i), after(i)))
    whole = F.array(variant("whole", F.lit(-1), F.col("words")))
    made = F.when(F.col("lengths") > 1, F.concat(same, longer, whole)).otherwise(same)
    return (
        near.withColumn("words", words)
        .select("h1", "first", F.explode(made).alias("v"))
        .select("h1", F.struct("first.doc_id", "first.line").alias("at"), "v.variant", "v.role")
    )


def edits(a: Column, b: Column) -> Column:
    """0, 1, or 2 for more: how many words of one list must change to get the other."""
    longer = F.when(F.size(a) >= F.size(b), a).otherwise(b)
    shorter = F.when(F.size(a) >= F.size(b), b).otherwise(a)
    differ = F.zip_with(longer, shorter, lambda x, y: ~x.eqNullSafe(y))
    first = F.array_position(differ, True).cast("int")
    replaced = F.size(F.filter(differ, lambda d: d))
    inserted = F.when(_without(longer, first) == shorter, 1).otherwise(2)
    return (
        F.when(a == b, 0)
        .when(F.size(a) == F.size(b), F.least(replaced, F.lit(2)))
        .when(F.size(longer) == F.size(shorter) + 1, inserted)
        .otherwise(2)
    )


def _exact(hashed: DataFrame) -> DataFrame:
    """Occurrences of a line after its first: ``doc_id``, ``line``, ``h1``, ``h2``, ``first``."""
    repeated = materialize(
        hashed.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .drop("times"),
        "repeated",
    )
    return hashed.join(repeated.hint("merge"), ["h1", "h2"]).where(F.struct("doc_id", "line") > F.col("first"))


def _near(docs: DataFrame) -> DataFrame:
    """Lines with an earlier one within one word: ``h1``, ``h2``, ``doc_id``, ``line``, ``first``.

    ``doc_id`` and ``line`` are a line's own first occurrence.
    """
    halves = _half_rows(_lines(docs))
    shared = materialize(
        halves.select("key", _hashes()[0], "n")
        .groupBy("key")
        .agg(
            F.min("h1").alias("low"),
            F.max("h1").alias("high"),
            (F.max("n") - F.min("n") + 1).alias("lengths"),
        )
        .where("low <> high")
        .select("key", "lengths"),
        "halves",
    )
    offered = halves.select(
        "key", "half", *_hashes(), "doc_id", "line", _rest().alias("rest")
    )
    short = F.col("half.h") == 0
    # Grouped by the line, not by the key of the join: so a half that very many lines
    # share can be split in the join, and equal lines meet after partial aggregation.
    near = materialize(
        offered.join(shared.hint("merge"), "key", "left")
        .where(short | F.col("lengths").isNotNull())
        .withColumn("key", F.when(short, 0).otherwise(F.col("key")))
        .groupBy("h1", "h2", "half")
        .agg(
            F.first("key").alias("key"),
            F.coalesce(F.first("lengths"), F.lit(2)).alias("lengths"),
            F.min(F.struct("doc_id", "line", "rest")).alias("first"),
        )
        .drop("half"),
        "near",
    )
    variants = materialize(_variants(near), "variants")
    # The earliest line of each role; a variant of one line alone tells nothing.
    earliest = materialize(
        variants.groupBy("variant")
        .agg(
            *(
                F.min(F.when(F.col("role") == r, F.struct("at.doc_id", "at.line"))).alias(r)
                for r in ("same", "whole", "longer")
            ),
            F.min("h1").alias("low"),
            F.max("h1").alias("high"),
        )
        .where("low <> high")
        .drop("low", "high"),
        "earliest",
    )
    other = (
        F.when(F.col("role") == "whole", F.col("longer"))
        .when(F.col("role") == "longer", F.col("whole"))
        .otherwise(F.col("same"))
    )
    found = (
        variants.join(earliest.hint("merge"), "variant")
        .select("at", other.alias("other"))
        .where(F.col("other") < F.col("at"))
        .distinct()
    )
    # The words themselves decide: both lines' rests, where they share a half.
    own = near.select(
        "key", "h1", "h2", F.struct("first.doc_id", "first.line").alias("at"), "first.rest"
    )
    theirs = own.select(
        F.col("key").alias("their_key"), F.col("at").alias("other"), F.col("rest").alias("their_rest")
    )
    words = [F.split(c, " ", -1) for c in ("rest", "their_rest")]
    return (
        found.join(own, "at")
        .join(theirs, "other")
        .where((F.col("key") == F.col("their_key")) & (edits(*words) <= 1))
        .groupBy("h1", "h2", "at")
        .agg(F.min("other").alias("first"))
        .select("h1", "h2", "at.doc_id", "at.line", "first")
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines to drop: ``doc_id``, ``line`` (from 0), ``first_doc_id``, ``first_line``, ``edits``.

    Lines stand in the order of (doc_id, line).  A line goes if an equal one stands
    before it (``edits`` 0; the first of them is named), or if it is the first of its
    kind and a line within one inserted, deleted or replaced word has occurred before
    it (``edits`` 1; the earliest of those is named, whether that one is kept or not).
    Words are runs without ASCII white space and compared as they are, so a line of a
    script without spaces is one word.  Blank lines are never dropped, and lines of
    fewer than ``NEAR_WORDS`` words only for equal ones.

    Null and empty texts have no lines to drop.  Rows without a doc_id have no place
    in the order and are not looked at.  Rows that share a doc_id are one document:
    a line that they repeat at the same place is one line.  An empty table has no
    lines; other columns are ignored.

    The joins on keys that all lines offer are sort-merge joins at every size, so that
    the shuffle grows with the table.  No pairs are formed within a group of equal keys: each group is reduced to its
    earliest line, with partial aggregation first.
    """
    return _found(docs).select(
        "doc_id",
        "line",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.line").alias("first_line"),
        "edits",
    )


def _found(docs: DataFrame) -> DataFrame:
    hashed = materialize(_lines(docs).select("doc_id", "line", *_hashes()).distinct(), "lines")
    exact = _exact(hashed).select("doc_id", "line", "h1", "first", F.lit(0).alias("edits"))
    near = _near(docs).select("doc_id", "line", "h1", "first", F.lit(1).alias("edits"))
    return exact.unionByName(near)


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that ``repeated_lines`` names; ``n_chars`` follows, if there.

    Documents of which nothing but white space is left go, unless they came so.
    Every other row stays, with all its columns, whatever their names.  Null and empty
    texts and rows without a doc_id stay as they are.  Of rows that share a doc_id each
    loses its own lines; equal rows are one document and stay alike.  An empty table stays
    empty.
    """
    own, other, gone = unused(docs, "own", "other", "gone")
    drops = (
        _found(docs)
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct(F.col("line").alias("i"), F.col("h1"))).alias(gone))
        .withColumnRenamed("doc_id", other)
    )
    named = docs.withColumn(own, F.col("doc_id").cast("long"))
    joined = named.join(drops, F.col(own) == F.col(other), "left")
    kept = F.filter(
        F.split(F.col("text"), "\n", -1),
        lambda t, i: ~F.array_contains(
            F.col(gone), F.struct(i.alias("i"), F.xxhash64(normal(t)).alias("h1"))
        ),
    )
    has = F.col(gone).isNotNull()
    text = F.when(has, F.array_join(kept, "\n")).otherwise(F.col("text"))
    left = joined.withColumn("text", text).where(~has | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn(
            "n_chars", F.when(has, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


# The same in SQL: candidates share a half, and the words are compared one by one.
ORACLE = rf"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
  WHERE doc_id IS NOT NULL AND text IS NOT NULL),
lines AS (
  SELECT DISTINCT doc_id, CAST(i - 1 AS INTEGER) AS line,
    [w FOR w IN regexp_split_to_array(ls[i], '{SPACE}') IF w <> ''] AS words
  FROM split, range(1, len(ls) + 1) t(i)),
firsts AS (
  SELECT words, len(words) AS n, min({{'d': doc_id, 'l': line}}) AS spot
  FROM lines WHERE len(words) >= {MIN_WORDS} GROUP BY words),
exact AS (
  SELECT doc_id, line, spot.d AS first_doc_id, spot.l AS first_line, 0 AS edits
  FROM lines JOIN firsts USING (words) WHERE {{'d': doc_id, 'l': line}} > spot),
halves AS (
  SELECT DISTINCT words, n, spot, h, front,
    CASE WHEN front THEN words[1:h] ELSE words[n - h + 1:n] END AS half
  FROM firsts, (VALUES (true), (false)) s(front), (VALUES (0), (1)) b(less),
    LATERAL (SELECT (n - less) // 2 AS h) WHERE n >= {NEAR_WORDS}),
pairs AS (
  SELECT DISTINCT a.words AS a, b.words AS b, a.spot AS spot, b.spot AS other
  FROM halves a JOIN halves b
    ON a.h = b.h AND a.front = b.front AND a.half = b.half AND b.spot < a.spot AND abs(a.n - b.n) <= 1),
near AS (
  SELECT spot, min(other) AS other FROM pairs
  WHERE CASE
    WHEN len(a) = len(b) THEN len([i FOR i IN range(1, len(a) + 1) IF a[i] <> b[i]]) = 1
    WHEN len(a) > len(b)
      THEN len([i FOR i IN range(1, len(a) + 1) IF list_concat(a[1:i - 1], a[i + 1:]) = b]) > 0
    ELSE len([i FOR i IN range(1, len(b) + 1) IF list_concat(b[1:i - 1], b[i + 1:]) = a]) > 0 END
  GROUP BY spot)
SELECT * FROM exact
UNION ALL
SELECT spot.d, spot.l, other.d, other.l, 1 FROM near
"""
