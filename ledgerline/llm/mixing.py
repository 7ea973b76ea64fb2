"""Mixing of sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.tables import unused
from ledgerline.operators.ordered import with_positions
from ledgerline.session import materialize

WEIGHTS = (5, 2, 1)
SHARE, REPEATS = 1.5, 2
BUCKET_ROWS = 4096  # rows summed up in one group of a running total
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``units``: distinct rows with ``copies`` (how often each is taken) and their figures."""

    units: DataFrame

    def figures(self) -> DataFrame:
        """One row per mixed row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

        Equal rows are written out again here; those of a row that is there more than
        ``BUCKET_ROWS`` times are spread over tasks in blocks of that many.
        """
        rows = self.units.select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("size") * F.col("copies")).alias("taken"),
            "m",
        )
        blocks = F.floor((F.col("m") - 1) / BUCKET_ROWS)
        block = F.explode(F.sequence(F.lit(0).cast("long"), blocks)).alias("block")
        spread = (
            rows.where(F.col("m") > BUCKET_ROWS)
            .select("*", block)
            .repartition("doc_id", "block")
            .withColumn("m", F.least(F.lit(BUCKET_ROWS), F.col("m") - F.col("block") * BUCKET_ROWS))
            .drop("block")
        )
        each = F.explode(F.array_repeat(F.lit(0), F.col("m").cast("int"))).alias("one")
        light = rows.where(F.col("m") <= BUCKET_ROWS)
        return light.unionByName(spread).select("*", each).drop("m", "one")

    def documents(self, docs: DataFrame) -> DataFrame:
        """The mixed documents, each as often as it is taken, with all their columns.

        ``docs`` are the rows that were mixed.  Equal rows are taken equally often, rows
        with null values like others; an empty mix has no documents.
        """
        key, copies, one = unused(docs, "key", "copies", "one")
        taken = self.units.where("copies > 0").select(
            F.col("key").alias(key), F.col("copies").alias(copies)
        )
        each = F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))
        return (
            docs.withColumn(key, row_key(docs))
            .join(taken, key)
            .withColumn(one, each)
            .select(*[F.col(f"`{c}`") for c in docs.columns])
        )


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(docs: DataFrame) -> Column:
    """What shuffles the documents and tells them apart: a hash of what a row holds."""
    held = [docs[c].cast("string") for c in ("doc_id", "source", "text")]
    return F.md5(F.concat_ws("|", *held, *(c.isNull().cast("string") for c in held)))


def running(rows: DataFrame, order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``rows`` with ``before_<c>``: the sum of ``c`` over all rows before, in that order.

    Positions come from one range sort.  Groups of ``BUCKET_ROWS`` neighbours are summed up,
    and only these sums, one row a group, are ordered in one task.
    """
    placed = with_positions(rows, order, name="at_row").withColumn(
        "part", F.floor(F.col("at_row") / BUCKET_ROWS)
    )
    parts = placed.groupBy("part").agg(*(F.sum(c).alias(c) for c in sums))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select(
        "part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"start_{c}") for c in sums)
    )
    within = W.partitionBy("part").orderBy("at_row").rowsBetween(W.unboundedPreceding, -1)
    return placed.join(starts, "part").select(
        *rows.columns,
        *(
            (F.col(f"start_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"before_{c}")
            for c in sums
        ),
    )


def targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with each source's ``target`` and ``place``.

    Weights go round by the order of the names, null last.  ``share`` of all sizes is
    divided by weight; no target is above ``repeats`` times its source's size.  Which
    sources stop there follows from their order by that bound over their weight, in
    one pass.  There may be as many sources as documents: places and running totals
    come from range sorts, and the driver reads four sums.
    """
    cycle = F.array(*map(F.lit, weights))
    bound = F.col("source_size") * repeats
    placed = (
        with_positions(sizes.select("source", "source_size"), ["source"], name="place")
        .withColumn("w", F.get(cycle, (F.col("place") % len(weights)).cast("int")))
        .withColumn("bound", bound)
        .withColumn("level", F.col("bound") / F.col("w"))
    )
    ranked = running(placed, ["level", "place"], ["bound", "w"])
    whole = placed.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    total = float(share) * (whole["size"] or 0)
    left = F.lit(total) - F.col("before_bound")
    onward = F.lit(whole["w"] or 0) - F.col("before_w")
    found = materialize(
        ranked.select(
            "source",
            "source_size",
            "place",
            "w",
            "bound",
            (left * F.col("w") >= F.col("bound") * onward).alias("stops"),
        ),
        "stops",
    )
    rest = found.agg(
        F.sum(F.expr("IF(stops, bound, 0)")).alias("held"),
        F.sum(F.expr("IF(stops, 0, w)")).alias("w"),
    ).first()
    target = F.when(F.col("stops"), F.col("bound").cast("double")).otherwise(
        F.try_divide(F.lit(total - (rest["held"] or 0)) * F.col("w"), F.lit(rest["w"] or 0))
    )
    return found.select(
        "source", "source_size", "place", F.lit(total).alias("total"), target.alias("target")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> Mix:
    """Which documents a mix of the sources takes, and how often.

    Every source offers its documents ``repeats`` times over in a shuffled order.
    A document's virtual finish time is the running total of its source's words
    divided by the source's target.  All offers are ordered by finish time, over all
    sources, and taken until the total budget is reached.  The order within a source
    is that of a hash of the row, so reruns agree.

    Equal rows share a hash, and are taken together.  A null text has size 0, a
    null source is a source of its own, the last one; a null doc_id stays as it is.
    Offers of size 0 are taken with the others.  Other columns are carried along by
    ``Mix.documents`` whatever their names and ignored otherwise.  An empty table
    gives an empty mix.

    Running totals have two levels, sums of groups of about ``BUCKET_ROWS`` rows and
    totals within a group, so a source with a third of all rows is no single task, and
    neither are as many sources as documents or offers that end at one time.
    """
    sized = docs.select(
        row_key(docs).alias("key"),
        docs["doc_id"].alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        size_of(docs["text"]).alias("size"),
    )
    units = materialize(
        sized.groupBy("key").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("source").alias("source"),
            F.first("size").alias("size"),
            F.count("*").alias("m"),
        ),
        "units",
    )
    per_source = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n")
    )
    aims = targets(per_source.drop("n"), weights, share, repeats)
    aims = materialize(
        aims.join(
            per_source.select(F.col("source").alias("s"), "n"),
            F.col("source").eqNullSafe(F.col("s")),
        )
        .withColumn("groups", F.ceil(F.col("n") / BUCKET_ROWS))
        .drop("s", "n"),
        "targets",
    )

    # The running total within a source: by the leading bits of the key, then by the key.
    portion = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / float(1 << 32)
    placed = materialize(
        units.join(
            aims.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
        )
        .drop("s")
        .withColumn("group", F.floor(portion * F.col("groups"))),
        "placed",
    )
    words = F.col("size") * F.col("m")
    sums = placed.groupBy("place", "group").agg(F.sum(words).alias("sum"))
    earlier = W.partitionBy("place").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    starts = materialize(
        sums.select(
            "place", "group", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start")
        ),
        "starts",
    )
    within = W.partitionBy("place", "group").orderBy("key")
    total = F.col("start") + F.sum(words).over(within.rowsBetween(W.unboundedPreceding, 0))
    queued = materialize(
        placed.join(starts, ["place", "group"])
        .withColumn("cum", total)
        .drop("start", "group", "groups"),
        "queue",
    )

    # Offers by finish time; the budget ends in one slot of them, which alone is ordered.
    one = queued.agg(F.count("*").alias("n"), F.first("total").alias("total")).first()
    if not one["n"]:
        return Mix(queued.withColumn("copies", F.lit(0).cast("long")))
    fine = max(1, math.ceil(one["n"] * repeats / BUCKET_ROWS))
    offers = (
        queued.withColumn(
            "offer",
            F.explode(
                F.array(
                    *(
                        F.struct(_finish(i).alias("finish"), F.lit(i).alias("turn"))
                        for i in range(repeats)
                    )
                )
            ),
        )
        .select(words.alias("words"), F.struct("offer.finish", "place", "offer.turn", "key").alias("at"))
        .withColumn("slot", _slot(F.col("at.finish"), fine))
    )
    per_slot = offers.groupBy("slot").agg(F.sum("words").alias("sum"))
    last = (
        running(per_slot, ["slot"], ["sum"])
        .where(F.col("before_sum") + F.col("sum") > one["total"])
        .agg(F.min(F.struct("slot", "before_sum")).alias("last"))
        .first()["last"]
    )
    taken = [F.lit(1)] * repeats
    if last:
        # A slot may hold any number of offers: those of many sources that end at one time.
        order = ["finish", "place", "turn", "key"]
        inside = offers.where(F.col("slot") == last["slot"]).select("words", "at.*")
        fits = (
            running(inside, order, ["words"])
            .where(F.col("before_words") + F.col("words") <= one["total"] - last["before_sum"])
            .agg(F.max(F.struct(*order)).alias("at"))
            .first()["at"]
        )
        taken = [_taken(i, last["slot"], fits, fine) for i in range(repeats)]
    copies = sum(taken[1:], taken[0]).cast("long")
    return Mix(queued.withColumn("copies", copies))


def _finish(turn: int) -> Column:
    """When a document's offer of that turn ends; a source without words ends at once."""
    words = F.col("source_size") * turn + F.col("cum")
    return F.coalesce(F.try_divide(words.cast("double"), F.col("target")), F.lit(0.0))


def _slot(finish: Column, fine: int) -> Column:
    """Equal spans up to 2, where the budget ends; beyond, spans that grow."""
    late = 2 * fine + F.floor(F.log2(finish) * 64)
    return F.when(finish <= 2, F.floor(finish * fine)).otherwise(late).cast("long")


def _taken(turn: int, last: int, fits, fine: int) -> Column:
    finish = _finish(turn)
    slot = _slot(finish, fine)
    held = slot < last
    if fits is not None:
        at = F.struct(finish.alias("finish"), "place", F.lit(turn).alias("turn"), "key")
        cut = F.struct(*(F.lit(fits[c]).alias(c) for c in ("finish", "place", "turn", "key")))
        held = held | ((slot == last) & (at <= cut))
    return held.cast("int")


ORACLE = rf"""
WITH units AS (
  SELECT md5(concat_ws('|', doc_id, source, text,
      doc_id IS NULL, source IS NULL, text IS NULL)) AS key, any_value(doc_id) AS doc_id,
    any_value(source) AS source, count(*) AS m,
    any_value(coalesce(len(regexp_extract_all(text, '{WORD}')), 0)) AS size
  FROM documents GROUP BY key),
sources AS (
  SELECT source, CAST(sum(size * m) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM units GROUP BY source),
weighed AS (
  SELECT *, {REPEATS} * source_size AS bound, [{", ".join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1] AS w,
    {SHARE} * sum(source_size) OVER () AS total
  FROM sources),
stopped AS (
  SELECT *, (total - coalesce(sum(bound) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w
    >= bound * sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS stops
  FROM weighed WINDOW r AS (ORDER BY bound / w, place)),
aims AS (
  SELECT *, CASE WHEN stops THEN CAST(bound AS DOUBLE) ELSE
    (total - sum(CASE WHEN stops THEN bound ELSE 0 END) OVER ()) * w
      / sum(CASE WHEN stops THEN 0 ELSE w END) OVER () END AS target
  FROM stopped),
queued AS (
  SELECT u.*, a.source_size, a.target, a.place, a.total,
    sum(size * m) OVER (PARTITION BY place ORDER BY key ROWS UNBOUNDED PRECEDING) AS cum
  FROM units u JOIN aims a ON u.source IS NOT DISTINCT FROM a.source),
offers AS (
  SELECT *, coalesce((source_size * turn + cum) / target, 0) AS finish
  FROM queued, range({REPEATS}) t(turn)),
taken AS (
  SELECT key, count(*) AS copies FROM (
    SELECT *, sum(size * m) OVER (ORDER BY finish, place, turn, key ROWS UNBOUNDED PRECEDING) AS upto
    FROM offers)
  WHERE upto <= total GROUP BY key)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * coalesce(copies, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (key), range(m)
"""
