"""Exact top-k inner products by columnar branch and bound."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.session import materialize

BLOCK = 8  # dimensions that are added between two prunings
# Vectors one task holds of either side.  Every row is shuffled once for each block of
# queries, so that block is as large as a task can hold.
QUERY_BLOCK, ROW_BLOCK = 16_384, 16_384
SEED = 256  # rows of a block that are scored in full to start the thresholds
RAISED = 4096  # rows left at most for the thresholds to be raised between blocks
EXACT = 1 << 53  # whole numbers below this are exact as doubles


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component; null where one is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(fine, whole)


def _bounded_top(queries: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple]:
    """Per query the positions and scores of all rows that can be among its best k.

    ``rows`` is held by dimension.  Partial scores grow by a block of dimensions at
    a time; what the dimensions left can still add is at most the product of the
    two remaining norms (Cauchy-Schwarz).  Rows whose bound is below the k-th best
    score known so far are dropped, and the survivors are packed together.
    """
    n_dims, n_rows = rows.shape
    norm = lambda x: math.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=1))
    most = norm(queries) * norm(rows.T) * (1 + 1e-9)  # no sum of products is larger
    if most >= 1 << 63:
        raise OverflowError("scores of these vectors do not fit 64 bits")
    # Above 2 ** 53 sums are whole numbers, and bounds allow for their rounding as doubles.
    slack = 0.0 if most < EXACT else 4.0 * most / EXACT
    if not slack:
        queries, rows = queries.astype(np.float64), rows.astype(np.float64)
    cuts = list(range(0, n_dims, BLOCK))
    tails = lambda x: np.sqrt(np.cumsum((x.astype(np.float64) ** 2)[::-1], axis=0)[::-1])
    row_tails, query_tails = tails(rows)[cuts], tails(queries.T)[cuts]
    seeds = rows[:, :SEED]
    for i, q in enumerate(queries):
        seed = q @ seeds
        known = float(np.partition(seed, -k)[-k]) if len(seed) >= k else -math.inf
        alive = np.arange(n_rows)
        score = np.zeros(n_rows, dtype=rows.dtype)
        for b, at in enumerate(cuts):
            # A hair above, for the rounding of the norms.
            left = query_tails[b, i] * row_tails[b, alive] * (1 + 1e-9) + slack
            if b and k <= len(alive) <= RAISED:
                # What the k-th best row has at the least once the rest is added.
                known = max(known, float(np.partition(score - left, -k)[-k]))
            keep = score + left >= known
            if not keep.all():
                alive, score = alive[keep], score[keep]
            part = slice(at, at + BLOCK)
            if len(alive) == n_rows:
                score = score + q[part] @ rows[part]
            else:
                score = score + q[part] @ rows[part, alive]
        if len(score) > k:
            least = np.partition(score, -k)[-k]
            alive, score = alive[score >= least], score[score >= least]
        yield alive, score


def _block_top(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        if queries.empty or rows.empty:
            return empty
        ids = rows["vec_id"].to_numpy()
        sets = np.stack(rows["v"].to_numpy()).T.copy()
        asked = queries["query_id"].to_numpy()
        vectors = np.stack(queries["v"].to_numpy())
        out = []
        # The query's own rows may be among the best.
        most = k + int(np.unique(ids, return_counts=True)[1].max())
        for q, (at, score) in zip(asked, _bounded_top(vectors, sets, most), strict=True):
            other = ids[at] != q
            at, score = at[other], score[other]
            best = np.lexsort((ids[at], -score))[:k]
            out.append(
                pd.DataFrame(
                    {"query_id": q, "vec_id": ids[at[best]], "score": score[best].astype("int64")}
                )
            )
        return pd.concat(out) if out else empty

    return run


def exact_top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best rows.

    ``vectors`` has ``vec_id`` and ``embedding``.  Queries are the rows whose vec_id
    is divisible by ``every``; candidates are all rows but those with the query's own
    vec_id.  The score is the inner product of the components as whole numbers
    (``quantised``); ties go to the smaller vec_id.

    Vectors that are null or hold a null or non-finite component take no part, and
    neither do rows without a vec_id.  Vectors of different lengths are never
    compared.  Repeated rows count once.  Empty vectors score 0.  A query with fewer
    than k candidates gets all of them, an empty table an empty result.  Scores that may
    not fit 64 bits are refused.  A very long vector is held by one task with those of its
    block.  Other columns are ignored.

    Queries and rows meet in blocks, so neither side is broadcast; within a block
    the work is the bounded search above, and only k rows a query leave it.
    """
    usable = materialize(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            quantised(F.col("embedding"), scale).alias("v"),
        )
        .where("vec_id IS NOT NULL AND v IS NOT NULL")
        .distinct()
        .withColumn("dims", F.size("v")),
        "vectors",
    )
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    sizes = usable.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    query_blocks = max(1, math.ceil(sizes["q"] / QUERY_BLOCK))
    row_blocks = max(1, math.ceil(sizes["n"] / ROW_BLOCK))

    def dealt(own: str, blocks: int, other: str, copies: int) -> list[Column]:
        every_other = F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
        return [block.alias(own), F.explode(every_other).alias(other)]

    queries = usable.where(is_query).select(
        F.col("vec_id").alias("query_id"), "v", "dims", *dealt("qb", query_blocks, "rb", row_blocks)
    )
    rows = usable.select("vec_id", "v", "dims", *dealt("rb", row_blocks, "qb", query_blocks))
    best = (
        queries.groupBy("dims", "qb", "rb")
        .cogroup(rows.groupBy("dims", "qb", "rb"))
        .applyInPandas(_block_top(k), "query_id long, vec_id long, score long")
    )
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.distinct()
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
