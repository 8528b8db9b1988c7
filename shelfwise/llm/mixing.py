"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, Stages

#: A document is taken at most this often, and a source at most this many times its size.
MOST = 3
#: Sums that a knapsack may hold before no more documents are given back to it (a bound of memory).
SUMS = 1 << 26
#: Parts by seeded order that the documents of one source and size are ranked in.
PARTS = 4_096
#: Documents of each size that are kept for the exact fit.
SPARE = 4


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def target_sizes(sizes: list[int], weights: list[float]) -> list[float]:
    """Shares of the whole by weight; a source stops at MOST times its size, and the excess is
    shared again by weight among the others until none is above."""
    targets = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > MOST * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(MOST * sizes[i])
            left -= targets[i]
            open_.remove(i)
    return targets


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, copies: int = 1) -> np.ndarray:
    """How many to take of each size so that the words come nearest to ``budget``, below or above.

    Every document may be taken ``copies`` times. Each size first gives its even share but for a few
    documents, so the mix keeps the source's lengths, and the largest sizes fill up to twice the
    largest document below the budget. The rest is a bounded knapsack over all that is left. If no
    sum hits the budget, it is done again with less given before, at last with nothing: then the
    knapsack holds every document, and the nearest sum is the nearest there is.
    """
    taken = np.zeros(len(sizes), np.int64)
    used = np.flatnonzero((sizes > 0) & (counts > 0))
    if not len(used) or budget <= 0:
        return taken
    used = used[np.argsort(-sizes[used], kind="stable")]
    unit = int(np.gcd.reduce(sizes[used]))
    size, count = sizes[used] // unit, counts[used]
    goal = budget / unit
    spare, best = SPARE, None
    while True:
        given = np.array([int(c * goal // max(int((size * count).sum()), 1)) for c in count], np.int64)
        given = np.clip(given - spare, 0, count)
        below = 2 * int(size[0]) * max(1, spare // SPARE)
        left = int(goal) - int((size * given).sum())
        for i, (each, free) in enumerate(zip(size.tolist(), (count - given).tolist())):
            if left > below:
                more = min(free, (left - below) // each)
                given[i] += more
                left -= more * each
        for times in sorted({1, copies}):
            rest = goal - int((size * given).sum())
            made = given + nearest_sum(size, count * times - given, rest)
            off = abs(int((size * made).sum()) - goal)
            if best is None or off < best[0]:
                best = off, made
            if best[0] <= 0.5:
                break
        if best[0] <= 0.5 or not given.any() or below > SUMS:
            break
        spare *= 8
    taken[used] = best[1]
    return taken


def nearest_sum(sizes: np.ndarray, free: np.ndarray, goal: float) -> np.ndarray:
    """Counts, at most ``free``, whose sizes sum up nearest to ``goal``; of two, the lower sum.

    A bounded knapsack: a count is split in powers of two, and each sum remembers the item that
    first made it. Sums are followed up to the largest size above the goal, where the next higher
    one lies at the latest.
    """
    more = np.zeros(len(sizes), np.int64)
    room = free > 0
    if not room.any() or goal <= 0:
        return more
    most = min(int(goal) + int(sizes[room].max()), int((sizes * free).sum()))
    made = np.zeros(most + 1, bool)
    made[0] = True
    by = np.full(most + 1, -1, np.int32)
    items: list[tuple[int, int]] = []
    hit = math.ceil(goal - 0.5)
    for i, (size, n) in enumerate(zip(sizes.tolist(), free.tolist())):
        n, part = min(n, most // size), 1
        while n > 0 and not (hit <= most and made[hit]):
            part = min(part, n)
            step = part * size
            new = np.flatnonzero(made[:-step] & ~made[step:]) + step
            by[new] = len(items)
            made[new] = True
            items.append((i, part))
            n, part = n - part, part * 2
    sums = np.flatnonzero(made)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    while at:
        i, part = items[by[at]]
        more[i] += part
        at -= part * int(sizes[i])
    return more


def mix(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text",
    source: str = "source", weights: tuple[float, ...] = (1, 2, 3), seed: int = 0,
) -> DataFrame:
    """key, size, source_size, target, copies and taken for every document.

    Sources by code point, null last, take the weights in turn. A source whose target is at least
    its size is taken whole as often as fits; the remaining budget is fitted by counts per document
    size to the nearest sum, which may lie above it, and the documents of a size are taken in the seeded order of their keys. Only counts by
    source and size meet in one task: at most as many rows as a source has different sizes. Equal
    rows are told apart by nothing, so which of them is taken makes no difference. A null text has
    size 0, and documents of size 0 are in the mix only as often as their whole source is.
    """
    made = _mixed(docs, stages, F.col(key), key, text, source, weights, seed)
    return made.select(
        F.col("row").alias(key), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text",
    source: str = "source", weights: tuple[float, ...] = (1, 2, 3), seed: int = 0,
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as :func:`mix` takes it."""
    made = _mixed(docs, stages, F.struct(*docs.columns), key, text, source, weights, seed)
    copies = F.explode(F.expr("sequence(1L, copies)"))
    return made.where(F.col("copies") > 0).select("row", copies).select("row.*")


def _mixed(docs, stages, row: Column, key, text, source, weights, seed) -> DataFrame:
    order = F.struct(
        F.xxhash64(F.lit(seed), F.col(key).cast("string")).alias("h"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col(text), F.lit(""))).alias("t"),
    )
    origin = F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source)))
    sized = docs.select(
        row.alias("row"), origin.alias("origin"), size_of(F.col(text)).alias("size"),
        order.alias("order"),
    )
    sized = stages.put(
        "sized", sized.withColumn("part", F.pmod(F.shiftright("order.h", 20), F.lit(PARTS)))
    )
    totals = sized.groupBy("origin").agg(F.sum("size").alias("words")).toPandas()
    rows = sorted(totals.itertuples(index=False), key=lambda r: (r[0] == "-", r[0]))
    names, sizes = [r[0] for r in rows], [int(r[1]) for r in rows]
    targets = target_sizes(sizes, [weights[i % len(weights)] for i in range(len(rows))])
    plans = [
        (g, s, t, min(MOST, int(t // s)) if s else 0) for g, s, t in zip(names, sizes, targets)
    ]
    plan = docs.sparkSession.createDataFrame(
        [(g, s, float(t), r, round(t - r * s) if r < MOST else 0) for g, s, t, r in plans],
        "origin string, source_size long, target double, whole long, budget long",
    )

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        more = fit_budget(
            frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64),
            int(frame["budget"].iloc[0]), MOST - int(frame["whole"].iloc[0]),
        )
        return frame[["origin", "size"]].assign(docs=frame["n"], quota=more)

    parts = stages.put("parts", sized.groupBy("origin", "size", "part").agg(F.count("*").alias("n")))
    by_size = parts.groupBy("origin", "size").agg(F.sum("n").alias("n"))
    quotas = (
        by_size.join(plan, "origin").groupBy("origin")
        .applyInPandas(fitted, "origin string, size long, docs long, quota long")
    )
    before = Window.partitionBy("origin", "size").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    room = (
        parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(quotas, ["origin", "size"])
        .select("origin", "size", "part", F.expr("quota div docs").alias("each"),
                (F.expr("quota % docs") - F.col("before")).alias("room"))
    )
    rank = F.row_number().over(Window.partitionBy("origin", "size", "part").orderBy("order"))
    ranked = sized.withColumn("rank", rank).join(room, ["origin", "size", "part"])
    ranked = ranked.join(plan, "origin")
    return ranked.withColumn(
        "copies", F.col("whole") + F.col("each") + (F.col("rank") <= F.col("room")).cast("long")
    )
