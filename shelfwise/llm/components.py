"""Connected components by distributed union-find, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages


def components(edges: DataFrame, stages: Stages, name: str) -> DataFrame:
    """id, root: the smallest id reachable from every id that has an edge (a, b).

    Each round hangs the larger neighbours of every id under its smallest one, then the smaller
    neighbours; the rounds needed grow with the logarithm of the longest chain. Edges and the
    smallest neighbours are stage tables, so both sides of the join are read from files and an id
    with very many edges is split among tasks. Only two sums per round reach the driver.
    """
    kept = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a <> b").distinct()
    kept, before, turn = stages.put(f"{name}-0", kept), None, 0
    while True:
        state = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before, turn = tuple(state), turn + 1
        # Larger neighbours: every edge, seen from both of its ends.
        low = stages.put(
            f"{name}-{turn}-low",
            kept.select(F.col("a").alias("id"), F.col("b").alias("to"))
            .unionByName(kept.select(F.col("b").alias("id"), F.col("a").alias("to")))
            .groupBy("id").agg(F.least(F.min("to"), F.min("id")).alias("low")),
        )
        # An edge (a, b), a > b, is hung under the smallest neighbour of b.
        up = kept.join(low, F.col("b") == F.col("id")).select("a", F.col("low").alias("b"))
        up = stages.put(f"{name}-{turn}-up", up.distinct())
        # Smaller neighbours: all of them are hung under the smallest.
        least = stages.put(f"{name}-{turn}-least", up.groupBy("a").agg(F.min("b").alias("low")))
        down = (
            up.join(least.withColumnRenamed("a", "id"), F.col("a") == F.col("id"))
            .where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(least.select("a", F.col("low").alias("b")))
        )
        kept = stages.put(f"{name}-{turn}", down.distinct())
    return kept.select(F.col("a").alias("id"), F.col("b").alias("root"))
