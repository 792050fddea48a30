"""Connected components of large edge tables by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beadloom.llm.common import drop, in_all_pieces, in_piece, pieces, stash


def _with_least(edges: DataFrame, rows: int) -> DataFrame:
    """edges (u, v) with m, the least v of each u. A u with many edges is dealt into pieces; rows: number of edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hot = pieces(least.select("u", "n"), "u", total=rows)
    return in_piece(edges, "u", hot, F.xxhash64("v")).join(in_all_pieces(least.select("u", "m"), "u", hot), ["u", "p"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): for each node of edges (u, v) the smallest node that it reaches. Self-loops and nulls are ignored.

    Rounds go on until nothing changes; their number grows with the logarithm of the longest path. Each round is
    written to the shared scratch folder, so lost executors cost one round at most. Edges never multiply: a round
    gives at most as many as it got. An empty table gives an empty one.
    """
    now = edges.select("u", "v").dropna().filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stash(now, "edges")
    state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        starred = _with_least(both, 2 * state[0]).filter("v > u")
        large = stash(starred.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "edges")
        small = _with_least(large, state[0])
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        before, was = state, now
        now = stash(small, "edges")
        drop(was, large)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id")
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
