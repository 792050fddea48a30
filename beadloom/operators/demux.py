"""Sample demultiplexing by barcode triplets: calls, doublets, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beadloom.operators.stats import k_largest, zero_filled

#: Tags looked at for singlets and doublets, and tags of a group that must be among them.
SINGLET_TOP, DOUBLET_TOP, NEEDED = 5, 8, 3


def group_of_tags(triplets: DataFrame, tags: DataFrame) -> DataFrame:
    """(group, tag_idx) of triplets (group, t1, t2, t3) and tags (tag_idx, tag); a tag may be in several groups."""
    long = triplets.unpivot(["group"], ["t1", "t2", "t3"], "slot", "tag").select("group", "tag")
    return long.join(tags, "tag").select("group", "tag_idx").distinct()


def _ratio(counts: DataFrame, k: int, ratio: float) -> DataFrame:
    """Cells whose kth tag count is at least ratio times the next; 0 against 0 fails."""
    pair = k_largest(counts, "cell", "tag_idx", "count", k + 1).groupBy("cell").agg(F.max(F.when(F.col("rank") == k, F.col("count"))).alias("a"), F.max(F.when(F.col("rank") == k + 1, F.col("count"))).alias("b"))
    return pair.filter((F.col("a") >= ratio * F.coalesce("b", F.lit(0))) & (F.col("a") > 0)).select("cell")


def _votes(counts: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    best = k_largest(counts, "cell", "tag_idx", "count", top)
    return best.join(groups, "tag_idx").groupBy("cell", "group").agg(F.count("*").alias("tags"), F.avg("count").alias("mean")).filter(F.col("tags") >= NEEDED)


def thresholded(counts: DataFrame, k: int, threshold: float) -> DataFrame:
    """Rows of the cells whose kth largest count is at least the threshold."""
    fine = k_largest(counts, "cell", "tag_idx", "count", k).filter((F.col("rank") == k) & (F.col("count") >= threshold)).select("cell")
    return counts.join(fine, "cell", "left_semi")


def untied(counts: DataFrame, k: int) -> DataFrame:
    """Rows of the cells whose kth and next counts differ."""
    pair = k_largest(counts, "cell", "tag_idx", "count", k + 1).filter(F.col("rank") >= k).groupBy("cell").agg(F.count("*").alias("n"), F.min("count").alias("a"), F.max("count").alias("b"))
    return counts.join(pair.filter("n = 2 AND a <> b").select("cell"), "cell", "left_semi")


def calls(counts: DataFrame, groups: DataFrame, ratio: float = 1.0) -> DataFrame:
    """(cell, group, doublet) of counts (cell, tag_idx, count) and groups (group, tag_idx).

    A cell is called for a group three of whose tags are among its five largest counts; of several the greatest mean
    wins, ties to the smaller group. The third count must be at least ratio times the fourth. doublet: more than one
    group has three tags among the eight largest, and the eighth is at least ratio times the ninth.
    """
    voted = _votes(counts, groups, SINGLET_TOP).groupBy("cell").agg(F.max_by("group", F.struct("mean", -F.col("group"))).alias("group"))
    called = voted.join(_ratio(counts, NEEDED, ratio), "cell", "left_semi")
    return called.join(doublets(counts, groups, ratio).select("cell").withColumn("doublet", F.lit(True)), "cell", "left").withColumn("doublet", F.coalesce("doublet", F.lit(False)))


def doublets(counts: DataFrame, groups: DataFrame, ratio: float = 1.0) -> DataFrame:
    """(cell, pair) of cells with several groups; pair is their numbers joined by '-'."""
    many = _votes(counts, groups, DOUBLET_TOP).groupBy("cell").agg(F.sort_array(F.collect_set("group")).alias("g")).filter(F.size("g") > 1)
    return many.join(_ratio(counts, DOUBLET_TOP, ratio), "cell", "left_semi").select("cell", F.array_join(F.transform("g", lambda g: g.cast("string")), "-").alias("pair"))


def doublet_rate(called: DataFrame) -> DataFrame:
    """(rate): share of called cells that are doublets."""
    return called.agg(F.try_divide(F.count_if("doublet"), F.count("*")).alias("rate"))


def group_sizes(called: DataFrame, groups: int = 96) -> DataFrame:
    return zero_filled(called.filter("NOT doublet"), "group", groups)


def wide_groups(called: DataFrame) -> DataFrame:
    """One row for each place in a group and a column for each group, '' where a group has no more cells."""
    ranked = called.withColumn("place", F.row_number().over(Window.partitionBy("group").orderBy("cell")))
    return ranked.groupBy("place").pivot("group").agg(F.first("cell")).na.fill("").orderBy("place")
