"""Weighted density clustering of each cell's beads, its thresholds, and cell placement."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beadloom.operators.stats import ecdf_score, most_covered


def _near(xy: np.ndarray, eps: float) -> np.ndarray:
    """Whether two points are within eps, for all pairs of one cell's points."""
    d = xy[:, None, :] - xy[None, :, :]
    return (d * d).sum(axis=2) <= eps * eps


def dbscan(xy: np.ndarray, weight: np.ndarray, eps: float, min_pts: float, near: np.ndarray | None = None) -> np.ndarray:
    """Cluster of each point, numbered from 1 in order of first points; 0 for noise.

    A point is core if the weights within eps, its own included, sum to min_pts. Core points within eps of each other
    share a cluster; another point joins the lowest-numbered cluster that has a core point within eps.
    """
    near = _near(xy, eps) if near is None else near
    core = near @ weight >= min_pts
    label, found = np.zeros(len(xy), np.int64), 0
    for k in np.flatnonzero(core):
        if label[k]:
            continue
        found += 1
        front = np.zeros(len(xy), bool)
        front[k] = True
        while front.any():
            label[front] = found
            front = near[front].any(axis=0) & core & (label == 0)
    for c in range(found, 0, -1):  # lower numbers overwrite
        reach = near[(label == c) & core].any(axis=0) & ~core
        label[reach] = c
    order = {}
    for v in label[label > 0]:
        order.setdefault(v, len(order) + 1)
    return np.array([order.get(v, 0) for v in label], np.int64)


def bounds(xy: np.ndarray, weight: np.ndarray, eps: float) -> tuple[int, int]:
    """(i2, i1): the greatest thresholds that give two clusters at least, and one.

    i1 is the greatest weight within eps of a point. The number of clusters doesn't fall steadily as the threshold
    rises, so for i2 the distinct weights are gone through from above.
    """
    if not len(xy):
        return 0, 0
    near = _near(xy, eps)
    ball = near @ weight
    i1 = int(ball.max())
    for t in np.unique(ball)[::-1]:
        core = near & (ball >= t)[None, :] & (ball >= t)[:, None]
        left = np.flatnonzero(ball >= t)
        seen = np.zeros(len(xy), bool)
        seen[left[0]] = True
        while True:
            more = core[seen].any(axis=0) & ~seen
            if not more.any():
                break
            seen |= more
        if seen.sum() < len(left):
            return int(t), i1
    return 0, i1


def _centroids(p: pd.DataFrame, label: np.ndarray) -> np.ndarray:
    w, xy = p["umi"].to_numpy(float), p[["x", "y"]].to_numpy(float)
    return np.array([(xy[label == c] * w[label == c, None]).sum(axis=0) / w[label == c].sum() for c in range(1, label.max() + 1)])


def merged(p: pd.DataFrame, label: np.ndarray, reach: float) -> np.ndarray:
    """Clusters whose centroid is within reach of the first one's join it; the rest are renumbered."""
    if reach <= 0 or label.max() < 2:
        return label
    c = _centroids(p, label)
    close = np.flatnonzero(np.hypot(*(c - c[0]).T) < reach) + 1
    label = np.where(np.isin(label, close), 1, label)
    _, dense = np.unique(label[label > 0], return_inverse=True)
    out = label.copy()
    out[label > 0] = dense + 1
    return out


def _sorted(p: pd.DataFrame) -> pd.DataFrame:
    return p.sort_values(["umi", "sb"], ascending=[False, True], kind="stable").reset_index(drop=True)


def cell_bounds(points: DataFrame, eps: float, cmes: float = 0.0) -> DataFrame:
    """(cb, i2, i1) of points (cb, sb, x, y, umi); with cmes, i2 falls while all clusters lie within eps * cmes of the first."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = _sorted(p)
        xy, w = p[["x", "y"]].to_numpy(float), p["umi"].to_numpy(float)
        i2, i1 = bounds(xy, w, eps)
        while cmes > 0 and i2 >= 1:
            label = dbscan(xy, w, eps, i2)
            c = _centroids(p, label) if label.max() else np.zeros((1, 2))
            if np.hypot(*(c - c[0]).T).max() >= eps * cmes:
                break
            i2 -= 1
        return pd.DataFrame({"cb": [p["cb"][0]], "i2": [i2], "i1": [i1]})

    kind = points.schema["cb"].dataType.simpleString()
    return points.select("cb", "sb", "x", "y", "umi").groupBy("cb").applyInPandas(run, f"cb {kind}, i2 bigint, i1 bigint")


def global_threshold(ranges: DataFrame) -> DataFrame:
    """(point, covered): the threshold that gives one cluster in most cells."""
    return most_covered(ranges, "i2", "i1")


def clusters(points: DataFrame, eps: float, min_pts: float | str, cmes: float = 0.0) -> DataFrame:
    """points (cb, sb, x, y, umi) with cluster; min_pts is a number, or a column of points for a threshold a cell."""
    per_cell = isinstance(min_pts, str)
    fields = ["cb", "sb", "x", "y", "umi", *([min_pts] if per_cell else [])]

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = _sorted(p)
        t = float(p[min_pts][0]) if per_cell else float(min_pts)
        label = dbscan(p[["x", "y"]].to_numpy(float), p["umi"].to_numpy(float), eps, t)
        return p[["cb", "sb", "x", "y", "umi"]].assign(cluster=merged(p, label, eps * cmes))

    out = points.select(*fields).drop(min_pts) if per_cell else points.select(*fields)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
    return points.select(*fields).groupBy("cb").applyInPandas(run, f"{schema}, cluster bigint")


def placement(clustered: DataFrame, cells: DataFrame) -> DataFrame:
    """A row for each cell: umi, beads, clusters, and of cells with one cluster its weighted centroid, umi and rmsd.

    Cells without beads count 0 of everything.
    """
    one = F.col("cluster") == 1
    w = F.when(one, F.col("umi"))
    stats = clustered.groupBy("cb").agg(F.sum("umi").alias("umi"), F.count("*").alias("beads"), F.max("cluster").alias("clusters"), F.sum(w).alias("_w"), F.sum(w * F.col("x")).alias("_x"), F.sum(w * F.col("y")).alias("_y"))
    spread = clustered.filter(one).join(stats.select("cb", (F.col("_x") / F.col("_w")).alias("_mx"), (F.col("_y") / F.col("_w")).alias("_my")), "cb")
    spread = spread.groupBy("cb").agg(F.sqrt(F.sum(F.col("umi") * (F.pow(F.col("x") - F.col("_mx"), 2) + F.pow(F.col("y") - F.col("_my"), 2))) / F.sum("umi")).alias("_r"))
    out = cells.select("cb").distinct().join(stats, "cb", "left").join(spread, "cb", "left")
    single = F.col("clusters") == 1
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select("cb", zero("umi"), zero("beads"), zero("clusters"), F.when(single, F.col("_x") / F.col("_w")).alias("x"), F.when(single, F.col("_y") / F.col("_w")).alias("y"), F.when(single, F.col("_w")).alias("umi1"), F.when(single, F.col("_r")).alias("rmsd"))


def dynamic_placement(points: DataFrame, ranges: DataFrame, eps: float, cmes: float = 0.0) -> DataFrame:
    """(cb, x1, y1, umi1, x2, y2, umi2, score): the two heaviest clusters of each cell at its own threshold.

    The threshold is i2 where it is positive, else i1. score: see stats.ecdf_score().
    """
    own = points.join(ranges.select("cb", F.when(F.col("i2") > 0, F.col("i2")).otherwise(F.col("i1")).alias("_t")), "cb")
    found = clusters(own, eps, "_t", cmes).filter("cluster > 0")
    sums = found.groupBy("cb", "cluster").agg(F.sum("umi").alias("umi"), (F.sum(F.col("umi") * F.col("x")) / F.sum("umi")).alias("x"), (F.sum(F.col("umi") * F.col("y")) / F.sum("umi")).alias("y"))
    ranked = sums.withColumn("_r", F.row_number().over(Window.partitionBy("cb").orderBy(F.desc("umi"), "cluster"))).filter("_r <= 2")
    wide = ranked.groupBy("cb").agg(*(F.max(F.when(F.col("_r") == r, F.col(c))).alias(f"{c}{r}") for r in (1, 2) for c in ("x", "y", "umi")))
    return ecdf_score(wide, "umi1", "umi2")


def bead_eps(pucks: DataFrame, k: int = 36, sample: int = 10_000, cell: float | None = None, seed: int = 0) -> float:
    """Median distance to the kth nearest bead, itself counted, over about `sample` beads picked by hash.

    Beads and samples meet in grid cells and the eight around them. Where a sample finds fewer than k there, the grid is
    made twice as coarse, until all have found theirs within one cell's width.
    """
    n = pucks.count()
    if n < k:
        raise ValueError(f"{n} beads; {k} are needed")
    picked = pucks.filter(F.pmod(F.xxhash64("sb", F.lit(seed)), F.lit(1 << 30)) < min(1.0, sample / n) * (1 << 30))
    if not picked.limit(1).count():
        picked = pucks
    box = pucks.agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).first()
    width = cell or max(2.0 * (max(box[0], 1e-9) * max(box[1], 1e-9) * k / n) ** 0.5, 1e-9)
    while True:
        at = lambda c: F.floor(F.col(c) / width)
        beads = pucks.select(F.col("x").alias("bx"), F.col("y").alias("by"), at("x").alias("gx"), at("y").alias("gy"))
        around = F.explode(F.array(*(F.struct((at("x") + i).alias("gx"), (at("y") + j).alias("gy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("g")
        asked = picked.select("sb", "x", "y", around).select("sb", "x", "y", "g.gx", "g.gy")
        d = asked.join(beads, ["gx", "gy"]).select("sb", "x", "y", F.hypot(F.col("x") - F.col("bx"), F.col("y") - F.col("by")).alias("d")).filter(F.col("d") <= width)
        kth = d.withColumn("r", F.row_number().over(Window.partitionBy("sb", "x", "y").orderBy("d"))).filter(F.col("r") == k)
        got = kth.agg(F.count("*").alias("n"), F.median("d").alias("m")).first()
        if got["n"] == picked.select("sb", "x", "y").distinct().count():
            return float(got["m"])
        width *= 2
