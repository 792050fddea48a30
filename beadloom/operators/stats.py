"""Cutoffs, intervals and statistics over grouped values."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def elbow(df: DataFrame, value: str) -> DataFrame:
    """(rank, value): values in falling order without the inside of equal runs.

    Runs come from a histogram: a value v that n rows have takes ranks before + 1 ... before + n, of which the first and
    last are kept. Only the histogram, a row a distinct value, is ordered in one task.
    """
    hist = df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("_n"))
    upto = hist.withColumn("_to", F.sum("_n").over(Window.orderBy(F.desc("value"))))
    ends = F.array_distinct(F.array(F.col("_to") - F.col("_n") + 1, F.col("_to")))
    return upto.select(F.explode(ends).alias("rank"), "value")


def cutoff_manual(df: DataFrame, value: str, n: int) -> DataFrame:
    """(cutoff): the greatest value that at least n rows reach; the least value if fewer rows exist."""
    hist = df.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("_n"))
    upto = hist.withColumn("_to", F.sum("_n").over(Window.orderBy(F.desc("v"))))
    return upto.agg(F.coalesce(F.max(F.when(F.col("_to") >= n, F.col("v"))), F.min("v")).alias("cutoff"))


def cutoff_auto(df: DataFrame, value: str, low: int = 10, high: int = 1000) -> DataFrame:
    """(cutoff): where the log-log elbow curve falls most steeply, taken two points further on.

    The slope at a point is the central difference over its neighbours on the curve of elbow(); points whose value lies
    within low ... high count; of equal slopes the first wins.
    """
    curve = elbow(df, value).select(F.col("rank"), F.log10("rank").alias("x"), F.log10("value").alias("y"), F.col("value").alias("v"))
    w = Window.orderBy("rank")
    slope = (F.lead("y").over(w) - F.lag("y").over(w)) / (F.lead("x").over(w) - F.lag("x").over(w))
    points = curve.withColumns({"slope": F.round(slope, 12), "then": F.lead("y", 2).over(w)}).filter(F.col("v").between(low, high) & F.col("slope").isNotNull() & F.col("then").isNotNull())
    best = points.agg(F.min_by("then", F.struct("slope", "rank")).alias("_y"))
    return best.select(F.round(F.pow(F.lit(10.0), "_y")).cast("bigint").alias("cutoff"))


def kde_mode(values: np.ndarray, weights: np.ndarray, points: int = 2048) -> float:
    """Where a Gaussian kernel density of weighted values is greatest (bandwidth by Silverman's rule)."""
    total = weights.sum()
    mean = (values * weights).sum() / total
    sd = np.sqrt((weights * (values - mean) ** 2).sum() / max(total - 1, 1))
    order = np.argsort(values)
    upto = np.cumsum(weights[order])
    quartile = lambda q: values[order][np.searchsorted(upto, q * total)]
    spread = min(x for x in (sd, (quartile(0.75) - quartile(0.25)) / 1.34, np.inf) if x > 0) if sd > 0 else 1e-9
    width = 0.9 * spread * total**-0.2
    grid = np.linspace(values.min() - 4 * width, values.max() + 4 * width, points)
    density = (weights * np.exp(-0.5 * ((grid[:, None] - values) / width) ** 2)).sum(axis=1)
    return float(grid[density.argmax()])


def connection_cutoff(df: DataFrame, connections: str, z: float = 3.0) -> DataFrame:
    """(mode, sd, cutoff) of log10 connections: cutoff is 10^(mode + z * sd), sd that of a half-normal above the mode.

    The driver gets the histogram of counts, a row a distinct count; the density is fitted there.
    """
    hist = df.groupBy(F.col(connections).cast("double").alias("v")).agg(F.count("*").alias("n")).filter("v > 0").toPandas()
    if not len(hist):
        return df.sparkSession.createDataFrame([(None, None, None)], "mode double, sd double, cutoff double")
    v, n = np.log10(hist["v"].to_numpy()), hist["n"].to_numpy(dtype=float)
    mode = kde_mode(v, n)
    above = v > mode
    sd = float((n[above] * (v[above] - mode)).sum() / n[above].sum() * np.sqrt(np.pi / 2)) if above.any() else 0.0
    return df.sparkSession.createDataFrame([(mode, sd, float(10 ** (mode + z * sd)))], "mode double, sd double, cutoff double")


def smoothed(hist: DataFrame, value: str, n: str, grid: list[float], scale: float) -> DataFrame:
    """(x, density): the histogram smoothed with an exponential kernel at the grid's points."""
    at = F.explode(F.array(*map(F.lit, grid))).alias("x")
    return hist.select(at, value, n).groupBy("x").agg(F.sum(F.col(n) * F.exp(-F.abs(F.col(value) - F.col("x")) / scale)).alias("density"))


def interval_union(df: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """(key, start, end): intervals of each key merged where they overlap or touch."""
    w = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = df.withColumn("_new", F.coalesce((F.col(start) > before).cast("int"), F.lit(1))).withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "_i").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_i")


def stabbing_counts(points: DataFrame, intervals: DataFrame, key: str, pos: str, start: str = "start", end: str = "end", buffer: int | None = None) -> DataFrame:
    """points with covers: intervals of the same key with start <= pos < end.

    With buffer b, those that reach more than b beyond pos on both sides: start + b < pos and pos + b < end. Positions
    are whole numbers. A sweep: each interval opens at its first covered position and closes after its last, equal
    events are summed first, and a running sum by key meets the points; nothing grows with points times intervals.
    """
    first, last = (F.col(start), F.col(end)) if buffer is None else (F.col(start) + buffer + 1, F.col(end) - buffer)
    i = intervals.select(F.col(key).alias("_k"), first.alias("_a"), last.alias("_b")).filter("_a < _b")
    events = i.select("_k", F.explode(F.array(F.struct(F.col("_a").alias("at"), F.lit(1).alias("d")), F.struct(F.col("_b").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    asked = points.select(F.col(key).alias("_k"), F.col(pos).alias("_p"), F.lit(0).cast("bigint").alias("_d"), F.lit(1).alias("_q")).distinct()
    steps = events.groupBy("_k", F.col("e.at").cast(points.schema[pos].dataType).alias("_p")).agg(F.sum("e.d").alias("_d")).withColumn("_q", F.lit(0))
    both = steps.unionByName(asked)
    covers = F.sum("_d").over(Window.partitionBy("_k").orderBy("_p", "_q").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("covers", covers).filter("_q = 1").select(F.col("_k").alias(key), F.col("_p").alias(pos), "covers")
    return points.join(found, [key, pos], "left").withColumn("covers", F.coalesce("covers", F.lit(0)))


def most_covered(df: DataFrame, low: str, high: str) -> DataFrame:
    """(point, covered): the integer in most ranges low + 1 ... high; of equal ones the largest. A sweep over ends."""
    r = df.filter(F.col(low) < F.col(high))
    events = r.select((F.col(low) + 1).alias("at"), F.lit(1).alias("d")).unionByName(r.select((F.col(high) + 1).alias("at"), F.lit(-1).alias("d"))).groupBy("at").agg(F.sum("d").alias("d"))
    w = Window.orderBy("at")
    cover = events.withColumn("covered", F.sum("d").over(w)).withColumn("point", F.lead("at").over(w) - 1)
    return cover.filter("point IS NOT NULL").agg(F.max_by(F.struct("point", "covered"), F.struct("covered", "point")).alias("b")).select("b.*")


def h_index(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, h): the greatest of min(x, number of values >= x) over the values x of each key."""
    hist = df.groupBy(key, value).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(key).orderBy(F.desc(value)))
    return hist.withColumn("_h", F.least(F.col(value), upto)).groupBy(key).agg(F.max("_h").alias("h"))


def weighted_centroid(df: DataFrame, key: str, x: str = "x", y: str = "y", w: str = "umi") -> DataFrame:
    """(key, x, y, rmsd): weighted mean point and root mean square distance to it. Two passes over one shuffle."""
    by = Window.partitionBy(key)
    mean = lambda c: F.sum(F.col(w) * F.col(c)).over(by) / F.sum(w).over(by)
    out = df.withColumns({"_x": mean(x), "_y": mean(y)})
    d2 = F.pow(F.col(x) - F.col("_x"), 2) + F.pow(F.col(y) - F.col("_y"), 2)
    return out.groupBy(key).agg(F.first("_x").alias("x"), F.first("_y").alias("y"), F.sqrt(F.sum(F.col(w) * d2) / F.sum(w)).alias("rmsd"))


def ecdf_score(df: DataFrame, first: str, second: str) -> DataFrame:
    """df with score: (1 - F1(second) / F1(first)) * F2(first), or F2(first) where second is null.

    F1 and F2 are the empirical distribution functions of the two columns, nulls left out; without any second value F2
    is null. Values are turned into counts by distinct value before the ordered sums.
    """

    def at(sample: str, queries: list[str]) -> DataFrame:
        values = df.select(F.col(sample).cast("double").alias("v"), F.lit(1).alias("n"))
        asked = [df.select(F.col(q).cast("double").alias("v"), F.lit(0).alias("n")) for q in queries]
        for a in asked:
            values = values.unionByName(a)
        values = values.filter("v IS NOT NULL").groupBy("v").agg(F.sum("n").alias("n"))
        return values.select("v", F.try_divide(F.sum("n").over(Window.orderBy("v")), F.sum("n").over(Window.partitionBy())).alias("f"))

    f1, f2 = at(first, [second]), at(second, [first])
    out = df
    for name, table, column in (("_f1s", f1, second), ("_f1f", f1, first), ("_f2f", f2, first)):
        out = out.join(table.select(F.col("v").alias(f"{name}v"), F.col("f").alias(name)), F.col(column).cast("double") == F.col(f"{name}v"), "left").drop(f"{name}v")
    score = F.when(F.col(second).isNull(), F.col("_f2f")).otherwise((1 - F.try_divide(F.col("_f1s"), F.col("_f1f"))) * F.col("_f2f"))
    return out.withColumn("score", score).drop("_f1s", "_f1f", "_f2f")


def top2(df: DataFrame, key: str, group: str, weight: str) -> DataFrame:
    """(key, group1, weight1, group2, weight2): the two groups of greatest weight of each key, ties to the smaller group."""
    sums = df.groupBy(key, group).agg(F.sum(weight).alias("_w"))
    ranked = sums.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_w"), group))).filter("_r <= 2")
    pick = lambda c, r: F.max(F.when(F.col("_r") == r, F.col(c)))
    return ranked.groupBy(key).agg(pick(group, 1).alias("group1"), pick("_w", 1).alias("weight1"), pick(group, 2).alias("group2"), pick("_w", 2).alias("weight2"))


def k_largest(df: DataFrame, key: str, index: str, value: str, k: int) -> DataFrame:
    """(key, rank, index, value): the k greatest values of each key; of equal ones the higher index comes first."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(value), F.desc(index)))
    return df.select(key, rank.alias("rank"), index, value).filter(F.col("rank") <= k)


def argmax_last(df: DataFrame, index: str, value: str) -> DataFrame:
    """(index): that of the greatest value; of equal ones the last."""
    return df.agg(F.max_by(index, F.struct(value, index)).alias(index))


def quantile_rows(df: DataFrame, score: str, shares: list[float]) -> DataFrame:
    """The rows at the given shares of the table sorted by score (halves to even), with share."""
    from beadloom.operators.reads import numbered

    wanted = F.explode(F.array(*map(F.lit, shares))).alias("share")
    places = df.agg(F.count("*").alias("_n")).select("_n", wanted).select("share", F.bround(F.col("share") * F.col("_n"), 0).cast("bigint").alias("_r"))
    return numbered(df, [score, *(c for c in df.columns if c != score)], "_r").join(F.broadcast(places), "_r").drop("_r")  # a row for each share


def binned(df: DataFrame, x: str, y: str, width: float, weight: Column | None = None) -> DataFrame:
    return df.groupBy(F.floor(F.col(x) / width).alias("bx"), F.floor(F.col(y) / width).alias("by")).agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))


def fraction(df: DataFrame, key: str, condition: Column, weight: Column | None = None) -> DataFrame:
    """(key, fraction): share of rows, or of weight, that meets the condition; null for a weight of 0."""
    w = F.lit(1) if weight is None else weight
    return df.groupBy(key).agg(F.try_divide(F.sum(F.when(condition, w).otherwise(0)), F.sum(w)).alias("fraction"))


def placed_share(df: DataFrame, cluster: str, placed: str) -> DataFrame:
    """(cluster, pct): per cent of each cluster's rows that are placed."""
    return df.groupBy(cluster).agg((F.avg(F.coalesce(F.col(placed), F.lit(False)).cast("int")) * 100).alias("pct"))


def contamination(raw: DataFrame, clean: DataFrame, key: str, n: str = "n") -> DataFrame:
    """(key, fraction) = (raw - clean) / raw, for keys that both tables have."""
    a, b = raw.groupBy(key).agg(F.sum(n).alias("_a")), clean.groupBy(key).agg(F.sum(n).alias("_b"))
    return a.join(b, key).select(key, F.try_divide(F.col("_a") - F.col("_b"), F.col("_a")).alias("fraction"))


def zero_filled(df: DataFrame, group: str, groups: int) -> DataFrame:
    """(group, n): rows of each group 1 ... groups, 0 where none."""
    all_ = df.sparkSession.range(1, groups + 1).select(F.col("id").alias(group))
    counts = df.groupBy(F.col(group).cast("bigint").alias(group)).agg(F.count("*").alias("n"))
    return all_.join(counts, group, "left").select(group, F.coalesce("n", F.lit(0)).alias("n"))


def running_funnel(df: DataFrame, order: str, value: str) -> DataFrame:
    """df with left: what remains of the total after taking away value row by row, as a share. A small table."""
    w = Window.orderBy(order)
    total = F.sum(value).over(Window.partitionBy())
    return df.withColumn("left", 1 - F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) / total)
