"""Sparse products, neighbour graphs and graph filters on edge tables (src, dst, ...)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.functions.text import clip01

#: Vectors of a shard of a product, vectors that are asked of it at a time, and entries of a matrix at most.
SHARD_ROWS, QUERY_ROWS, DENSE = 32_768, 1024, 1 << 24
#: Nodes whose degree is broadcast, and pairs that may close triangles up to which these are.
HEAVY, CLOSING = 1 << 17, 1 << 20


def set_checkpoints(spark: SparkSession) -> None:
    """Takes the folder that spark.checkpoint.dir names.

    Where none is set, a local session makes a temporary one; on a cluster, whose machines wouldn't share it, that is
    an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        root = sc.getConf().get("spark.checkpoint.dir")
        if not root and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        sc.setCheckpointDir(root or "file://" + tempfile.mkdtemp(prefix="beadloom-"))


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a checkpoint in the shared folder."""
    set_checkpoints(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df written as a table among the checkpoints: smaller than cut(), and Spark knows its size when it plans joins."""
    spark = df.sparkSession
    set_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def log_normalised(df: DataFrame, row: str, column: str, n: str) -> DataFrame:
    """(row, column, w): log1p of counts, every row scaled to length 1; zeros are left out."""
    w = F.log1p(F.col(n).cast("double"))
    out = df.filter(F.col(n) != 0).select(row, column, w.alias("_w"))
    return out.select(row, column, (F.col("_w") / F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(row)))).alias("w"))


def product_top(df: DataFrame, row: str, column: str, w: str, top: int, shard_rows: int | None = None) -> DataFrame:
    """(src, dst, sim): for each row the `top` rows, itself included, of greatest inner product over shared columns.

    Ties (sims equal to nine places) go to the smaller dst. Rows without a shared column never meet. A row becomes one
    vector; vectors are dealt by hash into shards of about shard_rows, each of which one task holds by column, and all
    vectors stream past every shard in blocks. Only a block's best leave the task, so what is shuffled grows with rows
    times shards, not with pairs.
    """
    vectors = df.groupBy(F.col(row).alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.xxhash64(column).alias("c"), F.col(w).cast("double").alias("w")))).alias("v"))
    vectors = cut(vectors.select("id", F.col("v.c").alias("c"), F.col("v.w").alias("w")))
    n = max(1, vectors.count())
    shards = -(-n // shard_rows) if shard_rows else max(-(-n // SHARD_ROWS), min(16, -(-n // 256)))
    held = vectors.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "id", "c", "w")
    asked = vectors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", "c", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, waiting, block = None, [], None
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            cuts = (np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1).tolist()
            for at, end in zip([0, *cuts], [*cuts, len(shard)], strict=True):
                for start in range(at, end, QUERY_ROWS):
                    own = batch.slice(start, min(end, start + QUERY_ROWS) - start)
                    if shard[start] != present:
                        present, waiting, block = shard[start], [], None
                    if not kind[start]:
                        waiting.append(own)
                        continue
                    if waiting:
                        block, waiting = Block(waiting), []
                    if block is not None:
                        yield block.best(own, top)

    schema = f"src {vectors.schema['id'].dataType.simpleString()}, dst {vectors.schema['id'].dataType.simpleString()}, sim double"
    best = held.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind").mapInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc(F.round("sim", 9)), "dst"))
    return best.withColumn("_r", rank).filter(F.col("_r") <= top).drop("_r")


class Block:
    """Vectors by column: for sparse ones lists of (vector, weight), for nearly full ones a matrix."""

    def __init__(self, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks().sort_by("id")  # so that of equal sims the smaller id comes first
        self.ids = table.column("id").combine_chunks()
        size, column, weight = _flat(table)
        self.rows = len(size)
        self.columns, number = np.unique(column, return_inverse=True)
        owner = np.repeat(np.arange(self.rows), size)
        self.dense = None
        if len(column) * 8 >= self.rows * len(self.columns) and self.rows * len(self.columns) <= DENSE:
            self.dense, self.has = (np.zeros((len(self.columns), self.rows)) for _ in range(2))
            np.add.at(self.dense, (number, owner), weight)
            self.has[number, owner] = 1
            return
        by = np.argsort(number, kind="stable")
        self.owner, self.weight = owner[by], weight[by]
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(self.columns)))])

    def _products(self, size: np.ndarray, column: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(vectors with a shared column, sims) for each asked vector."""
        at = np.minimum(np.searchsorted(self.columns, column), max(0, len(self.columns) - 1))
        known = self.columns[at] == column
        asker = np.repeat(np.arange(len(size)), size)[known]
        at, weight = at[known], weight[known]
        if self.dense is not None:
            asked, mark = (np.zeros((len(size), len(self.columns))) for _ in range(2))
            np.add.at(asked, (asker, at), weight)
            mark[asker, at] = 1
            sims, meet = asked @ self.dense, mark @ self.has
            for k in range(len(size)):
                hit = np.flatnonzero(meet[k])
                yield hit, sims[k, hit]
            return
        cuts = np.searchsorted(asker, np.arange(len(size) + 1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            n = self.begin[at[a:b] + 1] - self.begin[at[a:b]]
            place = np.repeat(self.begin[at[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found, inverse = np.unique(self.owner[place], return_inverse=True)
            yield found, np.bincount(inverse, self.weight[place] * np.repeat(weight[a:b], n), len(found))

    def best(self, asked: pa.RecordBatch, top: int) -> pa.RecordBatch:
        picked, sims, counts = [], [], []
        for hit, sim in self._products(*_flat(asked)):
            order = np.lexsort((hit, -np.round(sim, 9)))[:top]
            picked.append(hit[order])
            sims.append(sim[order])
            counts.append(len(order))
        src = asked.column("id").take(pa.array(np.repeat(np.arange(len(counts)), counts), pa.int64()))
        dst = self.ids.take(pa.array(np.concatenate([*picked, np.empty(0, np.int64)]).astype(np.int64)))
        return pa.RecordBatch.from_arrays([src, dst, pa.array(np.concatenate([*sims, np.empty(0)]))], names=["src", "dst", "sim"])


def _flat(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, columns, weights) of the vectors (c, w) of a table."""
    c, w = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (table.column("c"), table.column("w")))
    return pc.list_value_length(c).to_numpy(zero_copy_only=False).astype(np.int64), c.flatten().to_numpy(), w.flatten().to_numpy()


def to_distances(sims: DataFrame) -> DataFrame:
    """(src, dst, dist): 1 - sim held within 0 ... 1; loops and pairs at distance 0 are gone."""
    return sims.select("src", "dst", clip01(1 - F.round("sim", 9)).alias("dist")).filter("src <> dst AND dist > 0")


def nearest(edges: DataFrame, k: int, dist: str = "dist") -> DataFrame:
    """The k edges of least distance of each src, ties to the smaller dst, with rank."""
    rank = F.row_number().over(Window.partitionBy("src").orderBy(dist, "dst"))
    return edges.withColumn("rank", rank).filter(F.col("rank") <= k)


def symmetric(edges: DataFrame, value: str) -> DataFrame:
    """Both directions of each edge with the greater value."""
    both = edges.select("src", "dst", value).unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), value))
    return both.groupBy("src", "dst").agg(F.max(value).alias(value))


def undirected(edges: DataFrame, dist: str = "dist") -> DataFrame:
    """(src, dst, w): src < dst, w = 1 - dist, the greatest of several edges; no loops."""
    pairs = edges.filter("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), (1 - F.col(dist)).alias("w"))
    return pairs.groupBy("src", "dst").agg(F.max("w").alias("w"))


def masked(edges: DataFrame, nodes: DataFrame, node: str = "id") -> DataFrame:
    """Edges both of whose ends are nodes."""
    keep = nodes.select(F.col(node).alias("_n")).distinct()
    return edges.join(keep, F.col("src") == F.col("_n"), "left_semi").join(keep, F.col("dst") == F.col("_n"), "left_semi")


def peeled(edges: DataFrame, least: int, history: list[tuple[str, int]] | None = None) -> DataFrame:
    """Edges left when nodes with fewer than `least` out-edges go, again and again until none does.

    history, if given, gets ("too few neighbours", source nodes gone) for each round that changed something.
    """
    now, before = cut(edges), None
    while (n := now.count()) != before:
        before = n
        out = now.groupBy("src").count()
        if history is not None and (gone := out.filter(F.col("count") < least).count()):
            history.append(("too few neighbours", gone))
        now = cut(masked(now, out.filter(F.col("count") >= least), "src"))
    return now


def clustered(edges: DataFrame, least: float = 0.2) -> DataFrame:
    """Edges between nodes whose weighted clustering (see node_metrics()) is at least `least`."""
    return masked(edges, node_metrics(undirected(edges)).filter(F.col("weighted") >= least))


def cluster_neighbours(edges: DataFrame, membership: DataFrame, k: int = 15) -> DataFrame:
    """(src, dst, dist, rank): for each group of membership (id, group) the k nearest groups by their edges to others.

    edges (src, dst, w) are contracted, every group's weights scaled to length 1, and groups compared by inner product;
    dist is 1 less that, held within 0 ... 1, and pairs at 0 are none. Groups with fewer neighbours have fewer rows.
    """
    between = contracted(edges, membership)
    unit = between.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("src"))))
    return nearest(to_distances(product_top(unit, "src", "dst", "w", k + 1)), k)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest node that each node of the edges reaches in either direction.

    Every round a node takes the least label around it and then that label's own label, so labels travel twice as far
    each time; rounds end when no label changes. Each is checkpointed.
    """
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("_m")).select("id", F.least("id", "_m").alias("component")))
    while True:
        around = both.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("component").alias("_a"))
        near = labels.join(around, "id").select("id", F.least("component", "_a").alias("_a"), F.col("component").alias("_was"))
        jump = labels.select(F.col("id").alias("_a"), F.col("component").alias("_b"))
        new = cut(near.join(jump, "_a", "left").select("id", F.least("_a", "_b").alias("component"), "_was"))
        if not new.filter("component <> _was").limit(1).count():
            return new.select("id", "component")
        labels = new.select("id", "component")


def largest_component(edges: DataFrame) -> DataFrame:
    """Edges within the component of most nodes, ties to the one of the smallest node."""
    found = components(edges)
    best = found.groupBy("component").agg(F.count("*").alias("_n")).agg(F.max_by("component", F.struct("_n", -F.col("component"))).alias("component"))
    return masked(edges, found.join(best, "component"))


def node_metrics(pairs: DataFrame) -> DataFrame:
    """(id, degree, strength, triangles, clustering, weighted, nearest, furthest) of undirected pairs (src < dst, w).

    clustering: share of a node's pairs of neighbours that are linked, 0 for fewer than two. weighted: the same with
    each pair counting as the mean weight of the node's two edges to it, over strength * (degree - 1) / 2. nearest and
    furthest are distances, 1 - w.
    """
    both = pairs.select(F.col("src").alias("id"), F.col("dst").alias("other"), "w").unionByName(pairs.select(F.col("dst").alias("id"), F.col("src").alias("other"), "w"))
    base = both.groupBy("id").agg(F.count("*").alias("degree"), F.sum("w").alias("strength"), (1 - F.max("w")).alias("nearest"), (1 - F.min("w")).alias("furthest"))
    # each triangle once: wedges start at the end of lower (degree, id), so a hub opens few
    rank = base.select("id", F.struct("degree", "id").alias("r"))
    e = pairs.join(rank.select(F.col("id").alias("src"), F.col("r").alias("_rs")), "src").join(rank.select(F.col("id").alias("dst"), F.col("r").alias("_rd")), "dst")
    up = e.select(F.when(F.col("_rs") < F.col("_rd"), F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(F.col("_rs") < F.col("_rd"), F.col("dst")).otherwise(F.col("src")).alias("b"), F.col("w").alias("ab"))
    wedge = up.join(up.select("a", F.col("b").alias("c"), F.col("ab").alias("ac")), "a").filter("b < c")
    tri = wedge.join(pairs.select(F.col("src").alias("b"), F.col("dst").alias("c"), F.col("w").alias("bc")), ["b", "c"])
    corners = F.array(*(F.struct(F.col(i).alias("id"), (F.col(x) + F.col(y)).alias("w")) for i, x, y in (("a", "ab", "ac"), ("b", "ab", "bc"), ("c", "ac", "bc"))))
    counts = tri.select(F.explode(corners).alias("t")).groupBy("t.id").agg(F.count("*").alias("triangles"), F.sum("t.w").alias("_w"))
    out = base.join(counts, "id", "left").withColumn("triangles", F.coalesce("triangles", F.lit(0)))
    out = out.withColumn("clustering", F.coalesce(F.try_divide(2 * F.col("triangles"), F.col("degree") * (F.col("degree") - 1)), F.lit(0.0)))
    return out.withColumn("weighted", F.coalesce(F.try_divide(F.col("_w"), F.col("strength") * (F.col("degree") - 1)), F.lit(0.0))).drop("_w")


def constraint(pairs: DataFrame) -> DataFrame:
    """(id, constraint): Burt's constraint, the sum over neighbours j of (p_ij + sum over q of p_iq p_qj)^2.

    Of undirected pairs (src < dst, w). A path i, q, j counts only where i and j are linked, so triangles are all that's
    needed: each is found once, from the end that comes first by (degree, id), and adds t = w_iq w_qj / strength_q to
    its three edges. Then strength_i^2 * constraint_i is the sum of (w_ij + t_ij)^2, of which w_ij^2 is summed
    beforehand. Degrees count for the HEAVY greatest only, the rest are ordered by id: that leaves the order total, and
    any order gives the same triangles. Null where a node's weights sum to 0.
    """
    p = written(pairs.select("src", "dst", "w"))
    ends = p.select(F.explode(F.array(F.struct(F.col("src").alias("id"), "w"), F.struct(F.col("dst").alias("id"), "w"))).alias("e")).select("e.id", "e.w")
    base = written(ends.groupBy("id").agg(F.count("*").alias("degree"), F.sum("w").alias("strength"), F.sum(F.col("w") * F.col("w")).alias("squares")))
    # a row a distinct degree, of which there are fewer than twice the root of the number of edges
    least, nodes = 0, 0
    for degree, n in sorted((tuple(r) for r in base.groupBy("degree").count().collect()), reverse=True):
        nodes += n
        if nodes > HEAVY:
            least = degree
            break
    heavy = base.filter(F.col("degree") > least)
    rank = lambda end: F.struct(F.coalesce(f"_{end}", F.lit(0)), end)
    up = p
    for end in ("src", "dst"):
        up = up.join(F.broadcast(heavy.select(F.col("id").alias(end), F.col("degree").alias(f"_{end}"))), end, "left")  # HEAVY rows at most
    low = rank("src") < rank("dst")
    up = up.select(F.when(low, F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(low, F.col("dst")).otherwise(F.col("src")).alias("b"), F.col("w").alias("ab"))
    # a pair can close a triangle only if its lower end is the upper end of another
    upper = written(up.select(F.col("b").alias("a")).distinct())
    closing = up.join(upper, "a", "left_semi").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("c"), F.col("ab").alias("bc"))
    for end in "bc":
        closing = closing.join(base.select(F.col("id").alias(end), F.col("strength").alias(f"s{end}")), end)
    closing = written(closing)
    if closing.count() <= CLOSING:
        closing = F.broadcast(closing)
    wedge = up.join(up.select("a", F.col("b").alias("c"), F.col("ab").alias("ac")), "a").filter("b < c").join(base.select(F.col("id").alias("a"), F.col("strength").alias("sa")), "a")
    edge = lambda x, y, w, v1, v2, s: F.struct(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"), F.col(w).alias("w"), F.try_divide(F.col(v1) * F.col(v2), F.col(s)).alias("t"))
    tri = wedge.join(closing, ["b", "c"]).select(F.explode(F.array(edge("a", "b", "ab", "ac", "bc", "sc"), edge("a", "c", "ac", "ab", "bc", "sb"), edge("b", "c", "bc", "ab", "ac", "sa"))).alias("e"))
    more = tri.groupBy("e.x", "e.y").agg(F.max("e.w").alias("w"), F.sum("e.t").alias("t")).select(F.explode(F.array("x", "y")).alias("id"), ((2 * F.col("w") + F.col("t")) * F.col("t")).alias("more"))
    out = base.join(more.groupBy("id").agg(F.sum("more").alias("more")), "id", "left")
    return out.select("id", F.try_divide(F.col("squares") + F.coalesce("more", F.lit(0.0)), F.col("strength") * F.col("strength")).alias("constraint"))


def contracted(edges: DataFrame, membership: DataFrame, w: str = "w") -> DataFrame:
    """(src, dst, w): edges between the groups of membership (id, group), weights summed both ways, no loops."""
    m = membership.select("id", "group")
    e = edges.join(m.select(F.col("id").alias("src"), F.col("group").alias("_a")), "src").join(m.select(F.col("id").alias("dst"), F.col("group").alias("_b")), "dst").filter("_a <> _b")
    both = e.select(F.col("_a").alias("src"), F.col("_b").alias("dst"), w).unionByName(e.select(F.col("_b").alias("src"), F.col("_a").alias("dst"), w))
    return both.groupBy("src", "dst").agg(F.sum(w).alias(w))


def averaged(edges: DataFrame, coords: DataFrame, rounds: int = 3) -> DataFrame:
    """(id, x, y) after so many rounds in which each node takes the mean of its out-neighbours, weighted by 1 - dist.

    Nodes without out-neighbours keep their place.
    """
    now = coords.select("id", "x", "y")
    for _ in range(rounds):
        e = edges.join(now.select(F.col("id").alias("dst"), "x", "y"), "dst").withColumn("_w", 1 - F.col("dist"))
        mean = e.groupBy(F.col("src").alias("id")).agg(*(F.try_divide(F.sum(F.col("_w") * F.col(c)), F.sum("_w")).alias(f"_{c}") for c in "xy"))
        now = cut(now.join(mean, "id", "left").select("id", *(F.coalesce(f"_{c}", c).alias(c) for c in "xy")))
    return now


def communities(pairs: DataFrame, rounds: int = 10) -> DataFrame:
    """(id, group) by weighted label propagation, a stand-in for modularity clustering. Experimental.

    Every round, nodes of alternating halves take the label of greatest weight around them, ties to the smaller label.
    """
    both = cut(pairs.select("src", "dst", "w").unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))
    now = cut(both.select(F.col("src").alias("id")).distinct().withColumn("group", F.col("id")))
    for r in range(rounds):
        votes = both.join(now.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id"), "group").agg(F.sum("w").alias("_w"))
        best = votes.groupBy("id").agg(F.max_by("group", F.struct(F.round("_w", 9), -F.col("group"))).alias("_g"))
        turn = F.pmod(F.xxhash64("id"), F.lit(2)) == r % 2
        now = cut(now.join(best, "id", "left").select("id", F.when(turn, F.coalesce("_g", "group")).otherwise(F.col("group")).alias("group")))
    return now


def layout(edges: DataFrame, rounds: int = 15) -> DataFrame:
    """(id, x, y): two smooth coordinates by orthogonal power iteration of neighbour averaging. Experimental.

    A deterministic stand-in for stochastic embeddings: starts from hashes of ids; each round averages over both ends of
    edges (weight 1 - dist), centres, makes y orthogonal to x and scales both.
    """
    sym = cut(symmetric(edges.withColumn("w", 1 - F.col("dist")), "w"))
    start = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1_000_003)) / 1_000_003.0
    now = cut(sym.select(F.col("src").alias("id")).distinct().withColumns({"x": start(1), "y": start(2)}))
    for _ in range(rounds):
        near = sym.join(now.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(*((F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"_{c}") for c in "xy"))
        new = now.join(near, "id").select("id", *((F.col(c) + F.col(f"_{c}")).alias(c) for c in "xy"))
        m = new.agg(F.avg("x"), F.avg("y"), F.var_pop("x"), F.covar_pop("x", "y"), F.var_pop("y")).first()
        slope = m[3] / m[2] if m[2] else 0.0
        sx, sy = max(m[2], 1e-30) ** 0.5, max(m[4] - slope * m[3], 1e-30) ** 0.5
        x = F.col("x") - m[0]
        now = cut(new.select("id", (x / sx).alias("x"), ((F.col("y") - m[1] - slope * x) / sy).alias("y")))
    return now


def scaled(coords: DataFrame, diameter: float) -> DataFrame:
    """Coordinates centred on their mean and scaled so that the mean of both extents is the diameter."""
    stats = coords.agg(F.avg("x").alias("_mx"), F.avg("y").alias("_my"), ((F.max("x") - F.min("x") + F.max("y") - F.min("y")) / 2).alias("_d"))
    factor = F.try_divide(F.lit(float(diameter)), F.col("_d"))
    out = coords.join(F.broadcast(stats))  # one row
    return out.withColumns({"x": (F.col("x") - F.col("_mx")) * factor, "y": (F.col("y") - F.col("_my")) * factor}).drop("_mx", "_my", "_d")


def displacement(a: DataFrame, b: DataFrame) -> DataFrame:
    """(l2, procrustes): mean distance of the same nodes in two layouts, and what remains after the best similarity."""
    j = a.select("id", F.col("x").alias("ax"), F.col("y").alias("ay")).join(b.select("id", F.col("x").alias("bx"), F.col("y").alias("by")), "id")
    s = j.agg(F.avg(F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))).alias("l2"), *(F.covar_pop(p, q).alias(p + q) for p in ("ax", "ay") for q in ("bx", "by")), *(F.var_pop(c).alias(c) for c in ("ax", "ay", "bx", "by")))
    # singular values of the 2 x 2 cross-covariance: their sum is sqrt(|C|^2 + 2 |det C|)
    fro = sum(F.col(p + q) * F.col(p + q) for p in ("ax", "ay") for q in ("bx", "by"))
    det = F.abs(F.col("axbx") * F.col("ayby") - F.col("axby") * F.col("aybx"))
    return s.select("l2", (1 - F.try_divide(fro + 2 * det, (F.col("ax") + F.col("ay")) * (F.col("bx") + F.col("by")))).alias("procrustes"))
