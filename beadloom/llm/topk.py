"""Exact top-k by integer inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Candidates are dealt into shards once; a shard's lists are sorted once by the task that has it, and all queries stream
past them. A first round on a few candidates gives every query a score that its kth best reaches at least, so that in
the shards reading stops as soon as the bound for unseen candidates falls below that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.llm.common import read, stash

#: Candidates of a shard at most, about; fewer where the shards would be fewer than LEAST_SHARDS of SMALL_SHARD.
SHARD, SMALL_SHARD, LEAST_SHARDS = 1 << 17, 4096, 16
#: Candidates of the first round, about.
SEEDS = 2048
#: Depth of the first round of sorted access.
FIRST = 64
#: Scores beyond these ends of a long count as the end.
LOW, HIGH = 1 - (1 << 63), (1 << 63) - 1
#: Queries of a task in the first round, about.
BLOCK = 4096


def scaled(vector: str, scale: int = 256) -> Column:
    """scale * x of every component, as double; null for a vector that is null or empty or holds a null, NaN or infinity, or gets one."""
    big = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    fine = F.forall(big, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine & (F.size(vector) > 0), big)


def exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all inner products of rows of a and b, integers as float64, are exact in float64."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2.0**53


def as_python(vectors: np.ndarray) -> np.ndarray:
    """The same integers as Python's, which have no bounds."""
    return np.array([int(v) for v in vectors.ravel()], object).reshape(vectors.shape)


def held(value) -> int:
    """An integer held within LOW ... HIGH."""
    return min(max(int(value), LOW), HIGH)


class Lists:
    """Per-dimension lists of candidates sorted by component, for sorted and random access. Components are whole numbers."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by = np.argsort(ids, kind="stable")  # so that of equal scores the smaller id comes first
        self.ids, self.vectors = ids[by], vectors[by]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)

    def _scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        raw = self.vectors[at] @ query
        return np.array([held(x) for x in raw], np.int64) if raw.dtype == object else raw.astype(np.int64)

    def search(self, query_id: int, query: np.ndarray, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best candidates whose id isn't the query's; ties to the smaller id.

        A list is read from its high end where the query's weight is positive, else from its low end. Reading stops
        when the kth score is above the bound for unseen candidates, or all are seen. An equal bound reads on, as an
        unseen tie may have a smaller id. With least, a score that k candidates elsewhere reach, reading also stops when
        the bound is below it, and fewer may be found.
        """
        n, dims = self.vectors.shape
        use = np.flatnonzero(query != 0)
        up = query[use] > 0
        seen = np.zeros(n, bool)
        best, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        low, depth = 0, min(FIRST, n) if use.size else n
        while True:
            if use.size:
                rank = np.arange(low, depth)[:, None]
                mark = np.zeros(n, bool)
                mark[self.order[np.where(up, n - 1 - rank, rank), use].ravel()] = True
                new = np.flatnonzero(mark & ~seen)
                seen |= mark
            else:
                new, seen = np.arange(n), np.ones(n, bool)
            new = new[self.ids[new] != query_id]
            best = np.concatenate([best, new])
            scores = np.concatenate([scores, self._scores(new, query)])
            keep = np.lexsort((best, -scores))[:k]
            best, scores = best[keep], scores[keep]
            if depth >= n or seen.all():
                return best, scores
            last = self.order[np.where(up, n - depth, depth - 1), use]
            bound = held((self.vectors[last, use] * query[use]).sum())
            if (len(best) == k and scores[-1] > bound) or (least is not None and bound < least):
                return best, scores
            low, depth = depth, min(2 * depth, n)


def _searched(candidates: DataFrame, queries: DataFrame, k: int, parts: int, deal: str = "candidates") -> DataFrame:
    """(query_id, id, score): the k best of each part for queries (id, v, least) and candidates (id, v).

    Those that `deal` names are dealt by hash into the parts; the others go to every part. A part's candidates come
    before its queries in one sorted stream, of which a task holds the candidates of one length.
    """

    def sent(df: DataFrame, kind: str, number: int, least) -> DataFrame:
        part = F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int") if kind == deal else F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        return df.select(part.alias("part"), F.size("v").alias("d"), F.lit(number).alias("kind"), "id", "v", least.alias("least"))

    both = sent(candidates, "candidates", 0, F.lit(None).cast("bigint")).unionByName(sent(queries, "queries", 1, F.col("least")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, waiting, lists = None, [], None
        for batch in batches:
            part, dims, kind = (batch.column(c).to_numpy() for c in ("part", "d", "kind"))
            cuts = (np.flatnonzero((np.diff(part) != 0) | (np.diff(dims) != 0) | (np.diff(kind) != 0)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True):
                if a == b:
                    continue
                own = batch.slice(a, b - a)
                if (key := (part[a], dims[a])) != present:
                    present, waiting, lists = key, [], None
                ids, vectors = own.column("id").to_numpy(), np.floor(own.column("v").flatten().to_numpy()).reshape(b - a, int(dims[a]))
                if not kind[a]:
                    waiting.append((ids, vectors))
                    continue
                if waiting:
                    lists, waiting = Lists(np.concatenate([i for i, _ in waiting]), np.concatenate([v for _, v in waiting])), []
                if lists is None:  # no candidate of this length
                    continue
                if lists.vectors.dtype == object or not exact(vectors, lists.vectors):
                    vectors = as_python(vectors)
                    if lists.vectors.dtype != object:
                        lists.vectors = as_python(lists.vectors)
                found = [(query_id, *lists.search(query_id, query, k, least)) for query_id, query, least in zip(ids.tolist(), vectors, own.column("least").to_pylist(), strict=True)]
                out = [np.concatenate([np.full(len(at), q) for q, at, _ in found]), lists.ids[np.concatenate([at for _, at, _ in found])], np.concatenate([x for _, _, x in found])]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=["query_id", "id", "score"])

    return both.repartition(parts, "part").sortWithinPartitions("part", "d", "kind").mapInArrow(run, "query_id bigint, id bigint, score bigint")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256, shard_rows: int | None = None, seeds: int = SEEDS) -> DataFrame:
    """(query_id, rank, id, score): the k candidates of highest integer inner product for each query but itself.

    Components become floor(scale * x), x as double. Ties go to the smaller id. Vectors that are null, empty or hold
    null or non-finite components (or get one by the scale), and rows with a null id, take no part; only vectors of one
    length are compared. Inner products are exact integers; those beyond the range of a long count, and are returned, as
    its end, so among them the smaller id comes first. A query id that comes more than once is asked once, with its
    smallest vector; a candidate row that comes more than once counts each time. Fewer than k candidates give fewer
    rows, empty tables none. Other columns are ignored.

    Candidates are dealt by a hash of their rows into shards of about shard_rows (see SHARD), and every query goes to
    every shard; a task holds one shard. seeds: candidates of the first round.
    """

    def prepared(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("bigint").alias("id"), scaled(vector, scale).alias("v")).dropna()

    c = stash(prepared(candidates), "candidates")
    q = stash(prepared(queries).groupBy("id").agg(F.min("v").alias("v")), "queries")
    n = c.count()
    shards = -(-max(1, n) // shard_rows) if shard_rows else max(-(-max(1, n) // SHARD), min(LEAST_SHARDS, -(-max(1, n) // SMALL_SHARD)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    asked = q.withColumn("least", F.lit(None).cast("bigint"))
    if shards > 1 and seeds:
        few = c.filter(F.pmod(F.xxhash64("id", "v", F.lit(3)), F.lit(1 << 30)) < min(1.0, seeds / n) * (1 << 30))
        kth = _searched(few, asked, k, -(-max(1, q.count()) // BLOCK), "queries").groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
        asked = q.join(kth.select(F.col("query_id").alias("id"), "least"), "id", "left")
    near = _searched(c, asked, k, shards).withColumn("rank", rank).filter(F.col("rank") <= k)
    return near.select("query_id", "rank", F.col("id").alias(id_col), "score")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
