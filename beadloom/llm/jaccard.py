"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two documents link when the Jaccard similarity of their sets of word n-grams reaches a threshold. The search for
partners runs in three steps, all exact:

1. Equal sets are one node, named after the smallest id.
2. Every set is ordered by hash and a prefix of it looked at. The prefixes of linked sets share a known number of
   n-grams (see `prefix_size` and `must_share`), so sets whose prefix has fewer in common with others are done. The
   rest leave out their most frequent n-grams, as many as they may, and sets with an n-gram in common come into one
   bucket. All links lie inside buckets.
3. Each bucket is one inverted index. A set's required overlap T decides how many of its longest lists are skipped; the
   short ones are merged, and sets that occur often enough there are probed in the long ones by binary search. Merging
   counts occurrences in an array over the bucket's sets, which gives what a heap over the lists would and costs numpy
   one step a posting. Sets that are connected already aren't compared again, so a group of near copies costs about one
   comparison a member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.llm import words
from beadloom.llm.common import in_all_pieces, in_piece, pieces, read, slices, stash, tidy
from beadloom.llm.graph import components

#: n-grams that the sets of one task may hold together; larger buckets are searched in pairs of blocks.
BUCKET_TOKENS = 3_000_000
#: More nodes than this are joined to their texts by a shuffle instead of a broadcast (16 bytes a node).
MAX_BROADCAST_NODES = 1_000_000
#: Percentage points of a set that its prefix has beyond what the threshold lets linked sets differ by.
SLACK = 10
#: Binary searches that are made at a time.
PROBES = 1 << 18
#: Cost of a probe against a merge step in choosing how many long lists to skip.
MU = 0.0085

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's n-word shingles.

    Words are runs of bytes other than 9-13 and 32, A-Z lower-cased. A text of fewer words has its whole sequence as
    the only shingle, one without words none.
    """
    data, begin = words.joined(texts)
    data = _LOWER[data]
    starts, ends = words.space_runs(data)
    h = words.hashes(data, starts, ends)
    cut = np.searchsorted(starts, begin)
    rolled = np.zeros(max(0, len(h) - n + 1), np.uint64)
    factor = 1
    for k in range(n):
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64) | 1
        rolled += h[k : k + len(rolled)] * np.uint64(factor)
    rolled = words.mix(rolled)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = words.mix((short ^ h[k : k + 1]) * np.uint64(0xD6E8FEB86659FD93))
            out.append(short)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def prefix_size(n: int, percent: int) -> int:
    return min(n, -(-n * (100 - percent + SLACK) // 100))


def must_share(n: int) -> int:
    """How many n-grams, at least, the prefixes of two linked sets share, the smaller having n.

    Let m be the larger size. The overlap is at least percent/100 * m. All but the last of the common n-grams, in the one
    order of all sets, are in both prefixes: a rest holds at most (percent - SLACK)/100 * m of them. So both prefixes
    share at least SLACK/100 * m, and at least one.
    """
    return max(1, -(-n * SLACK // 100))


def linked(overlap: int, n: int, m: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n + m - overlap)


class Search:
    """T-occurrence search over the sets of one bucket, in order of size."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, token = np.unique(flat, return_inverse=True)
        by = np.argsort(token, kind="stable")
        self.lists = owner[by]  # inverted lists, one after another, each sorted by set
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(token))])
        self.cut = np.concatenate([[0], np.cumsum(self.sizes)])
        self.token = token
        self.width = int(token.max(initial=0)) + 1
        self.places = owner * self.width + token  # sorted, so a binary search tells whether a set holds an n-gram

    def _merged(self, tokens: np.ndarray, low: int, high: int) -> np.ndarray:
        """How often each set of low .. high - 1 occurs on the lists of tokens."""
        sizes = self.begin[tokens + 1] - self.begin[tokens]
        at = np.repeat(self.begin[tokens] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        found = self.lists[at]
        return np.bincount(found[(found >= low) & (found < high)] - low, minlength=high - low)

    def partners(self, q: int, low: int, high: int, skip) -> Iterator[int]:
        """Linked sets among low .. high - 1, which are not larger than q; skip(array) says which need no comparison."""
        n = int(self.sizes[q])
        low = low + int(np.searchsorted(self.sizes[low:high], -(-n * self.percent // 100)))
        if low >= high or not n:
            return
        tokens = self.token[self.cut[q] : self.cut[q + 1]]
        length = self.begin[tokens + 1] - self.begin[tokens]
        tokens = tokens[np.argsort(length, kind="stable")]
        least = -(-self.percent * (n + int(self.sizes[low])) // (100 + self.percent))  # T for the smallest partner
        long = min(least - 1, int(least / (MU * math.log2(int(length.max()) + 1) + 1)))
        count = self._merged(tokens[: n - long], low, high)
        near = np.flatnonzero(count >= least - long) + low
        near = near[~skip(near)]
        probe = np.sort(tokens[n - long :])
        for k in range(0, len(near), step := max(1, PROBES // max(1, long))):
            some = near[k : k + step]
            asked = (some[:, None] * self.width + probe).ravel()
            found = self.places[np.minimum(np.searchsorted(self.places, asked), len(self.places) - 1)] == asked
            total = count[some - low] + found.reshape(len(some), long).sum(axis=1)
            for c in some[100 * total >= self.percent * (n + self.sizes[some] - total)].tolist():
                if not skip(np.array([c]))[0]:
                    yield c


def bucket_roots(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """The smallest id that each set reaches by links within the bucket.

    side: 0 and 1 for two blocks of which only pairs across count (a block with itself has side 2). Sets with equal ids
    are one document.
    """
    order = np.lexsort((ids, [len(s) for s in sets]))
    ids, sets, side = ids[order], [sets[k] for k in order], side[order]
    label = np.arange(len(sets))

    def join(a: int, b: int) -> None:
        x, y = label[a], label[b]
        if x != y:
            label[label == max(x, y)] = min(x, y)

    _, first, inverse = np.unique(ids, return_index=True, return_inverse=True)
    for k in np.flatnonzero(first[inverse] != np.arange(len(ids))).tolist():
        join(int(first[inverse[k]]), k)
    search = Search(sets, percent)
    for q in range(1, len(sets)):
        for c in search.partners(q, 0, q, lambda at, q=q: (label[at] == label[q]) | ((side[at] == side[q]) & (side[q] < 2))):
            join(q, c)
    root = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(root, label, ids)
    out = np.empty(len(sets), np.int64)
    out[order] = root[label]
    return out


def _tokens_of(df: DataFrame, n: int, extra: list[str]) -> DataFrame:
    """extra columns and tokens (the set's hashes as little-endian bytes) of df (id, text, extra)."""
    fields = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in extra), pa.array([s.tobytes() for s in sets], pa.binary())], names=[*extra, "tokens"])

    return df.mapInArrow(tidy(run), f"{fields}, tokens binary")


def _profiles(df: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, n, d1, d2, prefix): set size, a 128-bit digest of the set, and its first hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], n)
            size = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            total = [np.concatenate([[np.uint64(0)], np.cumsum(words.mix(flat ^ np.uint64(k)))]) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            end = np.cumsum(size)
            d1, d2 = ((t[end] - t[end - size]).view(np.int64) for t in total)
            prefix = pa.array([s[: prefix_size(len(s), percent)].view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(d1), pa.array(d2), prefix], names=["id", "n", "d1", "d2", "prefix"])

    return df.mapInArrow(tidy(run), "id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>")


def _run_buckets(df: DataFrame, percent: int) -> DataFrame:
    """(id, root) of df (bucket, side, id, tokens), of which all rows of a bucket come one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, ids, sides, sets = None, [], [], []

        def done() -> pa.RecordBatch:
            roots = bucket_roots(np.array(ids, np.int64), sets, np.array(sides), percent)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(roots)], names=["id", "root"])

        for batch in batches:
            for b, side, i, t in zip(*(batch.column(c).to_pylist() for c in ("bucket", "side", "id", "tokens")), strict=True):
                if b != bucket:
                    if len(ids) > 1:
                        yield done()
                    bucket, ids, sides, sets = b, [], [], []
                ids.append(i)
                sides.append(side)
                sets.append(np.frombuffer(t, np.uint64))
        if len(ids) > 1:
            yield done()

    return df.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(run), "id bigint, root bigint")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(id, bucket) of the nodes (id, n, prefix) that may have a partner; linked ones are in one bucket."""
    grams = nodes.select("id", "n", F.explode("prefix").alias("g"))
    often = grams.groupBy("g").agg(F.count("*").alias("df")).filter("df > 1")
    shared = grams.join(often, "g")
    may_drop = F.greatest(F.lit(1), F.ceil(F.col("n") * SLACK / 100)) - 1
    kept = shared.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("s")).filter(F.size("s") > may_drop)
    kept = kept.select("id", F.explode(F.slice("s", 1, (F.size("s") - may_drop).cast("int"))).alias("s")).select("id", F.col("s.g").alias("g"))
    kept = stash(kept, "grams")
    least = kept.groupBy("g").agg(F.min("id").alias("v"), F.max("id").alias("w")).filter("v <> w").select("g", "v")
    edges = kept.join(least, "g").filter("id <> v").select(F.col("id").alias("u"), "v")
    return components(edges).withColumnRenamed("root", "bucket")


def link(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text", bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(id, n_shingles, component_id) for each row of df: the smallest id that its document reaches by links.

    Documents link when 100 * intersection >= percent * union of their n-word shingle sets. A null or blank text has an
    empty set and links with nothing. Rows with a null id get a null component and link with nothing; rows that share
    an id are one document. Other columns are ignored; an empty df gives an empty result.

    bucket_tokens bounds the n-grams that a task holds. A bucket beyond it is split by set size (linked sets differ by
    the threshold's factor at most) and then into blocks, all pairs of which are searched: exact, with more work.
    """
    if not SLACK < percent <= 100:
        raise ValueError(f"a threshold above {SLACK} % is needed")
    df = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = stash(_profiles(df, n, percent).withColumn("key", F.xxhash64("n", "d1", "d2")), "profiles")
    reps = stash(rows.filter("n > 0 AND id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumn("key", F.xxhash64("n", "d1", "d2")), "sets")
    roots = _roots(df, rows, reps, n, percent, bucket_tokens)
    named = reps.join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").select("n", "d1", "d2", "key", F.coalesce("root", "rep").alias("root"))
    hot = pieces(reps.groupBy("key").agg(F.sum("copies").alias("n")), "key")  # large groups of copies
    found = in_piece(rows.select("id", "n", "d1", "d2", "key"), "key", hot, F.xxhash64("id")).join(in_all_pieces(named, "key", hot), ["n", "d1", "d2", "key", "p"], "left")
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))


def _roots(df: DataFrame, rows: DataFrame, reps: DataFrame, n: int, percent: int, bucket_tokens: int) -> DataFrame:
    """(id, root) of the sets of reps that have a link: the smallest id that each reaches."""
    if percent == 100:  # only equal sets link, and each is one row of reps
        return reps.select(F.col("rep").alias("id"), F.col("rep").alias("root")).limit(0)
    nodes = rows.select("id", "n", "prefix").join(reps.select(F.col("rep").alias("id"), "n"), ["id", "n"], "left_semi")
    found = stash(_buckets(nodes).join(rows.groupBy("id").agg(F.max("n").alias("n")), "id"), "buckets")
    sizes = found.groupBy("bucket").agg(F.sum("n").alias("tokens"), F.count("*").alias("n"))
    sizes = stash(sizes, "sizes")
    large = sizes.filter(F.col("tokens") > bucket_tokens).count()
    if large:
        hot = pieces(sizes.select("bucket", "n"), "bucket")
        flags = in_all_pieces(sizes.select("bucket", (F.col("tokens") > bucket_tokens).alias("large")), "bucket", hot)
        found = stash(in_piece(found, "bucket", hot, F.xxhash64("id")).join(flags, ["bucket", "p"]).select("id", "bucket", "large"), "buckets")
    else:
        found = found.select("id", "bucket", F.lit(False).alias("large"))
    where = found if (sizes.agg(F.sum("n")).first()[0] or 0) > MAX_BROADCAST_NODES else F.broadcast(found)  # 17 bytes a node
    sets = _tokens_of(df.join(where, "id"), n, ["id", "bucket", "large"])
    if not large:
        return _run_buckets(sets.select("bucket", F.lit(2).alias("side"), "id", "tokens"), percent).distinct()
    sets = stash(sets, "sets")
    small = _run_buckets(sets.filter("NOT large").select("bucket", F.lit(2).alias("side"), "id", "tokens"), percent).distinct()
    # those too large for a task: one length band and its neighbour at a time, in pairs of blocks
    size = F.length("tokens") / 8
    band = F.floor(F.log(size) / math.log(100 / percent))
    banded = sets.filter("large").withColumn("band", F.explode(F.array(band, band - 1)))
    parts = banded.groupBy("bucket", "band").agg(F.sum(F.length("tokens") / 8).alias("t")).select("bucket", "band", F.ceil(2 * F.col("t") / bucket_tokens).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    banded = banded.join(parts, ["bucket", "band"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    key = F.concat_ws("/", "bucket", "band", F.least("own", "other"), F.greatest("own", "other"))
    edges = _run_buckets(banded.select(key.alias("bucket"), side.alias("side"), "id", "tokens"), percent)
    return small.unionByName(components(edges.select(F.col("id").alias("u"), F.col("root").alias("v"))))


def one_of_each(df: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of df (doc_id, text, ...) whose document is the first of its group, each doc_id once.

    Rows with a null doc_id stay.
    """
    found = link(df, n, percent)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = df.join(gone, "doc_id", "left_anti")
    if found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        kept = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(kept.filter("doc_id IS NULL"))
    return kept


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents"), n=4, percent=85)


OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT p.x, p.y FROM p JOIN n a ON a.doc_id = p.x JOIN n b ON b.doc_id = p.y WHERE 100 * p.o >= 85 * (a.n + b.n - p.o)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.x, r.c FROM r JOIN e ON e.y = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
