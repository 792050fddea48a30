"""Reads to counts: staged filters with counters, error-tolerant barcode joins, tie-aware chimera removal, counting."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beadloom.functions import dna

#: Bases of a cell read.
CELL_LENGTH = 28


def downsample(reads: DataFrame, p: float, seed: int = 0) -> DataFrame:
    """Each read with probability p."""
    return reads if p >= 1 else reads.sample(False, p, seed)


def bead_votes(reads: DataFrame, seq: str, first: int | None = 100_000, order: str | None = None) -> DataFrame:
    """One row with the number of the first reads (None: of all) that have the constant site where each bead type has it.

    A V17 site begins with the V19 site, so V17 hits don't count for V19.
    """
    head = reads.select(seq) if first is None else (reads.orderBy(order) if order else reads).select(seq).limit(first)
    hits = {k: F.count_if(F.substring(seq, *b.up) == b.site) for k, b in dna.BEADS.items()}
    hits["V19"] = hits["V19"] - hits["V17"]
    return head.agg(*(v.alias(k) for k, v in hits.items()))


def bead_type(votes: DataFrame, least: int = 0) -> DataFrame:
    """(bead, hits): the type with most hits, ties to the first by name; an error below `least` hits."""
    pairs = F.array(*(F.struct(F.col(k).alias("hits"), F.lit(k).alias("bead")) for k in sorted(dna.BEADS)))
    best = votes.select(F.element_at(F.array_sort(pairs, lambda a, b: F.when(a["hits"] != b["hits"], F.signum(b["hits"] - a["hits"]).cast("int")).otherwise(F.when(a["bead"] < b["bead"], -1).otherwise(1))), 1).alias("b")).select("b.bead", "b.hits")
    return best.filter(F.when(F.col("hits") >= least, True).otherwise(F.raise_error(F.lit("too few reads with a known site")).cast("boolean")))


def reads_switched(r1_hits: int, r2_hits: int) -> bool:
    """Whether the bead read is R1, as its site is found there more often than in R2."""
    return r1_hits > r2_hits


def read_switch(hits: list[tuple[int, int]]) -> bool:
    """reads_switched() for all pairs of files (hits of R1, hits of R2); an error where they don't agree."""
    switched = {reads_switched(a, b) for a, b in hits}
    if len(switched) != 1:
        raise ValueError("the assignment of R1 and R2 isn't consistent")
    return switched.pop()


def _v10_barcodes(reads: DataFrame, seq: str) -> DataFrame:
    """(first, second, n): halves of the barcodes of reads with the exact V10 site; reads are cut to their first 32 bases."""
    r = F.substring(seq, 1, 32)
    return reads.filter(F.substring(r, 9, 18) == dna.UP_LONG).groupBy(F.substring(r, 1, 8).alias("first"), F.substring(r, 27, 7).alias("second")).agg(F.count("*").alias("n"))


def _rates(hit: DataFrame, own: DataFrame) -> DataFrame:
    total = own.agg(F.sum("n").alias("total"))  # one row
    return hit.join(F.broadcast(total)).select("puck", F.round(F.try_divide(F.col("n") * 100, F.col("total")), 2).alias("pct"))


def puck_hit_rates(reads: DataFrame, pucks: DataFrame, seq: str = "r2") -> DataFrame:
    """(puck, pct): per cent, to two places, of reads with the exact V10 site whose barcode each of pucks (puck, sb) has.

    Fixed values: reads are cut to their first 32 bases, which leaves barcodes of 14.
    """
    own = _v10_barcodes(reads, seq).select(F.concat("first", "second").alias("sb"), "n")
    hit = pucks.select("puck", "sb").distinct().join(own, "sb", "left").groupBy("puck").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return _rates(hit, own)


def puck_hit_rates_of_halves(reads: DataFrame, firsts: DataFrame, seconds: DataFrame, seq: str = "r2") -> DataFrame:
    """puck_hit_rates() for pucks that have every first half of a set with every second half of the same set.

    firsts (puck, set, first; 8 bases) and seconds (puck, set, second) aren't expanded into barcodes: a read's barcode is
    in the pucks of the sets that its two halves share. Pucks without a barcode are left out.
    """
    sets = lambda df, half: df.groupBy(half).agg(F.collect_set(F.struct("puck", "set")).alias(f"_{half}"))
    own = _v10_barcodes(reads, seq)
    # left joins, as inner ones would filter own for nulls and so have it computed once more for the total
    shared = own.join(sets(firsts, "first"), "first", "left").join(sets(seconds, "second"), "second", "left").select("n", F.array_intersect("_first", "_second").alias("s"))
    found = shared.select("n", F.explode(F.array_distinct(F.transform("s", lambda x: x["puck"]))).alias("puck")).groupBy("puck").agg(F.sum("n").alias("n"))
    known = firsts.select("puck", "set").distinct().join(seconds.select("puck", "set").distinct(), ["puck", "set"], "left_semi").select("puck").distinct()
    hit = known.join(found, "puck", "left").select("puck", F.coalesce("n", F.lit(0)).alias("n"))
    return _rates(hit, own)


def whitelist_union(*lists: DataFrame, column: str = "cb") -> DataFrame:
    """The distinct values of all lists, sorted."""
    return reduce(lambda a, b: a.unionByName(b), (d.select(column) for d in lists)).distinct().orderBy(column)


def missing_from(known: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The distinct wanted values that known lacks: an empty table is the all-clear."""
    return wanted.select(column).distinct().join(known.select(column).distinct(), column, "left_anti")


def overlap_of(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """The distinct values that both have: an empty table is the all-clear."""
    return a.select(column).distinct().join(b.select(column).distinct(), column, "left_semi")


def per_bead(df: DataFrame, sb: str, weight: str = "reads") -> DataFrame:
    """(sb, reads, umis): reads and identifiers of each bead, for a row an identifier."""
    return df.groupBy(sb).agg(F.sum(weight).alias("reads"), F.count("*").alias("umis"))


def stacked_pucks(pucks: DataFrame) -> DataFrame:
    """pucks (sb, x, y, puck_index) with x from 0 on, each puck beside the ones before it. A row a puck is ordered."""
    ends = pucks.groupBy("puck_index").agg(F.min("x").alias("_low"), (F.max("x") - F.min("x")).alias("_wide"))
    before = F.coalesce(F.sum("_wide").over(Window.orderBy("puck_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return pucks.join(F.broadcast(ends.withColumn("_at", before)), "puck_index").withColumn("x", F.col("x") - F.col("_low") + F.col("_at")).drop("_low", "_wide", "_at")


def spatial_status(reads: DataFrame, bead: str, r1: str = "r1", r2: str = "r2") -> DataFrame:
    """reads with cb, umi, sb and status: where a read leaves the filter, or how its constant site matched.

    Order: length, N in the identifier, homopolymer identifier, then the constant site exact, fuzzy (a sixth of its
    length in mismatches, halves to even), poly-G, none. Only UP_exact and UP_fuzzy go on.
    """
    b = dna.BEADS[bead]
    parts = dna.slice_bead(F.col(r2), bead)
    out = reads.withColumns({**dna.slice_cell(F.col(r1)), "sb": parts["sb"], "_up": parts["up"]})
    n = len(b.site)
    tolerance = round(n / 6)
    off = dna.hamming(F.col("_up"), b.site, n)
    status = (
        F.when((F.length(r1) < CELL_LENGTH) & (F.length(r2) < b.length), "R1R2_tooshort")
        .when(F.length(r1) < CELL_LENGTH, "R1_tooshort")
        .when(F.length(r2) < b.length, "R2_tooshort")
        .when(F.contains("umi", F.lit("N")), "UMI_N")
        .when(dna.near_homopolymer(F.col("umi"), 12, round(12 / 6)), "UMI_homopolymer")
        .when(F.col("_up") == b.site, "UP_exact")
        .when(off <= tolerance, "UP_fuzzy")
        .when(dna.hamming(F.col("_up"), "G" * n, n) <= tolerance, "UP_GG")
        .otherwise("UP_none")
    )
    return out.withColumn("status", status).drop("_up")


def pair_flags(reads: DataFrame, bead1: str, bead2: str, r1: str = "r1", r2: str = "r2") -> DataFrame:
    """reads with sb1, umi1, sb2, umi2, a boolean for each counter, and stage (the first that fails, or 'pass').

    Within a stage both reads and all tests count independently. A later stage sees only what passed the earlier ones.
    """
    out, flags = reads, {}
    for k, (read, bead) in enumerate(((r1, bead1), (r2, bead2)), 1):
        b, parts = dna.BEADS[bead], dna.slice_bead(F.col(read), bead)
        out = out.withColumns({f"sb{k}": parts["sb"], f"umi{k}": parts["umi"], f"_up{k}": parts["up"]})
        up, n = F.col(f"_up{k}"), len(b.site)
        flags[f"R{k}_tooshort"] = (0, F.length(read) < b.length)
        flags[f"R{k}_no_UP"] = (1, dna.hamming(up, b.site, n) > (2 if k == 1 else 1))
        flags[f"R{k}_GG_UP"] = (1, dna.hamming(up, "G" * n, n) <= (3 if k == 1 else 2))
        flags[f"R{k}_N_UMI"] = (2, F.contains(f"umi{k}", F.lit("N")))
        flags[f"R{k}_homopolymer_UMI"] = (2, dna.near_homopolymer(F.col(f"umi{k}"), 9, 2))
        flags[f"R{k}_N_SB"] = (3, F.contains(f"sb{k}", F.lit("N")))
        flags[f"R{k}_homopolymer_SB"] = (4, dna.near_homopolymer(F.col(f"sb{k}"), 15, 3))
    names = ("length", "UP", "UMI", "SB_N", "SB_homopolymer")
    reached: Column = F.lit(True)
    stage: Column | None = None
    for s, name in enumerate(names):
        own = {k: f for k, (at, f) in flags.items() if at == s}
        out = out.withColumns({k: reached & f for k, f in own.items()})
        failed = reduce(lambda a, b: a | b, (F.col(k) for k in own))
        stage = F.when(failed, name) if stage is None else stage.when(failed, name)
        reached = reached & ~failed
    return out.withColumn("stage", stage.otherwise("pass")).drop("_up1", "_up2")


def counters(df: DataFrame, names: list[str]) -> DataFrame:
    """(key, value): how many rows have each of the boolean columns true."""
    sums = df.agg(*(F.count_if(F.col(n)).alias(n) for n in names))
    return sums.unpivot([], names, "key", "value").select("key", "value")


def fuzzy_map(whitelist: DataFrame, seq: str, length: int, n_barcodes: bool = True) -> DataFrame:
    """(key, match, pos, class): strings that a whitelist barcode may be read as.

    exact: the barcode itself. HD1: one mismatch from a single barcode (pos: 1-based). HD1ambig: one mismatch from
    several, match null and pos 0. With n_barcodes, a barcode with one N stands for itself and the four strings that
    the N may be; barcodes with more are left out. An exact key is never fuzzy.
    """
    known = whitelist.select(F.col(seq).alias("match")).distinct()
    plain = known.filter(~F.contains("match", F.lit("N")))
    near = dna.neighbours(plain, "match", length).select(F.col("neighbour").alias("key"), "match", "pos")
    if n_barcodes:
        one_n = known.filter(dna.count_base(F.col("match"), "N") == 1).withColumn("pos", F.instr("match", "N"))
        also = one_n.select(F.explode(F.concat(F.array("match"), dna.expand_n(F.col("match")))).alias("key"), "match", "pos")
        near = near.unionByName(also)
    fuzzy = near.groupBy("key").agg(F.count("*").alias("_n"), F.first("match").alias("match"), F.first("pos").alias("pos"))
    fuzzy = fuzzy.join(plain.select(F.col("match").alias("key")), "key", "left_anti")
    single = F.col("_n") == 1
    fuzzy = fuzzy.select("key", F.when(single, F.col("match")).alias("match"), F.when(single, F.col("pos")).otherwise(0).alias("pos"), F.when(single, "HD1").otherwise("HD1ambig").alias("class"))
    return plain.select(F.col("match").alias("key"), "match", F.lit(0).alias("pos"), F.lit("exact").alias("class")).unionByName(fuzzy)


def fuzzy_match(df: DataFrame, key: str, whitelist: DataFrame, seq: str, length: int, n_barcodes: bool = True) -> DataFrame:
    """df with match, pos and class; class is 'none' where nothing is near.

    Distinct keys are matched exactly first; only those left over meet the map of neighbours, so the large map is
    joined to few rows. Keys then come back by an equi-join.
    """
    keys = df.select(F.col(key).alias("key")).filter(F.col(key).isNotNull()).distinct()
    found = keys.join(fuzzy_map(whitelist, seq, length, n_barcodes), "key")
    out = df.join(found.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left").drop("_key")
    return out.withColumn("class", F.coalesce("class", F.lit("none")))


def match_totals(df: DataFrame, weight: str = "reads", by: str = "class") -> DataFrame:
    return df.groupBy(F.coalesce(by, F.lit("none")).alias(by)).agg(F.sum(weight).alias(weight))


def should_remap(counts: DataFrame, whitelist: DataFrame, cb: str = "cb", weight: str = "reads") -> DataFrame:
    """One row: reads that match the whitelist as it is and remapped, and whether remapping matches more."""
    plain = whitelist.select(F.col(cb).alias("_w"), F.lit("plain").alias("_k"))
    both = plain.unionByName(whitelist.select(dna.remap(F.col(cb)).alias("_w"), F.lit("remapped").alias("_k"))).distinct()
    hit = counts.groupBy(cb).agg(F.sum(weight).alias("_n")).join(both, F.col(cb) == F.col("_w"))
    total = lambda k: F.coalesce(F.sum(F.when(F.col("_k") == k, F.col("_n"))), F.lit(0))
    return hit.agg(total("plain").alias("reads_plain"), total("remapped").alias("reads_remapped")).withColumn("remap", F.col("reads_remapped") > F.col("reads_plain"))


def puck_quality(pucks: DataFrame, length: int, sb: str = "sb") -> DataFrame:
    """pucks with dropped: 'dup' for barcodes that come more than once, 'N', 'degen' for low complexity, else null."""
    low = (dna.commonest_base(F.col(sb)) > round(length * 4 / 5)) | (dna.longest_run(F.col(sb)) > round(length * 5 / 7))
    times = F.count("*").over(Window.partitionBy(sb))
    return pucks.withColumn("dropped", F.when(times > 1, "dup").when(F.contains(sb, F.lit("N")), "N").when(low, "degen"))


def whitelist_of(pucks: DataFrame, sb: str = "sb") -> DataFrame:
    """Distinct puck barcodes with one N at most."""
    return pucks.filter(dna.count_base(F.col(sb), "N") < 2).select(sb).distinct()


def count_reads(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("reads"))


def collapse(df: DataFrame, *keys: str, weight: str = "reads") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(weight).alias(weight))


def count_umis(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("umi"))


def only_maximum(df: DataFrame, keys: list[list[str]], weight: str = "reads") -> DataFrame:
    """Rows that are the single greatest of their group for every list of keys; a tie drops the whole group.

    All groups are looked at in the same input.
    """
    out, flags = df, []
    for k, by in enumerate(keys):
        w = Window.partitionBy(*by)
        out = out.withColumn(f"_m{k}", F.max(weight).over(w)).withColumn(f"_c{k}", F.count("*").over(Window.partitionBy(*by, weight)))
        flags.append((F.col(weight) == F.col(f"_m{k}")) & (F.col(f"_c{k}") == 1))
    return out.filter(reduce(lambda a, b: a & b, flags)).select(*df.columns)


def dominant_group(df: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """(keys, group, reads): the group of each key with strictly most rows; keys with a tie are gone."""
    return only_maximum(df.groupBy(*keys, *group).agg(F.count("*").alias("reads")), [keys])


def saturation(df: DataFrame, *keys: str, weight: str = "reads") -> DataFrame:
    """1 - rows / sum of weight, over all or by keys."""
    return df.groupBy(*keys).agg((1 - F.count("*") / F.sum(weight)).alias("saturation"))


def histogram(df: DataFrame, value: str, cap: int | None = None) -> DataFrame:
    """(value, n); values beyond cap count as cap."""
    v = F.col(value) if cap is None else F.least(F.col(value), F.lit(cap))
    return df.groupBy(v.alias(value)).agg(F.count("*").alias("n"))


def top_sums(df: DataFrame, key: str, weight: str = "umi", tops: tuple[int, ...] = (5, 20, 50, 100)) -> DataFrame:
    """(key, total, connections, max, top5 ...): sum, rows, greatest, and sums of the greatest weights of each key."""
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(weight))))
    sums = [F.sum(F.when(F.col("_r") <= t, F.col(weight)).otherwise(0)).alias(f"top{t}") for t in tops]
    return ranked.groupBy(key).agg(F.sum(weight).alias("total"), F.count("*").alias("connections"), F.max(weight).alias("max"), *sums)


def semi_both(pairs: DataFrame, left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with hit_a and hit_b, whether each side is listed; rows with both pass a filter on them."""
    la = left.select(F.col(a)).distinct().withColumn("hit_a", F.lit(True))
    rb = right.select(F.col(b)).distinct().withColumn("hit_b", F.lit(True))
    out = pairs.join(la, a, "left").join(rb, b, "left")
    return out.withColumns({"hit_a": F.coalesce("hit_a", F.lit(False)), "hit_b": F.coalesce("hit_b", F.lit(False))})


def anti_both(edges: DataFrame, gone_a: DataFrame, gone_b: DataFrame, a: str, b: str) -> DataFrame:
    return edges.join(gone_a.select(a).distinct(), a, "left_anti").join(gone_b.select(b).distinct(), b, "left_anti")


def numbered(df: DataFrame, order: list[str], index: str) -> DataFrame:
    """df with index, 1 ... n in the given order.

    Rows are range-partitioned, sorted and written once, with their partition's number; each partition numbers its own
    and adds what came before, so no task holds them all, and both readings see the same partitions.
    """
    from beadloom.operators.graph import cut

    parts = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()))
    own = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    found = own.join(F.broadcast(sizes.select("_p", "_before")), "_p")  # a row for each partition
    return found.select(*df.columns, (F.col("_i") + F.col("_before")).cast("bigint").alias(index))


def factorize(df: DataFrame, key: str, index: str) -> DataFrame:
    """df with index, 1 ... n in sorted order of the distinct keys."""
    return df.join(numbered(df.select(key).distinct(), [key], index), key)


def downsampling_curve(hist: DataFrame, value: str = "reads", n: str = "n", steps: int = 20) -> DataFrame:
    """(p, umis): expected identifiers hit when a share p of the reads of each multiplicity is drawn without replacement.

    Of k * v reads of v identifiers with k reads each, m = round(p * k * v) are drawn; an identifier is missed with
    probability C(kv - k, m) / C(kv, m), a product of k factors.
    """
    k, v = F.col(value).cast("double"), F.col(n).cast("double")
    grid = hist.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    drawn = F.bround(k * v * F.col("step") / steps)
    missed = F.aggregate(F.sequence(F.lit(0), (F.col(value) - 1).cast("int")), F.lit(1.0), lambda p, i: p * F.greatest(k * v - drawn - i, F.lit(0.0)) / (k * v - i))
    return grid.withColumn("_hit", v * (1 - missed)).groupBy((F.col("step") / steps).alias("p")).agg(F.sum("_hit").alias("umis"))


def thin(df: DataFrame, p: float, seed: int = 0, weight: str = "reads") -> DataFrame:
    """Counts replaced by binomial draws of probability p, zeros dropped; the same for a seed and a row.

    A count of n is n draws, each by a hash of the row, the seed and its number; beyond 64 the rest are one draw from
    the normal approximation with the right mean and variance, by two such hashes.
    """
    uniform = lambda k: (F.pmod(F.xxhash64(F.col("_h"), k), F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)
    few = F.least(F.col(weight), F.lit(64)).cast("int")
    hits = F.aggregate(F.sequence(F.lit(0), few), F.lit(0), lambda a, k: a + F.when((k > 0) & (uniform(k) < p), 1).otherwise(0))
    rest = (F.col(weight) - few).cast("double")
    normal = F.sqrt(-2 * F.log(uniform(F.lit(-1)))) * F.cos(2 * np.pi * uniform(F.lit(-2)))
    more = F.least(F.greatest(F.round(rest * p + normal * F.sqrt(rest * p * (1 - p))), F.lit(0.0)), rest)
    drawn = df.withColumn("_h", F.xxhash64(*df.columns, F.lit(seed)))
    return drawn.withColumn(weight, (hits + F.when(rest > 0, more).otherwise(0.0)).cast("bigint")).drop("_h").filter(F.col(weight) > 0)
