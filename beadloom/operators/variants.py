"""Alignments to per-identifier variants: CIGAR walks, tag pivots, and the collapse of reads that share an identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beadloom.functions.alignment import mean_rounded, strand
from beadloom.operators.reads import only_maximum
from beadloom.operators.stats import interval_union, stabbing_counts

#: Base quality above which an observation is high, and bases that a covering match must reach beyond.
QUALITY, BUFFER = 30, 15
#: Bases of the reference in a row.
BIN = 65_536


def cigar_walk(records: DataFrame) -> DataFrame:
    """(read, k, op, len, qpos, rpos): each CIGAR operation with the query and reference position where it begins.

    M, I, S take query bases; M, D, N take reference bases. H, P, = and X raise an error.
    """
    ops = F.arrays_zip(F.regexp_extract_all("cigar", F.lit(r"(\d+)([A-Z=])"), F.lit(1)).alias("len"), F.regexp_extract_all("cigar", F.lit(r"(\d+)([A-Z=])"), F.lit(2)).alias("op"))
    steps = records.select("read", "pos", F.posexplode(ops).alias("k", "o")).select("read", "pos", "k", F.col("o.op").alias("op"), F.col("o.len").cast("bigint").alias("len"))
    steps = steps.withColumn("op", F.when(F.col("op").isin(*"MIDNS"), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unexpected CIGAR operation "), F.col("op")))))
    before = Window.partitionBy("read").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    taken = lambda ops: F.coalesce(F.sum(F.when(F.col("op").isin(*ops), F.col("len")).otherwise(0)).over(before), F.lit(0))
    return steps.select("read", "k", "op", "len", taken("MIS").alias("qpos"), (F.col("pos") + taken("MDN")).alias("rpos"))


def scrape(records: DataFrame, reference: DataFrame) -> dict[str, DataFrame]:
    """Tables of records (read, rname, pos, cigar, seq, qual array<int>) against reference (rname, seq).

    match (read, start, end), snv (read, pos, ref, alt, qual; bases as ASCII codes), ins and softclip (read, pos, str),
    del and refskip (read, pos, len). Positions are 0-based reference ones; those of ins and softclip are the next base.
    """
    walk = cigar_walk(records).join(records.select("read", "rname", "seq", "qual"), "read")
    at = lambda op: walk.filter(F.col("op") == op)
    text = F.expr("substring(seq, int(qpos + 1), int(len))")
    # stretches of at most BIN bases against a row of the reference each; only those that differ are looked at by base
    bins = reference.select("rname", "seq", F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(BIN))).alias("_at"))
    bins = bins.select("rname", F.col("_at").cast("bigint").alias("_at"), F.substr("seq", F.col("_at") + 1, F.lit(BIN)).alias("_ref"))
    low, high = F.floor(F.col("rpos") / BIN) * BIN, F.floor((F.col("rpos") + F.col("len") - 1) / BIN) * BIN
    met = at("M").filter("len > 0").withColumn("_at", F.explode(F.sequence(low, high, F.lit(BIN).cast("bigint")))).join(bins, ["rname", "_at"])
    met = met.withColumn("_from", F.greatest("rpos", "_at")).withColumn("_n", F.least(F.col("rpos") + F.col("len"), F.col("_at") + BIN) - F.col("_from"))
    met = met.select("read", "qual", "_from", (F.col("qpos") + F.col("_from") - F.col("rpos")).alias("_q"), "_n", F.expr("substring(_ref, int(_from - _at + 1), int(_n))").alias("_ref"), F.expr("substring(seq, int(qpos + _from - rpos + 1), int(_n))").alias("_own")).filter("_ref <> _own")
    off = F.filter(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int")), lambda i: F.substr("_ref", i + 1, F.lit(1)) != F.substr("_own", i + 1, F.lit(1)))
    snv = met.withColumn("_i", F.explode(off)).select("read", (F.col("_from") + F.col("_i")).alias("pos"), F.expr("ascii(substring(_ref, _i + 1, 1))").alias("ref"), F.expr("ascii(substring(_own, _i + 1, 1))").alias("alt"), F.get("qual", (F.col("_q") + F.col("_i")).cast("int")).alias("qual"))
    strings = {k: at(op).select("read", F.col("rpos").alias("pos"), text.alias("str")) for k, op in (("ins", "I"), ("softclip", "S"))}
    lengths = {k: at(op).select("read", F.col("rpos").alias("pos"), "len") for k, op in (("del", "D"), ("refskip", "N"))}
    return {"match": at("M").select("read", F.col("rpos").alias("start"), (F.col("rpos") + F.col("len")).alias("end")), "snv": snv, **strings, **lengths}


def counters(records: DataFrame) -> DataFrame:
    """One row: records, those without cb and ub (before the alignment test), and unaligned ones."""
    none = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) == "")
    return records.agg(F.count("*").alias("reads"), none("cb").alias("no_cb"), none("ub").alias("no_ub"), F.count_if(F.col("flag").bitwiseAND(F.lit(4)) != 0).alias("unaligned"))


def collapse_umis(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per-identifier tables of data (read, flag, rname, mapq, cb, ub) and its children match, snv, ins, del.

    An identifier (cb, ub) keeps the reads of its (rname, strand) with strictly most reads; with a tie it is gone.
    data: (umi, cb, ub, rname, strand, reads, mapq_avg), umi numbered from 1 in order of (cb, ub). snv: high and low
    quality observations and covering matches. ins, del: observations, matches that cover and that cover with a margin.
    """
    data = tables["data"].withColumn("strand", strand(F.col("flag")))
    groups = data.groupBy("cb", "ub", "rname", "strand").agg(F.count("*").alias("reads"), F.sum("mapq").alias("_q"))
    kept = only_maximum(groups, [["cb", "ub"]])
    from beadloom.operators.reads import factorize

    kept = factorize(kept.withColumn("_id", F.struct("cb", "ub")), "_id", "umi").drop("_id")
    out = {"data": kept.select("umi", "cb", "ub", "rname", "strand", "reads", mean_rounded(F.col("_q"), F.col("reads")).alias("mapq_avg"))}
    reads = data.join(kept.select("cb", "ub", "rname", "strand", "umi"), ["cb", "ub", "rname", "strand"]).select("read", "umi")
    own = {k: tables[k].join(reads, "read") for k in ("match", "snv", "ins", "del")}
    spans = own["match"].select("umi", "start", "end")
    out["match"] = interval_union(spans, "umi")
    seen = own["snv"].groupBy("umi", "pos", "alt").agg(F.count_if(F.col("qual") > QUALITY).alias("hq"), F.count_if(F.col("qual") <= QUALITY).alias("lq"))
    out["snv"] = stabbing_counts(seen, spans, "umi", "pos")
    for k, column in (("ins", "str"), ("del", "len")):
        obs = own[k].groupBy("umi", "pos", column).agg(F.count("*").alias("obs"))
        near = stabbing_counts(obs, spans, "umi", "pos", buffer=0).withColumnRenamed("covers", "lq")
        out[k] = stabbing_counts(near, spans, "umi", "pos", buffer=BUFFER).withColumnRenamed("covers", "hq").withColumn("lq", F.col("lq") - F.col("hq"))
    return out


def snv_quality(df: DataFrame, keys: list[str], quality: str, above: float = QUALITY) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(F.col(quality) > above).alias("hq"), F.count_if(F.col(quality) <= above).alias("lq"))


def pivot_tags(df: DataFrame, key: str, tag: str, value: str, tags: list[str]) -> DataFrame:
    """One row a key with a column for each tag, '' where it is missing; of several values the least."""
    wide = df.groupBy(key).pivot(tag, tags).agg(F.min(F.col(value).cast("string")))
    return wide.select(key, *(F.coalesce(F.col(f"`{t}`"), F.lit("")).alias(t) for t in tags))
