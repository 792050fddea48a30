"""Temperature mixing: source weights by an exponent on token shares, realised as budgeted block permutations.

DataFrame expressions only. What a source gets is its weight times the budget, in tokens; that many tokens are whole
permutations (blocks) of its documents and, at last, the beginning of one more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.llm.common import fresh, in_all_pieces, in_piece, pieces, read, stash

#: In op4 and the pipeline the weights' entropy is this far from that of the token shares to that of even weights, and no
#: source is repeated more often than this.
EVENNESS, MAX_REPEATS = 0.5, 1.5
#: Bits of a permutation key, and documents of a source that one task sorts, about.
KEY_BITS = 40
SORTED = 20_000
#: Halvings of the exponent's interval, so many of them by one job; digits that are kept.
STEPS, STEPS_A_JOB, DIGITS = 35, 5, 9
#: Entropies that differ by less are the same.
SAME = 1e-9
SEED = 17
#: A word is a run of characters other than these (space, tab, line feed, vertical tab, form feed, carriage return).
WORD = r"[^ \t\n\x0B\f\r]+"


def tokens(text: str = "text") -> Column:
    """Words, runs of characters other than ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _key(block: Column, id_: Column) -> Column:
    """A document's place in the given block's permutation: the first KEY_BITS bits of a digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(SEED)), block.cast("string"), id_.cast("string"))), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def exponent(sources: DataFrame, max_repeats: float | None = None, entropy: float | None = None, budget: int | None = None, evenness: float | None = None) -> float:
    """The smallest exponent, 0 to 1, that meets all given targets, by bisection over sources (n: tokens).

    max_repeats: no source is repeated more often, given the budget or, without one, the smallest budget that takes
    every document once. entropy: the weights have no more of it (nats). evenness: the same with an entropy so far, 0 to
    1, between that of the token shares and that of even weights. Targets that no exponent meets give 1. Every job
    halves the interval STEPS_A_JOB times from sums over the sources, which stay where they are.
    """
    if max_repeats is None and entropy is None and evenness is None:
        raise ValueError("max_repeats, entropy or evenness is needed")
    sizes = sources.filter("n > 0").select(F.col("n").cast("double").alias("n"))
    first = sizes.agg(F.count("*"), F.min("n"), F.max("n"), F.sum("n"), F.sum(F.col("n") * F.log("n"))).first()
    if not first[0]:
        return 1.0
    least, most = first[1], first[2]
    limits = [entropy] if entropy is not None else []
    if evenness is not None:
        own, even = math.log(first[3]) - first[4] / first[3], math.log(first[0])
        if even - own > SAME:  # else all sources have one size, and the exponent changes nothing
            limits.append(own + evenness * (even - own))

    def flat(a: float, z: float, s: float) -> bool:
        """Whether weights n^a are too even; z and s are the sums of n^a and n^a * log n."""
        if any(math.log(z) - a * s / z > h for h in limits):
            return True
        if max_repeats is None:
            return False
        return ((most / least) ** (1 - a) if budget is None else least ** (a - 1) / z * budget) > max_repeats

    def sums(grid: list[float]) -> list[tuple[float, float, float]]:
        row = sizes.agg(*(F.sum(x) for a in grid for x in (F.pow("n", F.lit(a)), F.pow("n", F.lit(a)) * F.log("n")))).first()
        return [(a, row[2 * k], row[2 * k + 1]) for k, a in enumerate(grid)]

    if not flat(*sums([0.0])[0]):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS // STEPS_A_JOB):
        width = (high - low) / (1 << STEPS_A_JOB)
        inner = sums([low + width * k for k in range(1, 1 << STEPS_A_JOB)])
        fine = next((k for k, point in enumerate(inner, 1) if not flat(*point)), 1 << STEPS_A_JOB)
        low, high = low + width * (fine - 1), low + width * fine
    return round(high, DIGITS)


def mix(df: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, budget: int | None = None, id_col: str = "doc_id", text: str = "text", source: str = "source", evenness: float | None = EVENNESS) -> DataFrame:
    """df with its rows as often as the mixture takes them, and epoch (int, from 0) and position (double, about 0 to 1) added.

    max_repeats, entropy and evenness: see exponent(). Without a budget (in tokens), every document comes at least once,
    as the budget is the smallest that allows it; with a smaller one, sources are cut as the weights ask. Documents
    without tokens (a null or blank text) cost nothing and come once, at position 0, whatever the budget. Ordered by
    position, the rows are the mixed stream: each source's blocks are spread evenly over it. A null source is a source
    of its own. Repeated rows share their places; null ids count as one id, and ids that are equal as text as one. An
    empty df gives an empty result. Columns of df named epoch or position are replaced, all others kept, whatever their
    names.
    """
    df = df.drop("epoch", "position")
    src = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # null apart from every name
    id_ = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    docs = stash(df.select(src.alias("s"), id_.alias("i"), tokens(text).alias("n")), "tokens")
    sources = stash(docs.groupBy("s").agg(F.sum("n").alias("tokens"), F.count("*").alias("n")), "sources")
    hot = pieces(sources.select("s", "n"), "s")
    some = sources.filter("tokens > 0").select("s", F.col("tokens").alias("n"), F.col("n").alias("docs"))
    a = exponent(some.select("n"), max_repeats, entropy, budget, evenness)
    sums = some.agg(F.sum(F.pow(F.col("n").cast("double"), F.lit(a))).alias("z"), F.max(F.pow(F.col("n").cast("double"), F.lit(1 - a))).alias("k"), F.max("docs").alias("docs")).first()
    if sums["z"] is None:
        return df.withColumns({"epoch": F.lit(0), "position": F.lit(0.0)})
    # weight * budget; the smallest full budget is z * max(n^(1-a))
    quota = F.round(F.pow(F.col("n").cast("double"), F.lit(a)) * F.lit(sums["k"] if budget is None else budget / sums["z"])).cast("bigint")
    plan = some.select("s", "n", quota.alias("quota")).select("s", "n", "quota", F.expr("quota div n").cast("int").alias("full"), F.expr("quota % n").alias("rest"))
    plan = stash(plan, "plan")
    # how far the last, partial block goes: sums by ranges of keys first, then only the range of the cut is sorted
    bits = max(0, min(KEY_BITS, (sums["docs"] // SORTED).bit_length()))
    begun = stash(in_all_pieces(plan.filter("rest > 0").select("s", "full", "rest"), "s", hot), "begun")
    last = in_piece(docs, "s", hot, F.xxhash64("i")).join(begun, ["s", "p"]).withColumn("k", _key(F.col("full"), F.col("i"))).withColumn("r", F.shiftright("k", KEY_BITS - bits))
    ranges = last.groupBy("s", "rest", "r").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, 0))
    cut = ranges.withColumn("upto", upto).filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))).select("s", "r", (F.col("upto") - F.col("n")).alias("before"))
    inside = last.join(cut, ["s", "r"])
    here = F.col("before") + F.sum("n").over(Window.partitionBy("s").orderBy("k", "i").rowsBetween(Window.unboundedPreceding, 0))
    over = inside.withColumn("upto", here).filter(F.col("upto") > F.col("rest")).groupBy("s").agg(F.min(F.struct("k", "i")).alias("cut"))
    own_s, own_i, own_p, got = fresh(df, "mix_s", "mix_i", "mix_p", "mix_plan")
    plan = plan.join(over, "s", "left").select("s", F.struct("n", "quota", "full", "rest", "cut").alias("plan"))
    # written, so that Spark knows its size: it is broadcast below spark.sql.autoBroadcastJoinThreshold
    plan = stash(in_all_pieces(plan, "s", hot).select(F.col("s").alias(f"{own_s}_"), F.col("p").alias(f"{own_p}_"), F.col("plan").alias(got)), "plan")
    out = in_piece(df.withColumn(own_s, src).withColumn(own_i, id_), own_s, hot.withColumnRenamed("s", own_s), F.xxhash64(own_i), own_p)
    out = out.join(plan, (F.col(own_s) == F.col(f"{own_s}_")) & (F.col(own_p) == F.col(f"{own_p}_")), "left")
    # the last block takes what comes before the first document that would go over the quota
    of = lambda c: F.col(got)[c]
    ident, blank = F.col(own_i), ~F.coalesce(F.rlike(F.col(text), F.lit(WORD)), F.lit(False))
    place = F.struct(_key(of("full"), ident).alias("k"), ident.alias("i"))
    partial = F.coalesce((of("rest") > 0) & (place < of("cut")), F.lit(False))
    times = F.when(blank, 1).otherwise(of("full") + partial.cast("int"))
    epoch, position = "epoch", F.col("epoch") + _key(F.col("epoch"), ident) / F.lit(float(1 << KEY_BITS))
    out = out.filter(times > 0).withColumn(epoch, F.explode(F.sequence(F.lit(0), times - 1)))
    return out.select(*df.columns, epoch, F.when(blank, 0.0).otherwise(position / (of("quota") / of("n"))).alias("position"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", "epoch", F.round("position", 9).alias("position"))


_MID = "(low + high) / 2"
_FLAT = f"(pow(q, 1 - {_MID}) > {MAX_REPEATS} OR ln(list_sum(list_transform(v, lambda x: pow(x, {_MID})))) - {_MID} * list_sum(list_transform(v, lambda x: pow(x, {_MID}) * ln(x))) / list_sum(list_transform(v, lambda x: pow(x, {_MID}))) > target)"

OP4_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS s, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n, source FROM documents),
t AS (SELECT s, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY s HAVING sum(n) > 0),
l AS (SELECT list(CAST(n AS DOUBLE) ORDER BY n) AS v, max(n) / min(n) AS q, ln(count(*)) AS even, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS own FROM t),
e AS (SELECT v, q, even, CASE WHEN even - own > {SAME} THEN own + {EVENNESS} * (even - own) ELSE even + 1 END AS target FROM l),
bisect(k, low, high) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
    SELECT k + 1, CASE WHEN {_FLAT} THEN {_MID} ELSE low END, CASE WHEN {_FLAT} THEN high ELSE {_MID} END FROM bisect, e WHERE k < {STEPS}),
a AS (SELECT CASE WHEN (SELECT q > {MAX_REPEATS} OR even > target FROM e) THEN round(max(high), {DIGITS}) ELSE 0.0 END AS a FROM bisect WHERE k = {STEPS}),
p AS (SELECT s, n, CAST(round(pow(CAST(n AS DOUBLE), a) * (SELECT max(pow(CAST(n AS DOUBLE), 1 - a)) FROM t)) AS BIGINT) AS quota FROM t, a),
b AS (SELECT d.doc_id, d.source, d.s, d.n, p.n AS total, quota, unnest(range(CAST(quota // p.n AS BIGINT) + 1)) AS epoch FROM d JOIN p ON d.s = p.s WHERE d.n > 0),
k AS (SELECT *, CAST('0x' || substr(md5('{SEED}:' || epoch || ':' || doc_id), 1, {KEY_BITS // 4}) AS BIGINT) AS key FROM b),
c AS (SELECT *, sum(n) OVER (PARTITION BY s, epoch ORDER BY key, CAST(doc_id AS VARCHAR) ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, round((epoch + key / {float(1 << KEY_BITS)}) / (quota / total), 9) AS position
FROM c WHERE (epoch + 1) * total <= quota OR upto <= quota % total
UNION ALL SELECT doc_id, source, 0, 0.0 FROM d WHERE n = 0
"""
