"""Cross-site boilerplate lines by distinct-site spread: HyperLogLog sketches, exact counts near the threshold.

Occurrences of a line are found and judged by hash, so a line that is nearly everywhere is a hot key. Lines with more
than 1 / PIECES of all occurrences are dealt into pieces of that size, and every join by line goes by (line, piece). What leaves the texts is joined to them by document, which has no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.llm.common import PIECES, drop, fresh, in_all_pieces, in_piece, pieces, read, stash

#: A line on at least this many sites, in at least as many different texts, is boilerplate.
MIN_SITES = 8
#: Shorter lines (in characters, trimmed) are never boilerplate. 1: every line that isn't blank is judged by its spread.
MIN_CHARS = 1
#: Estimates within this share of the threshold are counted exactly.
BAND = 0.35
#: log2 of a sketch's registers; the standard error, 1.04 / sqrt(2^10), is a tenth of BAND.
LG_K = 10
#: What a line must hold so as not to be blank.
INK = r"[^ \t\n\x0B\f\r]"


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def occurrences(df: DataFrame, id_col: str, text: str, site: str, min_chars: int) -> DataFrame:
    """(id, t, site, pos, h, g): a row for each line that could be boilerplate.

    t is a hash of the whole text; h and g are two hashes of the line, by which lines are held to be equal. Rows with a
    null text or site have none; a null id stays null.
    """
    lines = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.col(site).alias("site"), F.posexplode(_lines(text)).alias("pos", "line"))
    line = F.trim("line")
    judged = F.col("site").isNotNull() & F.col("line").rlike(INK)
    if min_chars > 1:
        judged = judged & (F.length(line) >= min_chars)
    return lines.filter(judged).select("id", "t", "site", "pos", F.xxhash64(line).alias("h"), F.xxhash64(F.lit(29), line).alias("g"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> tuple[DataFrame, list[DataFrame]]:
    """((id, t, pos, h, g) of the lines of occurrences() that are boilerplate, scratch tables to drop after use).

    Boilerplate is on at least min_sites sites, in at least as many different texts. Lines on one site or in one text
    only are out by their least and greatest value. The others get two sketches each, which tasks merge before and after
    the shuffle; only where an estimate is near the threshold the sites or texts are counted exactly.
    """
    several = lines.groupBy("h").agg(F.count("*").alias("n"), *(f(c).alias(f"{c}_{f.__name__}") for c in ("site", "t") for f in (F.min, F.max)))
    several = several.filter((F.col("n") >= min_sites) & (F.col("site_min") < F.col("site_max")) & (F.col("t_min") != F.col("t_max"))).select("h", "n")
    several = stash(several, "several")
    hot = pieces(several, "h", PIECES)
    candidates = in_piece(lines, "h", hot, F.xxhash64("id", "t", "pos")).join(in_all_pieces(several.select("h"), "h", hot), ["h", "p"], "left_semi")
    candidates = stash(candidates.select("h", "g", "p", "id", "t", "site", "pos"), "lines")
    spread = candidates.groupBy("h", "g").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("site"), F.hll_sketch_estimate(F.hll_sketch_agg("t", LG_K)).alias("t"))
    spread = stash(spread.filter(F.least("site", "t") >= min_sites * (1 - BAND)), "spread")
    found = spread.select("h", "g")
    for c in ("site", "t"):
        near = in_all_pieces(spread.filter(F.col(c) <= min_sites * (1 + BAND)).select("h", "g"), "h", hot)
        exact = candidates.join(near, ["h", "g", "p"], "left_semi").select("h", "g", c).distinct().groupBy("h", "g").agg(F.count("*").alias("n"))
        enough = spread.filter(F.col(c) > min_sites * (1 + BAND)).select("h", "g").unionByName(exact.filter(F.col("n") >= min_sites).select("h", "g"))
        found = found.join(enough, ["h", "g"], "left_semi")
    found = stash(found, "boilerplate")
    hits = candidates.join(in_all_pieces(found, "h", hot), ["h", "g", "p"], "left_semi").select("h", "g", "id", "t", "pos")
    return hits, [several, hot, candidates, spread, found]


def dedup_lines(df: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """df with its text freed of cross-site boilerplate, and n_lines and n_removed (bigint) added.

    A boilerplate line stays where it comes first (smallest id, then position) and goes everywhere else; all other lines
    keep their order. Lines of fewer than min_chars characters stay; with 1 only blank ones are exempt. Lines are equal
    when they are so after trimming spaces. Copies of one text count as one text, so a line that only whole copies share
    isn't boilerplate. A null text has no lines and stays null; rows with a null site keep all their lines and count for
    no site; rows with a null id come before all others. Repeated rows are treated alike. An empty df gives an empty
    result. Columns of df named n_lines or n_removed are replaced, all others kept, whatever their names.
    """
    df = df.drop("n_lines", "n_removed")
    hits, scratch = spread_lines(occurrences(df, id_col, text, site, min_chars), min_sites)
    hits = stash(hits, "hits")
    first = hits.groupBy("h", "g").agg(F.min(F.struct("id", "pos", "t")).alias("f")).select(F.col("h").alias("fh"), F.col("g").alias("fg"), *(F.col(f"f.{c}").alias(f"f{c}") for c in ("id", "pos", "t")))
    same = F.col("id").eqNullSafe(F.col("fid"))
    for c in ("h", "g", "pos", "t"):
        same = same & (F.col(c) == F.col(f"f{c}"))
    other = hits.join(first, same, "left_anti")  # by whole occurrences, so a line's rows are spread
    row_id, row_t, gone_id, gone_t, gone = fresh(df, "row_id", "row_t", "gone_id", "gone_t", "gone")
    gone_of = stash(other.groupBy(F.col("id").alias(gone_id), F.col("t").alias(gone_t)).agg(F.collect_set("pos").alias(gone)), "gone")
    drop(*scratch, hits)
    keyed = df.select("*", F.col(id_col).alias(row_id), F.xxhash64(text).alias(row_t))
    out = keyed.join(gone_of.hint("shuffle_hash"), F.col(row_id).eqNullSafe(F.col(gone_id)) & (F.col(row_t) == F.col(gone_t)), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(_lines(text)) - 1), F.col(gone))
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda i: F.get(_lines(text), i)), "\n"))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(text))).cast("bigint").alias("n_lines")
    n_removed = F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint").alias("n_removed")
    return out.select(*(cleaned.alias(c) if c == text else F.col(c) for c in df.columns), n_lines, n_removed)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


OP6_SQL = r"""
WITH l AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS parts FROM documents),
x AS (SELECT doc_id, text, source, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM l),
y AS (SELECT doc_id, text, source, pos, trim(line, ' ') AS line FROM x WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') AND source IS NOT NULL),
b AS (SELECT line FROM y GROUP BY line HAVING count(DISTINCT source) >= 8 AND count(DISTINCT text) >= 8),
f AS (SELECT y.doc_id, y.pos, row_number() OVER (PARTITION BY y.line ORDER BY y.doc_id, y.pos) AS k FROM y JOIN b USING (line)),
g AS (SELECT doc_id, pos FROM f WHERE k > 1)
SELECT x.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, coalesce(string_agg(CASE WHEN g.pos IS NULL THEN x.line END, chr(10) ORDER BY x.pos), '') AS text
FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.pos = x.pos GROUP BY x.doc_id
"""
