"""End-to-end batch pipelines composed of the operators. Stages return tables; a caller writes those it wants to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beadloom.functions import dna
from beadloom.operators import cells, cluster, demux, graph, reads, stats, variants


def spatial_count(pairs: DataFrame, pucks: DataFrame, bead: str | None = None, p: float = 1.0, seed: int = 0) -> dict[str, DataFrame]:
    """Read pairs (r1, r2) and pucks (sb, x, y, puck_index) to matrix (cb, umi, sb, reads) and metrics (key, value).

    The bead type is voted for by the first reads where none is given.
    """
    bead = bead or reads.bead_type(reads.bead_votes(pairs, "r2")).first()["bead"]
    staged = reads.spatial_status(reads.downsample(pairs, p, seed), bead)
    passed = staged.filter(F.col("status").isin("UP_exact", "UP_fuzzy"))
    length = dna.BEADS[bead].sb_1[1] + dna.BEADS[bead].sb_2[1]
    counted = reads.count_reads(passed, "cb", "umi", "sb")
    matched = graph.cut(reads.fuzzy_match(counted, "sb", reads.whitelist_of(pucks), "sb", length))
    matrix = reads.collapse(matched.filter(F.col("match").isNotNull()).select("cb", "umi", F.col("match").alias("sb"), "reads"), "cb", "umi", "sb")
    status = staged.groupBy(F.col("status").alias("key")).agg(F.count("*").alias("value"))
    classes = reads.match_totals(matched).select(F.concat(F.lit("SB_"), "class").alias("key"), F.col("reads").alias("value"))
    return {"matrix": matrix, "metrics": status.unionByName(classes), "puck": pucks}


def positioning(matrix: DataFrame, pucks: DataFrame, whitelist: DataFrame, length: int, cb_length: int = 16, eps: float | None = None, knn: int = 36, cmes: float = 0.0, p: float = 1.0, min_pts: int | None = None) -> dict[str, DataFrame]:
    """Count matrix, pucks and cell whitelist (cb) to coords, coords2 and metrics."""
    if p < 1:
        matrix = reads.thin(matrix, p)
    cells_ = whitelist.select(dna.strip_suffix(F.col("cb")).alias("cb")).distinct()
    if reads.should_remap(matrix, cells_).first()["remap"]:
        cells_ = cells_.select(dna.remap(F.col("cb")).alias("cb"))
    good = reads.puck_quality(pucks, length).filter("dropped IS NULL").select("sb", "x", "y")
    named = graph.cut(reads.fuzzy_match(matrix, "cb", cells_, "cb", cb_length, n_barcodes=False))
    metrics = reads.match_totals(named).select(F.concat(F.lit("CB_"), "class").alias("key"), F.col("reads").alias("value"))
    called = named.filter(F.col("match").isNotNull()).select(F.col("match").alias("cb"), "umi", "sb", "reads").join(good.select("sb"), "sb", "left_semi")
    unique = reads.only_maximum(reads.collapse(called, "cb", "umi", "sb"), [["cb", "umi"]])
    points = graph.cut(reads.count_umis(unique, "cb", "sb").join(good, "sb").select("cb", "sb", "x", "y", "umi"))
    eps = eps or cluster.bead_eps(good, knn)
    ranges = graph.cut(cluster.cell_bounds(points, eps, cmes))
    if min_pts is None:
        best = cluster.global_threshold(ranges).first()
        min_pts = best["point"] if best and best["point"] is not None else 1
    coords = cluster.placement(cluster.clusters(points, eps, min_pts, cmes), cells_)
    return {"coords": coords, "coords2": cluster.dynamic_placement(points, ranges, eps, cmes), "metrics": metrics, "points": points}


def reconstruction_count(pairs: DataFrame, bead1: str, bead2: str, cut1: int | None = None, cut2: int | None = None, z: float = 3.0) -> dict[str, DataFrame]:
    """Read pairs to the bead-by-bead matrix (sb1_index, sb2_index, umi) with barcode lists and metrics.

    cut1, cut2: molecules that a bead needs; None takes the elbow's.
    """
    flagged = reads.pair_flags(pairs, bead1, bead2)
    names = [f"R{k}_{n}" for n in ("tooshort", "no_UP", "GG_UP", "N_UMI", "homopolymer_UMI", "N_SB", "homopolymer_SB") for k in (1, 2)]
    tuples = graph.cut(reads.count_reads(flagged.filter("stage = 'pass'"), "sb1", "umi1", "sb2", "umi2"))
    keep = {}
    for k, given in ((1, cut1), (2, cut2)):
        per = tuples.groupBy(f"sb{k}").agg(F.count("*").alias("n"))
        least = given if given is not None else (stats.cutoff_auto(per, "n").first()["cutoff"] or 1)
        keep[k] = per.filter(F.col("n") >= least)
    matched = reads.semi_both(tuples, keep[1], keep[2], "sb1", "sb2").filter("hit_a AND hit_b")
    edges = graph.cut(reads.count_umis(reads.only_maximum(matched, [["sb1", "umi1"], ["sb2", "umi2"]]), "sb1", "sb2"))
    gone = {}
    for k in (1, 2):
        per = edges.groupBy(f"sb{k}").agg(F.count("*").alias("connections"))
        limit = stats.connection_cutoff(per, "connections", z).first()["cutoff"]
        gone[k] = per.filter(F.col("connections") > (limit if limit is not None else float("inf")))
    edges = graph.cut(reads.anti_both(edges, gone[1], gone[2], "sb1", "sb2"))
    indexed = reads.factorize(reads.factorize(edges, "sb1", "sb1_index"), "sb2", "sb2_index")
    lists = {f"sb{k}": indexed.select(f"sb{k}", f"sb{k}_index").distinct() for k in (1, 2)}
    return {"matrix": indexed.select("sb1_index", "sb2_index", "umi"), "metrics": reads.counters(flagged, names), "reads_per_umi": reads.histogram(tuples, "reads"), **lists}


def reconstruct(matrix: DataFrame, diameter: float | None = None, n: int = 150, neighbours: int = 30, rounds: int = 15) -> dict[str, DataFrame]:
    """Matrix (i, c, n) to a neighbour graph and a puck (id, x, y). The layout is a deterministic stand-in."""
    sims = graph.product_top(graph.log_normalised(matrix, "i", "c", "n"), "i", "c", "w", n)
    knn = graph.cut(graph.nearest(graph.to_distances(sims), neighbours))
    solid = graph.largest_component(graph.peeled(knn, min(neighbours, 5)))
    xy = graph.layout(solid, rounds)
    if diameter is None:
        from beadloom.functions.text import bead_diameter

        diameter = float(xy.agg(bead_diameter(F.count("*")).alias("d")).first()["d"])
    return {"knn": knn, "puck": graph.scaled(xy, diameter)}


def variants_by_umi(records: DataFrame, reference: DataFrame) -> dict[str, DataFrame]:
    """Records (read, flag, rname, pos, mapq, cigar, seq, qual, cb, ub) and reference (rname, seq) to tables by identifier."""
    tagged = records.filter((F.col("flag").bitwiseAND(F.lit(4)) == 0) & (F.coalesce("cb", F.lit("")) != "") & (F.coalesce("ub", F.lit("")) != ""))
    return variants.collapse_umis({"data": tagged.select("read", "flag", "rname", "mapq", "cb", "ub"), **variants.scrape(tagged, reference)})


def demultiplex(counts: DataFrame, triplets: DataFrame, tags: DataFrame, conditions: DataFrame | None = None) -> DataFrame:
    """(cell, group, doublet[, condition]) of tag counts (cell, tag_idx, count)."""
    out = demux.calls(counts, demux.group_of_tags(triplets, tags))
    return out if conditions is None else out.join(conditions.select("group", "condition"), "group", "left")


def cell_features(counts: DataFrame, molecules: DataFrame, clean: DataFrame | None = None) -> DataFrame:
    return cells.features(counts, molecules, clean)
