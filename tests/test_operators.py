import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from beadloom.functions import dna
from beadloom.operators import bookkeeping, cells, cluster, demux, geometry, graph, reads, stats, variants
from beadloom.plans import pipelines


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def mer(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_fuzzy_map_agrees_with_distances(spark):
    rng = random.Random(3)
    wl = sorted({mer(rng, 5) for _ in range(40)}) + ["ACNGT", "ANNGT"]
    keys = ["".join(rng.choice("ACGTN") for _ in range(5)) for _ in range(400)]
    got = {r["key"]: (r["match"], r["class"]) for r in reads.fuzzy_match(spark.createDataFrame([(k,) for k in set(keys)], ["key"]), "key", spark.createDataFrame([(w,) for w in wl], ["sb"]), "sb", 5).collect()}
    for k in set(keys):
        near = [w for w in wl if "N" not in w and sum(a != b for a, b in zip(w, k)) == 1]
        near += ["ACNGT"] * (k == "ACNGT" or (k[:2] + k[3:] == "ACGT" and k[2] in "ACGT"))
        expected = (k, "exact") if k in wl and "N" not in k else (near[0], "HD1") if len(near) == 1 else (None, "HD1ambig") if near else (None, "none")
        assert got[k] == expected, k


def test_waterfall_keeps_all_reads(spark):
    rng = random.Random(4)
    data = []
    for _ in range(300):
        up = rng.choice([dna.UP_LONG, dna.UP_LONG[:-1] + "T", "G" * 18, mer(rng, 18)])
        data.append((mer(rng, rng.choice([20, 28, 30])), mer(rng, 9) + up + mer(rng, 8) + mer(rng, rng.choice([5, 9]))))
    df = spark.createDataFrame(data, ["r1", "r2"])
    counts = dict(rows(reads.spatial_status(df, "V17").groupBy("status").count()))
    assert sum(counts.values()) == 300 and counts["UP_exact"] > 0 and counts["UP_fuzzy"] > 0 and counts["UP_GG"] > 0
    flagged = reads.pair_flags(df, "V17", "V15")
    names = [c for c in flagged.columns if c.startswith(("R1_", "R2_"))]
    assert len(names) == 14
    assert flagged.filter((F.col("stage") != "pass") & ~F.greatest(*(F.col(c).cast("int") for c in names)).cast("boolean")).count() == 0
    assert flagged.filter((F.col("stage") == "pass") & F.greatest(*(F.col(c).cast("int") for c in names)).cast("boolean")).count() == 0


def test_only_maximum_drops_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("b", 1, 4), ("b", 2, 4), ("c", 9, 1)], ["k", "v", "reads"])
    assert rows(reads.only_maximum(df, [["k"]])) == [("a", 1, 5), ("c", 9, 1)]


def test_factorize_numbers_in_order(spark):
    df = spark.createDataFrame([(f"k{k % 70:03d}", k) for k in range(200)], ["k", "v"])
    got = {(r["k"], r["i"]) for r in reads.factorize(df, "k", "i").collect()}
    assert got == {(f"k{k:03d}", k + 1) for k in range(70)}


def test_downsampling_ends(spark):
    h = spark.createDataFrame([(1, 10), (3, 5)], ["reads", "n"])
    got = {round(r["p"], 2): r["umis"] for r in reads.downsampling_curve(h).collect()}
    assert got[0.0] == 0 and abs(got[1.0] - 15) < 1e-9 and 0 < got[0.5] < 15


def test_thin_is_repeatable(spark):
    df = spark.createDataFrame([(k, 20) for k in range(50)], ["k", "reads"])
    a, b = rows(reads.thin(df, 0.5, 1)), rows(reads.thin(df, 0.5, 1))
    assert a == b and 300 < sum(x[1] for x in a) < 700


def test_intervals(spark):
    df = spark.createDataFrame([("u", 1, 4), ("u", 4, 6), ("u", 8, 9), ("v", 2, 3)], ["k", "start", "end"])
    assert rows(stats.interval_union(df, "k")) == [("u", 1, 6), ("u", 8, 9), ("v", 2, 3)]
    pts = spark.createDataFrame([("u", 4), ("u", 6), ("w", 1)], ["k", "pos"])
    assert rows(stats.stabbing_counts(pts, df, "k", "pos")) == [("u", 4, 1), ("u", 6, 0), ("w", 1, 0)]


def test_most_covered_takes_the_largest_tie(spark):
    df = spark.createDataFrame([(0, 5), (2, 7), (9, 9)], ["lo", "hi"])
    assert rows(stats.most_covered(df, "lo", "hi")) == [(5, 2)]


def test_h_index(spark):
    df = spark.createDataFrame([("a", v) for v in (10, 8, 5, 4, 3)] + [("b", 25)], ["k", "v"])
    assert rows(stats.h_index(df, "k", "v")) == [("a", 4), ("b", 1)]


def test_density_mode():
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(1, 0.1, 500), rng.normal(3, 0.5, 50)])
    assert abs(stats.kde_mode(v, np.ones(len(v))) - 1) < 0.1


def brute_dbscan(xy, w, eps, t):
    near = ((xy[:, None] - xy[None]) ** 2).sum(2) <= eps * eps
    core = near @ w >= t
    part = list(range(len(xy)))
    for a, b in combinations(range(len(xy)), 2):
        if near[a, b] and core[a] and core[b]:
            x, y = part[a], part[b]
            part = [min(x, y) if p in (x, y) else p for p in part]
    return core, near, part


def test_dbscan_and_bounds_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 14))
        xy, w = rng.integers(0, 12, (n, 2)).astype(float), rng.integers(1, 5, n).astype(float)
        counts = {}
        for t in range(0, int(w.sum()) + 2):
            core, near, part = brute_dbscan(xy, w, 2.5, t)
            label = cluster.dbscan(xy, w, 2.5, t)
            groups = {part[k] for k in range(n) if core[k]}
            counts[t] = len(groups)
            assert label.max() == len(groups)
            for a, b in combinations(np.flatnonzero(core), 2):
                assert (label[a] == label[b]) == (part[a] == part[b])
            for k in np.flatnonzero(~core):
                assert (label[k] > 0) == bool((near[k] & core).any())
        i2, i1 = cluster.bounds(xy, w, 2.5)
        assert i1 == max(t for t, c in counts.items() if c >= 1)
        assert i2 == max((t for t, c in counts.items() if c >= 2), default=0) and i2 <= i1


def test_placement_counts_empty_cells(spark):
    p = spark.createDataFrame([("c", "s1", 0.0, 0.0, 5), ("c", "s2", 1.0, 0.0, 5)], ["cb", "sb", "x", "y", "umi"])
    got = {r["cb"]: r for r in cluster.placement(cluster.clusters(p, 2.0, 3), spark.createDataFrame([("c",), ("d",)], ["cb"])).collect()}
    assert (got["c"]["x"], got["c"]["rmsd"], got["c"]["clusters"]) == (0.5, 0.5, 1)
    assert (got["d"]["umi"], got["d"]["x"]) == (0, None)


def test_bead_eps(spark):
    df = spark.createDataFrame([(f"s{i}-{j}", float(i), float(j)) for i in range(30) for j in range(30)], ["sb", "x", "y"])
    xy = np.array([(i, j) for i in range(30) for j in range(30)], float)
    d = np.sort(np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(2)), axis=1)[:, 8]
    assert abs(cluster.bead_eps(df, k=9) - np.median(d)) < 1e-9


def test_graph(spark):
    e = spark.createDataFrame([(1, 2, 0.1), (2, 3, 0.2), (3, 1, 0.3), (3, 4, 0.4), (10, 11, 0.5)], ["src", "dst", "dist"])
    m = {r["id"]: r for r in graph.node_metrics(graph.undirected(e)).collect()}
    assert m[3]["degree"] == 3 and m[3]["triangles"] == 1 and abs(m[3]["clustering"] - 1 / 3) < 1e-9 and m[4]["clustering"] == 0
    assert dict(rows(graph.components(e))) == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10}
    assert graph.largest_component(e).count() == 4
    assert graph.peeled(e, 2).count() == 0
    assert graph.communities(graph.undirected(e), 4).count() == 6
    xy = spark.createDataFrame([(k, float(k), float(k * k % 7)) for k in range(8)], ["id", "x", "y"])
    turned = xy.select("id", (F.col("y") * 2 + 1).alias("x"), (-F.col("x") * 2).alias("y"))
    assert abs(graph.displacement(xy, turned).first()["procrustes"]) < 1e-9


def test_products_against_plain_sums(spark, monkeypatch):
    """Sparse and full blocks, one shard and many, a column that all rows share, ties, string ids."""
    rng = random.Random(21)
    data = {(f"r{i:03d}", c): rng.choice([0.25, 0.5, 1.0, rng.random()]) for i in range(60) for c in [0, *rng.sample(range(1, 40), 4)] if i % 7 or c}
    df = spark.createDataFrame([(i, c, w) for (i, c), w in data.items()], ["i", "c", "w"])
    ids = sorted({i for i, _ in data})
    expected = []
    for a in ids:
        sims = [(-round(sum(w * data[b, c] for (i, c), w in data.items() if i == a and (b, c) in data), 9), b) for b in ids if any(i == a and (b, c) in data for i, c in data)]
        expected += [(a, b, -s) for s, b in sorted(sims)[:5]]
    for dense, shard in ((1 << 24, None), (0, None), (1 << 24, 7), (0, 7)):
        monkeypatch.setattr(graph, "DENSE", dense)
        got = [(r["src"], r["dst"], round(r["sim"], 9)) for r in graph.product_top(df, "i", "c", "w", 5, shard).collect()]
        assert sorted(got) == sorted(expected)
    assert graph.product_top(df.limit(0), "i", "c", "w", 5).count() == 0


def test_cigar_and_umis(spark):
    ref = spark.createDataFrame([("chr1", "ACGTACGTACGTACGTACGTACGTACGT")], ["rname", "seq"])
    rec = [(0, 0, "chr1", 2, 30, "4M1I3M2D2M", "GTACTGTAGT", [40] * 10, "c1", "u1"), (1, 0, "chr1", 2, 31, "10M", "GTACGTTCGT", [20] * 10, "c1", "u1"), (2, 16, "chr1", 0, 9, "5M", "ACGTA", [40] * 5, "c1", "u1"), (3, 0, "chr1", 0, 9, "5M", "ACGTA", [40] * 5, "c2", "u2"), (4, 16, "chr1", 0, 9, "5M", "ACGTA", [40] * 5, "c2", "u2")]
    df = spark.createDataFrame(rec, "read bigint, flag int, rname string, pos bigint, mapq int, cigar string, seq string, qual array<int>, cb string, ub string")
    t = variants.scrape(df, ref)
    assert rows(t["ins"]) == [(0, 6, "T")] and rows(t["del"]) == [(0, 9, 2)]
    assert [r for r in rows(t["match"]) if r[0] == 0] == [(0, 2, 6), (0, 6, 9), (0, 11, 13)]
    assert (1, 8, ord("A"), ord("T"), 20) in rows(t["snv"])
    out = pipelines.variants_by_umi(df, ref)
    assert rows(out["data"]) == [(1, "c1", "u1", "chr1", 0, 2, 31)]
    assert rows(out["match"]) == [(1, 2, 12), (1, 11, 13)][:0] or rows(out["match"]) == [(1, 2, 13)]


def test_demux(spark):
    triplets = spark.createDataFrame([(1, "a", "b", "c"), (2, "c", "d", "e")], ["group", "t1", "t2", "t3"])
    tags = spark.createDataFrame(list(enumerate("abcdefghij")), ["tag_idx", "tag"])
    one = [("x", k, n) for k, n in enumerate([90, 80, 70, 5, 4, 3, 2, 1, 1, 1])]
    two = [("y", k, n) for k, n in enumerate([90, 80, 70, 65, 60, 3, 2, 1, 0, 0])]
    df = spark.createDataFrame(one + two, ["cell", "tag_idx", "count"])
    got = rows(pipelines.demultiplex(df, triplets, tags))
    assert ("x", 1, True) in got and ("y", 1, True) in got
    assert rows(demux.doublets(df, demux.group_of_tags(triplets, tags))) == [("x", "1-2"), ("y", "1-2")]
    assert [r["n"] for r in demux.group_sizes(spark.createDataFrame([("x", 1, False)], ["cell", "group", "doublet"]), 3).orderBy("group").collect()] == [1, 0, 0]


def test_cells_and_sheets(spark):
    counts = spark.createDataFrame([("MT-1", "a", 5), ("G", "a", 15), ("G", "b", 3)], ["gene", "cell", "n"])
    mols = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1)], ["cell", "umi_type"])
    assert rows(cells.features(counts, mols)) == [("a", 20, 2, 0.25, 0.5)]
    kits = spark.createDataFrame([("TT", "SI-A1", "AAAAAAAA", "CCCCCCCC"), ("ND", "SI-A1", "GGGGGGGG", "TTTTTTTT")], ["kit", "name", "i7", "i5"])
    assert rows(bookkeeping.resolved_indexes(spark.createDataFrame([("SI-A1",)], ["name"]), kits)) == [("SI-A1", "ND", "GGGGGGGG", "TTTTTTTT")]
    text = bookkeeping.sheet(spark.createDataFrame([(1, "s", "AAAAAAAA", "CCCCCCCC"), (1, "t", "ACGTACGTAC", "ACGTACGTAC")], ["lane", "sample", "i7", "i5"]))
    assert "1,s,AAAAAAAAAT,ACCCCCCCCC" in text


def test_geometry(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    pts = spark.createDataFrame([(1.0, 1.0), (4.0, 2.0), (5.0, 5.0), (0.0, 0.0), (None, 1.0)], "x double, y double")
    assert [r[0] for r in pts.select(geometry.in_polygon(F.col("x"), F.col("y"), square)).collect()] == [True, False, False, False, None]
    line = geometry.along_line(pts.dropna(), [(0, 0), (10, 0)]).collect()
    assert abs(line[0]["d"] - 1) < 1e-9 and abs(line[0]["r"] - 0.1) < 1e-6
    grid = geometry.grid_between([np.array([[0, 0], [0, 10.0]]), np.array([[4, 0], [4, 10.0]])], 3, 6)
    got = geometry.to_grid(spark.createDataFrame([(1.0, 2.5), (3.0, 7.5), (5.0, 5.0)], ["x", "y"]), grid).collect()
    assert [(round(r["i"], 6), round(r["r"], 6)) for r in got] == [(0.25, 0.25), (0.75, 0.75), (round(1 + 2**0.5 / 4, 6), 0.5)]
    assert geometry.grid_width(grid) == 4.0 and len(geometry.grid_perimeter(grid)) == 14
    assert len(geometry.grid_lines(grid)) == 9 and geometry.smooth(np.array([[0, 0], [1, 1], [2, 0.0]])).shape == (41, 2)
    assert geometry.grid_greedy(np.array([[0, 0], [0, 9.0]]), np.array([[3, 0], [3, 9.0]]), 4, 5).shape == (20, 4)


def test_largest_component_against_brute_force(spark):
    from beadloom import queries

    def brute(edges):
        root = {n: n for e in edges for n in e}

        def find(n):
            while root[n] != n:
                n = root[n]
            return n

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        of = {n: find(n) for n in root}
        sizes = {r: sum(x == r for x in of.values()) for r in set(of.values())}
        best = min(sizes, key=lambda r: (-sizes[r], r))
        return sorted(e for e in edges if of[e[0]] == best)

    rng = random.Random(13)
    edges = sorted({(a, b) for a, b in ((rng.randrange(120), rng.randrange(120)) for _ in range(60)) if a != b})
    small = spark.createDataFrame(edges, "src bigint, dst bigint")
    assert sorted(map(tuple, graph.largest_component(small).collect())) == brute(edges)
    sf = "/root/testdata/sf0.001"
    every = [tuple(r) for r in queries._edges(spark, sf).select("src", "dst").collect()]
    assert sorted(map(tuple, queries.queries()["largest_component"](spark, sf).collect())) == brute(every)


def test_zero_fill_counts_all_rows(spark):
    from beadloom import queries

    sf = "/root/testdata/sf0.01"
    got = {r["group"]: r["n"] for r in queries.queries()["group_zero_fill"](spark, sf).collect()}
    assert sum(got.values()) == spark.read.parquet(f"{sf}/customer.parquet").count()
    assert sorted(got) == list(range(1, 145)) and [g for g, n in got.items() if n == 0 and g <= 120] == [] and all(got[g] == 0 for g in range(121, 145))


def plain_peel(edges, least):
    while True:
        out = {}
        for a, _ in edges:
            out[a] = out.get(a, 0) + 1
        left = [(a, b) for a, b in edges if out[a] >= least and out.get(b, 0) >= least]
        if len(left) == len(edges):
            return left
        edges = left


def test_peeling_against_a_plain_version(spark):
    from beadloom import queries

    rng = random.Random(22)
    edges = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(170)})
    df = spark.createDataFrame([(a, b, 0.5) for a, b in edges], "src bigint, dst bigint, dist double")
    for least in (1, 2, 3, 9):
        history = []
        got = sorted((r["src"], r["dst"]) for r in graph.peeled(df, least, history).collect())
        assert got == plain_peel(edges, least) and all(n > 0 for _, n in history)
    for sf, least in (("sf0.001", 1), ("sf0.01", 5)):
        every = [(r["src"], r["dst"]) for r in queries._edges(spark, f"/root/testdata/{sf}").collect()]
        got = sorted((r["src"], r["dst"]) for r in queries.queries()["peel_fixpoint"](spark, f"/root/testdata/{sf}").collect())
        assert got == sorted(plain_peel(every, least)) and 0 < len(got) < len(every)


def test_grid_places_against_a_plain_version():
    """A bent grid: every point by itself, after the rules in words."""
    rng = np.random.default_rng(23)
    a = np.array([[0, 0], [1, 4], [0, 8], [1, 12.0]])
    grid = geometry.grid_between([a, a + [3, 0.5], a + [6, -0.5]], 5, 9)
    g, width = geometry._square(grid), geometry.grid_width(grid)
    assert abs(width - np.hypot(*(g[-1] - g[0]).T).mean()) < 1e-12
    xy = rng.uniform([-0.5, 1.5], [8, 10.5], (300, 2))
    i, r = geometry.grid_places(xy[:, 0], xy[:, 1], grid)
    line = lambda p, u, v: abs((v[0] - u[0]) * (p[1] - u[1]) - (v[1] - u[1]) * (p[0] - u[0])) / np.hypot(*(v - u))
    found = 0
    for k, p in enumerate(xy):
        cells = []
        for ci in range(4):
            for cr in range(8):
                q = [g[ci, cr], g[ci + 1, cr], g[ci + 1, cr + 1], g[ci, cr + 1]]
                cross = [(v[0] - u[0]) * (p[1] - u[1]) - (v[1] - u[1]) * (p[0] - u[0]) for u, v in zip(q, q[1:] + q[:1])]
                if all(c > 0 for c in cross) or all(c < 0 for c in cross):
                    cells.append((ci, cr))
        if cells:
            ci, cr = cells[0]
            d1, d2 = line(p, g[ci, cr], g[ci + 1, cr]), line(p, g[ci, cr + 1], g[ci + 1, cr + 1])
            e1, e2 = line(p, g[ci, cr], g[ci, cr + 1]), line(p, g[ci + 1, cr], g[ci + 1, cr + 1])
            expected = ((ci * e2 + (ci + 1) * e1) / (e1 + e2) / 4, (cr * d2 + (cr + 1) * d1) / (d1 + d2) / 8)
            found += 1
        else:
            side = min((0, 4), key=lambda c: min(np.hypot(*(g[c] - p).T)))
            near = np.argsort(np.hypot(*(g[side] - p).T), kind="stable")[:2]
            u, v = g[side][near]
            foot = min(max(((p - u) @ (v - u)) / ((v - u) @ (v - u)), 0), 1)
            d = np.hypot(*(u - p)) / width
            expected = (-d if side == 0 else 1 + d, (near[0] * (1 - foot) + near[1] * foot) / 8)
        assert abs(i[k] - expected[0]) < 1e-9 and abs(r[k] - expected[1]) < 1e-9, (k, p)
    assert 50 < found < 290
    with np.testing.assert_raises(ValueError):
        geometry.grid_places(np.array([3.0]), np.array([30.0]), grid)


def test_expansion_switch_and_indexes(spark):
    df = spark.createDataFrame([("NAN",), ("ACG",), ("CNA",), (None,)], "s string")
    got = [r[0] for r in df.select(dna.expand_n(F.col("s"))).collect()]
    assert sorted(got[0]) == sorted(x + "A" + y for x in "ACGT" for y in "ACGT") and got[1:] == [["ACG"], ["CAA", "CCA", "CGA", "CTA"], None]
    assert reads.read_switch([(5, 2), (9, 1)]) and not reads.read_switch([(1, 2)])
    with np.testing.assert_raises(ValueError):
        reads.read_switch([(5, 2), (1, 9)])
    names = spark.createDataFrame([("D701",), ("N712",), ("ND701ND502",)], ["name"])
    assert rows(bookkeeping.single_indexes(names).dropna()) == [("D701", "D701", "CGAGATCT"), ("N712", "N712", "CGAGATCT")]


def test_stabbing_against_brute_force(spark):
    rng = random.Random(24)
    spans = [(rng.choice("ab"), s, s + rng.randint(-2, 40)) for s in (rng.randrange(60) for _ in range(80))]
    pts = [(rng.choice("abc"), rng.randrange(-5, 110)) for _ in range(120)]
    i, p = spark.createDataFrame(spans, ["k", "start", "end"]), spark.createDataFrame(pts, ["k", "pos"])
    for b in (None, 0, 7):
        covers = lambda k, x: sum(k == q and ((s <= x < e) if b is None else (s + b < x and x + b < e)) for q, s, e in spans)
        assert rows(stats.stabbing_counts(p, i, "k", "pos", buffer=b)) == sorted((k, x, covers(k, x)) for k, x in pts)


def test_thinning_has_the_right_mean_and_variance(spark):
    for n in (20, 1000):
        got = [r["reads"] for r in reads.thin(spark.range(4000).select("id", F.lit(n).cast("bigint").alias("reads")), 0.3, 5).collect()]
        assert abs(np.mean(got) - 0.3 * n) < 0.02 * 0.3 * n + 0.2 and 0.8 < np.var(got) / (0.21 * n) < 1.2


def test_substitutions_against_a_plain_walk(spark, monkeypatch):
    rng = random.Random(26)
    ref = {n: mer(rng, 300) for n in ("chr1", "chr2")}
    records, expected = [], []
    for k in range(60):
        name, pos, a, gap, b = rng.choice(list(ref)), rng.randrange(200), rng.randint(1, 40), rng.randint(1, 5), rng.randint(1, 40)
        seq = "".join(c if rng.random() < 0.9 else rng.choice("ACGTN") for c in ref[name][pos : pos + a] + ref[name][pos + a + gap : pos + a + gap + b])
        records.append((k, name, pos, f"{a}M{gap}D{b}M", seq, list(range(len(seq)))))
        for q, c in enumerate(seq):
            r = pos + q + (gap if q >= a else 0)
            if ref[name][r] != c:
                expected.append((k, r, ord(ref[name][r]), ord(c), q))
    df = spark.createDataFrame(records, "read bigint, rname string, pos bigint, cigar string, seq string, qual array<int>")
    for size in (65_536, 16):
        monkeypatch.setattr(variants, "BIN", size)
        assert rows(variants.scrape(df, spark.createDataFrame(list(ref.items()), ["rname", "seq"]))["snv"]) == sorted(expected)
