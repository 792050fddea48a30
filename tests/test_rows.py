"""Results against brute force, and the greatest number of rows that any step of a plan makes."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from beadloom import queries
from beadloom.operators import graph, reads, stats


def most_rows(df):
    """Runs df; (rows, the greatest number of rows out of any operator of the plan that ran)."""
    rows = df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            if plan.metrics().contains("numOutputRows"):
                found = max(found, plan.metrics().apply("numOutputRows").value())
            todo += [plan.children().apply(k) for k in range(plan.children().size())]
    return rows, found


def brute_constraint(pairs):
    w = {}
    for a, b, x in pairs:
        w.setdefault(a, {})[b] = x
        w.setdefault(b, {})[a] = x
    p = {i: {j: x / sum(v.values()) for j, x in v.items()} for i, v in w.items()}
    return {i: sum((p[i][j] + sum(p[i][q] * p[q].get(j, 0) for q in p[i] if q != j)) ** 2 for j in p[i]) for i in p}


@pytest.mark.parametrize(("heavy", "closing"), [(1 << 17, 1 << 20), (3, 1 << 20), (0, 0)])
def test_constraint_against_brute_force(spark, monkeypatch, heavy, closing):
    monkeypatch.setattr(graph, "HEAVY", heavy)
    monkeypatch.setattr(graph, "CLOSING", closing)
    rng = random.Random(heavy)
    pairs = [(a, b, rng.randint(1, 20) / 20) for a in range(30) for b in range(a + 1, 30) if rng.random() < (0.9 if a < 3 else 0.2)] + [(0, 99, 0.5)]
    got = dict(graph.constraint(spark.createDataFrame(pairs, "src bigint, dst bigint, w double")).collect())
    want = brute_constraint(pairs)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_constraint_opens_no_pairs_of_a_hub(spark):
    leaves = 1000
    pairs = spark.range(1, leaves + 1).select(F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("w"))
    pairs = pairs.union(spark.createDataFrame([(1, 2, 1.0)], "src bigint, dst bigint, w double"))
    rows, most = most_rows(graph.constraint(pairs))
    assert len(rows) == leaves + 1
    assert most <= 4 * leaves


def test_constraint_of_weightless_nodes(spark):
    got = dict(graph.constraint(spark.createDataFrame([(1, 2, 0.0), (3, 4, 1.0)], "src bigint, dst bigint, w double")).collect())
    assert got == {1: None, 2: None, 3: 1.0, 4: 1.0}


def test_hit_rates_of_halves_equal_those_of_barcodes(spark):
    site, rng = "TCTTCAGCGTTCCCGAGA", random.Random(5)
    word = lambda n: "".join(rng.choice("AC") for _ in range(n))
    firsts = [(k % 3, k % 2, word(8)) for k in range(60)] + [(7, 0, "GGGGGGGG"), (8, 0, word(8))]
    seconds = [(k % 3, k % 2, word(6)) for k in range(30)] + [(7, 0, "TTTTTT"), (9, 0, word(6))]
    seqs = [(word(8) + (site if k % 4 else "A" * 18) + word(7),) for k in range(3000)]
    r = spark.createDataFrame(seqs, "r2 string")
    f, s = spark.createDataFrame(firsts, "puck int, set int, first string"), spark.createDataFrame(seconds, "puck int, set int, second string")
    pucks = f.join(s, ["puck", "set"]).select("puck", F.concat("first", "second").alias("sb"))
    want = sorted(reads.puck_hit_rates(r, pucks).collect())
    assert sorted(reads.puck_hit_rates_of_halves(r, f, s).collect()) == want
    assert dict(want)[7] == 0 and len(want) == 4 and dict(want)[0] > 0


def test_hit_rates_query_makes_no_pairs_of_halves(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"COPY (SELECT r AS p_partkey FROM range(9000) t(r)) TO '{tmp_path}/part.parquet'")
    con.sql(f"COPY (SELECT r AS s_suppkey FROM range(3000) t(r)) TO '{tmp_path}/supplier.parquet'")
    con.sql(f"COPY (SELECT r AS l_orderkey, r * 7 % 9000 AS l_partkey, r % 3000 AS l_suppkey FROM range(9000) t(r)) TO '{tmp_path}/lineitem.parquet'")
    for t in ("part", "supplier", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    rows, most = most_rows(queries.queries()["puck_hit_rates"](spark, str(tmp_path)))
    want = con.sql(queries.oracle_sql()["puck_hit_rates"]).fetchall()
    assert sorted(tuple(r) for r in rows) == sorted(want)
    assert most <= 9000


def test_interval_union_of_repeated_intervals(spark):
    rng = random.Random(9)
    some = [(k, a := rng.randint(0, 200), a + rng.randint(1, 20)) for k in range(40) for _ in range(8)]
    want = []
    for k, a, b in sorted(set(some)):
        if want and want[-1][0] == k and a <= want[-1][2]:
            want[-1] = (k, want[-1][1], max(b, want[-1][2]))
        else:
            want.append((k, a, b))
    repeated = [x for x in some for _ in range(rng.randint(1, 10))]
    rng.shuffle(repeated)
    got = stats.interval_union(spark.createDataFrame(repeated, "umi bigint, start bigint, end bigint").repartition(7), "umi")
    assert sorted(map(tuple, got.collect())) == want
