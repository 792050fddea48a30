import random

import pytest
from pyspark.sql import functions as F

from beadloom.functions import alignment, dna, text


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], names).select(column).first()[0]


def test_packing_round_trip(spark):
    rng = random.Random(1)
    seqs = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (1, 9, 12, 15, 17) for _ in range(20)]
    df = spark.createDataFrame([(s, len(s)) for s in seqs], "s string, n int")
    for n in (1, 9, 12, 15, 17):
        assert df.filter(f"n = {n}").filter(dna.decode(dna.encode(F.col("s")), n) != F.col("s")).count() == 0
    assert one(spark, dna.encode(F.col("s")), s="CA") == 1
    assert one(spark, dna.encode(F.col("s")), s="AC") == 4
    assert one(spark, dna.encode(F.col("s")), s="N") == one(spark, dna.encode(F.col("s")), s="G") == 3


def test_bead_layouts(spark):
    read = "".join(chr(65 + k % 26) for k in range(60))
    for bead, (sb, up, umi) in {"V10": (read[0:8] + read[26:33], read[8:26], read[33:42]), "V15": (read[0:15], read[15:25], read[25:34]), "V16": (read[0:17], read[17:27], read[27:36]), "V17": (read[0:9] + read[27:35], read[9:27], read[35:44]), "V19": (read[0:9] + read[19:27], read[9:19], read[27:36])}.items():
        got = spark.createDataFrame([(read,)], ["r"]).select(*(c.alias(k) for k, c in dna.slice_bead(F.col("r"), bead).items())).first()
        assert (got["sb"], got["up"], got["umi"]) == (sb, up, umi)
        assert len(dna.BEADS[bead].site) == dna.BEADS[bead].up[1]


def test_complexity(spark):
    for s, most, run in (("AAAC", 3, 3), ("", 0, 0), ("ACGTN", 1, 1), ("GGTTTG", 3, 3)):
        assert one(spark, dna.commonest_base(F.col("s")), s=s) == most
        assert one(spark, dna.longest_run(F.col("s")), s=s) == run


def test_neighbours(spark):
    df = spark.createDataFrame([("ACG",)], ["s"])
    got = {(r["neighbour"], r["pos"]) for r in dna.neighbours(df, "s", 3).collect()}
    assert got == {("ACG"[:p] + b + "ACG"[p + 1 :], p + 1) for p in range(3) for b in "ACGTN" if b != "ACG"[p]}


def test_small_ones(spark):
    assert one(spark, dna.remap(F.col("s")), s="AAAAAAATCAAAAAAA") == "AAAAAAAAGAAAAAAA"
    assert one(spark, dna.strip_suffix(F.col("s")), s="ACG-12") == "ACG"
    assert one(spark, dna.half_even(F.col("x")), x=2.5) == 2
    assert one(spark, text.trim_puck_name(F.col("s")), s="Puck_230101_17.csv") == "230101\n17"
    assert one(spark, text.well(F.col("g")), g=13) == "B1"
    assert one(spark, text.tag_sequence(F.col("s")), s="MS-ACGTACGTACGT") == "ACGTACGTACGT"
    assert one(spark, text.percent(F.col("x")), x=0.12345) == "12.35%"
    assert one(spark, text.bead_diameter(F.col("n")), n=2_000_000) == 20_000
    with pytest.raises(Exception, match="too few beads"):
        one(spark, text.bead_diameter(F.col("n")), n=10)
    assert [one(spark, alignment.strand(F.col("f")), f=f) for f in (0, 16, 128, 144)] == [0, 1, 1, 0]
    assert one(spark, alignment.mean_rounded(F.col("a"), F.col("n")), a=5, n=2) == 3
