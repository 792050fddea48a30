import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from beadloom.functions import dna
from beadloom.plans import pipelines
from beadloom.sources import sequencing, tables
from beadloom.streaming import counts


def fastq(path, seqs):
    with gzip.open(path, "wt") as f:
        for k, s in enumerate(seqs):
            f.write(f"@r{k}\n{s}\n+\n{'I' * len(s)}\n")


def test_fastq_pairs(spark, tmp_path):
    fastq(tmp_path / "a_R1_001.fastq.gz", ["AC", "GT", "TT"])
    fastq(tmp_path / "a_R2_001.fastq.gz", ["CC", "GG"])
    fastq(tmp_path / "b_R1_001.fastq.gz", ["A"])
    fastq(tmp_path / "b_R2_001.fastq.gz", ["C"])
    got = sorted(map(tuple, sequencing.read_fastq_pairs(spark, str(tmp_path)).collect()))
    assert got == [(0, 1, "AC", "CC"), (0, 2, "GT", "GG"), (1, 1, "A", "C")]
    assert sequencing.read_fastq_pairs(spark, str(tmp_path), "^a_", 1).count() == 1
    fastq(tmp_path / "c_R1_001.fastq.gz", ["A"])
    with pytest.raises(ValueError, match="R2"):
        sequencing.list_pairs(str(tmp_path))


def bgzf(data):
    out = b""
    for k in range(0, len(data), 50):
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(data[k : k + 50]) + c.flush()
        out += b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<HBBHH", 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data[k : k + 50]), len(data[k : k + 50]))
    return out


def record(ref, pos, flag, cigar, seq, tags):
    ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
    codes = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0]
    packed = bytes(codes[k] << 4 | codes[k + 1] for k in range(0, len(seq), 2))
    body = struct.pack("<iiBBHHHiiii", ref, pos, 3, 60, 0, len(cigar), flag, len(seq), -1, -1, 0) + b"r1\0" + ops + packed + bytes([30] * len(seq)) + tags
    return struct.pack("<i", len(body)) + body


def test_bam_and_sam(spark, tmp_path):
    tags = b"CBZcell\0" + b"xfC\x19" + b"tsi" + struct.pack("<i", -7) + b"REAE"
    data = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    data += record(0, 4, 16, [(3, "M"), (1, "I"), (2, "M")], "ACGTNA", tags) + record(-1, -1, 4, [], "AC", b"")
    path = tmp_path / "x.bam"
    path.write_bytes(bgzf(data))
    a, b = sequencing.read_bam(spark, str(path)).orderBy("read").collect()
    assert (a["rname"], a["pos"], a["flag"], a["cigar"], a["seq"], a["qual"]) == ("chr1", 4, 16, "3M1I2M", "ACGTNA", [30] * 6)
    assert a["tags"] == {"CB": "cell", "xf": "25", "ts": "-7", "RE": "E"} and (b["rname"], b["cigar"], b["tags"]) == (None, "", {})
    (tmp_path / "x.sam").write_text("@SQ\tSN:chr1\tLN:9\nr1\t16\tchr1\t5\t60\t3M1I2M\t*\t0\t0\tACGTNA\t??????\tCB:Z:cell\txf:i:25\n")
    s = sequencing.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (s["rname"], s["pos"], s["cigar"], s["qual"], s["tags"]) == ("chr1", 4, "3M1I2M", [30] * 6, {"CB": "cell", "xf": "25"})


def test_fasta(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">chr1 first\nACGT\nAC\n>chr2\nTTTT\n")
    fa = sequencing.read_fasta(spark, str(tmp_path / "r.fa"))
    assert sorted(map(tuple, fa.collect())) == [("chr1", "ACGTAC"), ("chr2", "TTTT")]
    assert sorted(r[0] for r in sequencing.unwrapped(fa).collect()) == [">chr1\nACGTAC", ">chr2\nTTTT"]
    got = sorted(map(tuple, sequencing.binned_reference(fa, 4, 1).collect()))
    assert got == [("chr1", 0, 0, "ACGTA"), ("chr1", 1, 4, "AC"), ("chr2", 0, 0, "TTTT")]


def test_tables(spark, tmp_path):
    d = tmp_path / "pucks"
    d.mkdir()
    (d / "b.csv").write_text("CC,3,4\n")
    (d / "a.csv").write_text("AA,1,2\nAC,5,6\n")
    assert sorted(map(tuple, tables.read_pucks(spark, str(d)).collect())) == [("AA", 1.0, 2.0, 1), ("AC", 5.0, 6.0, 1), ("CC", 3.0, 4.0, 2)]
    (tmp_path / "m.mtx").write_text("%%MatrixMarket\n%\n2 2 3\n1 1 5\n2 2 3\n1 2 7\n")
    (tmp_path / "f.tsv").write_text("g1\tx\ng2\ty\n")
    (tmp_path / "b.tsv").write_text("c1\nc2\n")
    m = tables.read_matrix_market(spark, *(str(tmp_path / n) for n in ("m.mtx", "f.tsv", "b.tsv")))
    assert sorted(map(tuple, m.collect())) == [("g1", "c1", 5), ("g1", "c2", 7), ("g2", "c2", 3)]
    tables.write_metrics(spark.createDataFrame([("b", 2), ("a", 1)], ["key", "value"]), str(tmp_path / "metrics"))
    assert [tuple(r) for r in tables.read_metrics(spark, str(tmp_path / "metrics")).collect()] == [("a", "1"), ("b", "2")]
    e = spark.createDataFrame([(1, 2, 9)], "sb1_index bigint, sb2_index bigint, umi bigint")
    tables.write_matrix(e, str(tmp_path / "mat"))
    assert tuple(tables.read_diffusion(spark, str(tmp_path / "mat")).first()) == (1, 0, 9)
    csc = tables.from_csc(spark.createDataFrame([(0, 5, 1), (1, 6, 2), (2, 7, 3)], ["k", "row", "value"]), spark.createDataFrame([(0, 0), (1, 2), (2, 2), (3, 3)], ["col", "start"]))
    assert sorted(map(tuple, csc.collect())) == [(5, 0, 1), (6, 0, 2), (7, 2, 3)]
    tables.write_tables({"e": e}, str(tmp_path / "t"))
    assert tables.read_tables(spark, str(tmp_path / "t"), ["e"])["e"].count() == 1


def test_counts_and_placement_end_to_end(spark):
    site = dna.UP_LONG
    beads = [("AAACCCGGGTTTACGTA", 0.0, 0.0), ("CCCAAATTTGGGTACGT", 5.0, 0.0), ("GATTACAGATTACAGAT", 900.0, 900.0)]
    cells = ["ACGTACGATCGTACGT", "TGCATGCGTGCATGCA"]
    pairs = []
    for k in range(60):
        sb = beads[k % 2][0]
        umi = "".join("ACGT"[(k >> 2 * i) & 3] for i in range(6)) + "ACGTAC"
        pairs.append((cells[0] + umi, sb[:9] + site + sb[9:] + "ACGTACGTA"))
        pairs.append((cells[1] + umi, beads[2][0][:9] + site + beads[2][0][9:] + "ACGTACGTA"))
    puck = spark.createDataFrame(beads, ["sb", "x", "y"])
    out = pipelines.spatial_count(spark.createDataFrame(pairs, ["r1", "r2"]), puck)
    assert out["matrix"].agg(F.sum("reads")).first()[0] == 120
    placed = pipelines.positioning(out["matrix"], puck, spark.createDataFrame([(c + "-1",) for c in cells], ["cb"]), 17, eps=20.0)
    got = {r["cb"]: r for r in placed["coords"].collect()}
    assert abs(got[cells[0]]["x"] - 2.5) < 1e-9 and got[cells[1]]["x"] == 900.0
    assert placed["coords2"].count() == 2


def test_streaming_counts(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(k % 2, "u")] * 5, "cb bigint, umi string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = counts.to_memory(counts.read_counts(counts.stream_parquet(spark, str(tmp_path / "in"), "cb bigint, umi string", 1), "cb"), "running_counts")
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("running_counts").collect())) == [(0, 10), (1, 5)]
