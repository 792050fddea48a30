"""Sequencing files as tables: paired FASTQ, BAM and SAM, FASTA. Python data sources, one partition a file or pair."""

from __future__ import annotations

import gzip
import io
import re
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows of an Arrow batch.
BATCH = 50_000


def _filesystem(uri: str):
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _opened(uri: str):
    system, path = _filesystem(uri)
    raw = system.open_input_stream(path, compression=None)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if uri.endswith(".gz") else raw, 1 << 20)


def list_pairs(directory: str, pattern: str = ".*") -> list[tuple[str, str]]:
    """(R1, R2) paths of the directory's .fastq.gz files that match; an error where one lacks its mate."""
    import pyarrow.fs as fs

    system, path = _filesystem(directory)
    names = sorted(i.path for i in system.get_file_info(fs.FileSelector(path)) if i.is_file and i.base_name.endswith(".fastq.gz") and re.search(pattern, i.base_name))
    r1, r2 = ([n for n in names if mark in n] for mark in ("_R1_001", "_R2_001"))
    if [n.replace("_R1_001", "") for n in r1] != [n.replace("_R2_001", "") for n in r2] or not r1:
        raise ValueError("every R1 file needs its R2 file, and there must be one pair at least")
    head = directory.split("://")[0] + "://" if "://" in directory else ""
    return [(head + a, head + b) for a, b in zip(r1, r2, strict=True)]


class _Pair(InputPartition):
    def __init__(self, number: int, r1: str, r2: str, limit: int):
        super().__init__((number, r1, r2, limit))


class FastqPairs(DataSource):
    """(pair_id, read_no, r1, r2) of a directory of paired FASTQ files; the shorter file of a pair ends it.

    Options: path, pattern (a regular expression), limit (records of each pair).
    """

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> str:
        return "pair_id int, read_no bigint, r1 string, r2 string"

    def reader(self, schema) -> DataSourceReader:
        return _FastqReader(self.options)


class _FastqReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[_Pair]:
        pairs = list_pairs(self.options["path"], self.options.get("pattern", ".*"))
        return [_Pair(k, a, b, int(self.options.get("limit", 0))) for k, (a, b) in enumerate(pairs)]

    def read(self, partition) -> Iterator:
        import pyarrow as pa

        number, r1, r2, limit = partition.value
        with _opened(r1) as a, _opened(r2) as b:
            rows: list[tuple[bytes, bytes]] = []
            done = 0

            def batch() -> pa.RecordBatch:
                n = len(rows)
                cols = [pa.array([number] * n, pa.int32()), pa.array(range(done + 1, done + n + 1), pa.int64()), pa.array([x.decode() for x, _ in rows]), pa.array([y.decode() for _, y in rows])]
                return pa.RecordBatch.from_arrays(cols, names=["pair_id", "read_no", "r1", "r2"])

            for k, (x, y) in enumerate(zip(a, b)):
                if k % 4 == 1:
                    rows.append((x.rstrip(), y.rstrip()))
                    if limit and done + len(rows) >= limit:
                        break
                    if len(rows) == BATCH:
                        yield batch()
                        done, rows = done + BATCH, []
            if rows:
                yield batch()


#: Letters of BAM's packed bases and of its CIGAR operations.
_BASES, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_TAG_SIZE = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_TAG_CODE = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def _bgzf(raw) -> Iterator[bytes]:
    """The blocks of a BGZF stream, which are gzip members one after another."""
    engine = zlib.decompressobj(31)
    while chunk := raw.read(1 << 16):
        while chunk:
            yield engine.decompress(chunk)
            chunk = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def _tags(data: bytes) -> dict[str, str]:
    out, at = {}, 0
    while at < len(data):
        tag, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            out[tag], at = data[at:end].decode(), end + 1
        elif kind == "B":
            sub, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = [struct.unpack_from(_TAG_CODE[sub], data, at + 5 + k * _TAG_SIZE[sub])[0] for k in range(n)]
            out[tag], at = ",".join(map(str, values)), at + 5 + n * _TAG_SIZE[sub]
        else:
            out[tag] = chr(data[at]) if kind == "A" else str(struct.unpack_from(_TAG_CODE[kind], data, at)[0])
            at += _TAG_SIZE[kind]
    return out


class BamRecords(DataSource):
    """Records of BAM files (option path: files separated by commas), numbered from 0 in each file."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return "file string, read bigint, name string, flag int, rname string, pos bigint, mapq int, cigar string, seq string, qual array<int>, tags map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _BamReader(self.options)


class _BamReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.options["path"].split(",")]

    def read(self, partition) -> Iterator[tuple]:
        system, path = _filesystem(partition.value)
        with system.open_input_stream(path, compression=None) as raw:
            blocks, held = _bgzf(raw), b""

            def take(n: int) -> bytes:
                nonlocal held
                parts, have = [held], len(held)
                while have < n:
                    block = next(blocks, None)
                    if block is None:
                        break
                    parts.append(block)
                    have += len(block)
                data = b"".join(parts)
                held = data[n:]
                return data[:n]

            if take(4) != b"BAM\x01":
                raise ValueError(f"{partition.value} is no BAM file")
            take(struct.unpack("<i", take(4))[0])
            names = []
            for _ in range(struct.unpack("<i", take(4))[0]):
                names.append(take(struct.unpack("<i", take(4))[0])[:-1].decode())
                take(4)
            number = 0
            while len(size := take(4)) == 4:
                r = take(struct.unpack("<i", size)[0])
                ref, pos, l_name, mapq, _, n_ops, flag, l_seq = struct.unpack_from("<iiBBHHHi", r)
                at = 32
                name, at = r[at : at + l_name - 1].decode(), at + l_name
                cigar, at = "".join(f"{v >> 4}{_OPS[v & 15]}" for v in struct.unpack_from(f"<{n_ops}I", r, at)), at + 4 * n_ops
                packed, at = r[at : at + (l_seq + 1) // 2], at + (l_seq + 1) // 2
                seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:l_seq]
                qual, at = list(r[at : at + l_seq]), at + l_seq
                yield partition.value, number, name, flag, names[ref] if ref >= 0 else None, pos, mapq, cigar, seq, qual, _tags(r[at:])
                number += 1


def register(spark: SparkSession) -> None:
    """Makes the formats fastq_pairs and bam known to the session."""
    spark.dataSource.register(FastqPairs)
    spark.dataSource.register(BamRecords)


def read_fastq_pairs(spark: SparkSession, path: str, pattern: str = ".*", limit: int = 0) -> DataFrame:
    register(spark)
    return spark.read.format("fastq_pairs").option("pattern", pattern).option("limit", limit).load(path)


def read_bam(spark: SparkSession, *paths: str) -> DataFrame:
    register(spark)
    return spark.read.format("bam").load(",".join(paths))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """The columns of `bam` but read, from SAM text."""
    f = F.split("value", "\t")
    tag = F.transform(F.slice(f, 12, 10_000), lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substr(t, F.lit(6)).alias("value")))
    qual = F.transform(F.split(f[10], ""), lambda c: F.ascii(c) - 33)
    lines = spark.read.text(path).filter(~F.startswith("value", F.lit("@")) & (F.size(f) >= 11))
    cols = {"name": f[0], "flag": f[1].cast("int"), "rname": F.nullif(f[2], F.lit("*")), "pos": f[3].cast("bigint") - 1, "mapq": f[4].cast("int"), "cigar": F.regexp_replace(f[5], r"^\*$", ""), "seq": f[9], "qual": qual, "tags": F.map_from_entries(tag)}
    return lines.select(F.input_file_name().alias("file"), *(c.alias(k) for k, c in cols.items()))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(rname, seq) of FASTA files, wrapped or not: the file is read in pieces that begin at '>'."""
    pieces = spark.read.option("lineSep", ">").text(path).filter(F.length(F.trim("value")) > 0)
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.substr("value", F.length(head) + 2), r"\s", "")
    return pieces.select(F.split(F.trim(head), r"\s")[0].alias("rname"), body.alias("seq"))


def unwrapped(fasta: DataFrame) -> DataFrame:
    """(value): two lines a sequence; an error at characters that aren't printable ASCII."""
    fine = F.when(F.col("seq").rlike(r"^[\x21-\x7E]+$"), True).otherwise(F.raise_error(F.lit("a sequence holds other than printable ASCII"))).cast("boolean")
    return fasta.filter(fine).select(F.concat_ws("\n", F.concat(F.lit(">"), "rname"), "seq").alias("value"))


def binned_reference(fasta: DataFrame, size: int = 65_536, overlap: int = 1_024) -> DataFrame:
    """(rname, bin, start, seq): reference sequences in bounded rows, each with some of the next."""
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(size))).alias("start")
    return fasta.select("rname", "seq", starts).select("rname", (F.col("start") / size).cast("int").alias("bin"), "start", F.substr("seq", F.col("start") + 1, F.lit(size + overlap)).alias("seq"))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """df with read, 0-based within its file in the given order."""
    return df.withColumn("read", (F.row_number().over(Window.partitionBy("file").orderBy(*order)) - 1).cast("bigint"))
