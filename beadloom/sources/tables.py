"""Count matrices, pucks, whitelists and their sinks, as text or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pucks(spark: SparkSession, path: str, most: int = 3) -> DataFrame:
    """(sb, x, y, puck_index) of headerless CSVs, at most `most` files, numbered from 1 by name."""
    raw = spark.read.schema("sb string, x double, y double").csv(path).withColumn("_f", F.col("_metadata.file_path"))
    files = sorted(r["_f"] for r in raw.select("_f").distinct().limit(most + 1).collect())
    if len(files) > most:
        raise ValueError(f"more than {most} pucks")
    return raw.withColumn("puck_index", F.array_position(F.array(*map(F.lit, files)), F.col("_f")).cast("int")).drop("_f")


def read_matrix_market(spark: SparkSession, matrix: str, features: str, barcodes: str) -> DataFrame:
    """(gene, cell, n) of a MatrixMarket file with its feature and barcode lists (tab separated, first column)."""
    lines = spark.read.text(matrix).filter(~F.startswith("value", F.lit("%")))
    height, width, stored = map(int, lines.first()[0].split())
    v = F.split(F.trim("value"), r"\s+")
    entries = lines.select(*(v[k].cast("bigint").alias(c) for k, c in enumerate("ijn"))).groupBy("i", "j").agg(F.sum("n").alias("n"))
    # the line of sizes reads as one more entry of the last row and column
    last = (F.col("i") == height) & (F.col("j") == width)
    entries = entries.withColumn("n", F.when(last, F.col("n") - stored).otherwise(F.col("n"))).filter("n <> 0")
    return entries.join(read_list(spark, features, "gene").withColumnRenamed("line", "i"), "i").join(read_list(spark, barcodes, "cell").withColumnRenamed("line", "j"), "j").select("gene", "cell", "n")


def read_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(line, column): the first field of each line with its number from 1. A whole file is one row while it is cut."""
    text = spark.read.text(path, wholetext=True)
    lines = F.filter(F.split("value", r"\r?\n"), lambda s: s != "")
    return text.select(F.posexplode(lines).alias("_p", "_v")).select((F.col("_p") + 1).cast("bigint").alias("line"), F.substring_index("_v", "\t", 1).alias(column))


def read_whitelist(spark: SparkSession, path: str, column: str = "cb") -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias(column)).filter(F.length(column) > 0)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a metrics CSV: long as it is, a single wide row transposed."""
    long = spark.read.schema("key string, value string").csv(path)
    head = spark.read.csv(path, header=True)
    if len(head.columns) > 2:
        return head.limit(1).unpivot([], head.columns, "key", "value")
    return long


def read_diffusion(spark: SparkSession, path: str, bead: int = 2) -> DataFrame:
    """(i, c, n), 0-based, of a matrix CSV (sb1_index, sb2_index, umi); rows are the beads of kind `bead`."""
    m = spark.read.schema("sb1_index bigint, sb2_index bigint, umi bigint").csv(path, header=True)
    a, b = ("sb1_index", "sb2_index") if bead == 1 else ("sb2_index", "sb1_index")
    return m.select((F.col(a) - 1).alias("i"), (F.col(b) - 1).alias("c"), F.col("umi").alias("n"))


def bead_umis(edges: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """(i, umi) of beads: from a table of totals, or else summed from the matrix."""
    return totals.select("i", "umi") if totals is not None else edges.groupBy("i").agg(F.sum("n").alias("umi"))


def decoded_molecules(molecules: DataFrame, barcodes: DataFrame, features: DataFrame) -> DataFrame:
    """Molecules (barcode_idx, feature_idx, ...), 0-based, with cell ('-1' appended) and feature by name."""
    b = barcodes.select((F.col("line") - 1).alias("barcode_idx"), F.concat("cell", F.lit("-1")).alias("cell"))
    f = features.select((F.col("line") - 1).alias("feature_idx"), "feature")
    return molecules.join(b, "barcode_idx").join(f, "feature_idx").drop("barcode_idx", "feature_idx")


def from_csc(data: DataFrame, indptr: DataFrame) -> DataFrame:
    """(row, col, value) of a compressed matrix: data (k, row, value), indptr (col, start), both 0-based."""
    from pyspark.sql import Window

    ends = indptr.withColumn("end", F.lead("start").over(Window.orderBy("col"))).filter("end > start")
    slots = ends.select("col", F.explode(F.sequence("start", F.col("end") - 1)).alias("k"))
    return data.join(slots, "k").select("row", "col", "value")


def spatial_sums(metrics: DataFrame) -> DataFrame:
    """One row: reads too short, without identifier, site and bead, from (key, value) counters."""
    total = lambda *keys: F.coalesce(F.sum(F.when(F.col("key").isin(*keys), F.col("value"))), F.lit(0))
    return metrics.agg(total("R1_tooshort", "R2_tooshort", "R1R2_tooshort").alias("reads_tooshort"), total("UMI_N", "UMI_homopolymer").alias("reads_noumi"), total("UP_none", "UP_GG").alias("reads_noup"), total("SB_none", "SB_HD1ambig").alias("reads_nosb"))


def write_metrics(df: DataFrame, path: str) -> None:
    """key,value lines in order of keys; one file, as metrics are few."""
    df.select("key", "value").coalesce(1).sortWithinPartitions("key").write.csv(path, header=False)


def write_matrix(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, compression="gzip")


def write_lines(df: DataFrame, path: str, column: str, order: str) -> None:
    """Values one a line in order, over files whose names sort likewise."""
    df.repartitionByRange(order).sortWithinPartitions(order).select(F.col(column).cast("string")).write.text(path, compression="gzip")


def write_puck(df: DataFrame, path: str) -> None:
    df.select("sb", "x", "y").write.csv(path, header=False)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, compression="gzip")


def write_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as Parquet in a folder of its name."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")


def read_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}
