"""Cell tables: gene counts to quality features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beadloom.operators.stats import contamination, fraction


def cells_with(counts: DataFrame, least: int, strict: bool = False) -> DataFrame:
    """(cell, total) of cells whose counts sum to at least `least`, or with strict to more."""
    sums = counts.groupBy("cell").agg(F.sum("n").alias("total"))
    return sums.filter(F.col("total") > least if strict else F.col("total") >= least)


def mito_fraction(counts: DataFrame, pattern: str = "(?i)(^MT-|_MT-)") -> DataFrame:
    return fraction(counts, "cell", F.col("gene").rlike(pattern), F.col("n"))


def intronic_fraction(molecules: DataFrame) -> DataFrame:
    return fraction(molecules, "cell", F.col("umi_type") == 0)


def features(counts: DataFrame, molecules: DataFrame, clean: DataFrame | None = None) -> DataFrame:
    """(cell, total, genes, pct_mt, pct_intronic[, contamination]) of cells that all tables have."""
    out = counts.groupBy("cell").agg(F.sum("n").alias("total"), F.count("*").alias("genes")).filter("total > 10")
    out = out.join(mito_fraction(counts, "(?i)^MT-").withColumnRenamed("fraction", "pct_mt"), "cell").join(intronic_fraction(molecules).withColumnRenamed("fraction", "pct_intronic"), "cell")
    if clean is not None:
        out = out.join(contamination(counts, clean, "cell").withColumnRenamed("fraction", "contamination"), "cell")
    return out


def log_normalised(counts: DataFrame, scale: float = 10_000) -> DataFrame:
    """(gene, cell, w): log1p of counts scaled to the same total for each cell."""
    sums = counts.groupBy("cell").agg(F.sum("n").alias("_t"))
    return counts.join(sums, "cell").select("gene", "cell", F.log1p(F.col("n") / F.col("_t") * scale).alias("w"))


def call_cells(table: DataFrame, inputs: list[str], label: str, rounds: int = 50) -> DataFrame:
    """table with is_cell: a linear support vector machine over standardised features, trained on rows with a label."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    steps = [VectorAssembler(inputCols=inputs, outputCol="_v"), StandardScaler(inputCol="_v", outputCol="_s", withMean=True), LinearSVC(featuresCol="_s", labelCol=label, predictionCol="is_cell", maxIter=rounds)]
    return Pipeline(stages=steps).fit(table.filter(F.col(label).isNotNull())).transform(table).drop("_v", "_s", "rawPrediction")


def principal(counts: DataFrame, k: int = 50, genes: int = 2000) -> DataFrame:
    """(cell, pcs): the first k principal components of log-normalised counts over the genes of greatest variance."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector

    w = log_normalised(counts)
    n = counts.select("cell").distinct().count()
    spread = w.groupBy("gene").agg((F.sum(F.col("w") * F.col("w")) / n - F.pow(F.sum("w") / n, 2)).alias("v"))
    top = [r["gene"] for r in spread.orderBy(F.desc("v"), "gene").limit(genes).collect()]  # at most `genes` names
    wide = w.filter(F.col("gene").isin(top)).groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("gene", "w"))).alias("m"))
    row = array_to_vector(F.array(*(F.coalesce(F.try_element_at("m", F.lit(g)), F.lit(0.0)) for g in top)))
    vectors = wide.select("cell", row.alias("_v"))
    scaled = StandardScaler(inputCol="_v", outputCol="_s", withMean=True).fit(vectors).transform(vectors)
    return PCA(k=min(k, len(top)), inputCol="_s", outputCol="pcs").fit(scaled).transform(scaled).select("cell", "pcs")
