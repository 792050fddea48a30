"""Sample sheets, job sheets and object listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beadloom.functions.text import basename, before, hyperlink, pad_indexes

#: The second index of names such as D701, and the order in which index kits are asked.
SINGLE_I5 = "CGAGATCT"
KITS = ("ND", "D7", "TT", "NT", "NN", "TS")


def resolved_indexes(names: DataFrame, kits: DataFrame) -> DataFrame:
    """(name, kit, i7, i5): of kits (kit, name, i7, i5) that know a name the first in the order of KITS; an error if none does."""
    place = F.array_position(F.array(*map(F.lit, KITS)), F.col("kit"))
    best = kits.groupBy("name").agg(F.min_by(F.struct("kit", "i7", "i5"), place).alias("_b"))
    out = names.join(best, "name", "left")
    known = F.when(F.col("_b").isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit("unknown index "), F.col("name")))).cast("boolean")
    return out.filter(known).select(*names.columns, "_b.*")


def dual_names(df: DataFrame, name: str = "name") -> DataFrame:
    """df with i7_name and i5_name of names such as ND701ND502; null for other names."""
    dual = F.col(name).rlike("^[ND]7[0-9]{2}[ND]5[0-9]{2}$")
    return df.withColumns({"i7_name": F.when(dual, F.left(name, F.lit(4))), "i5_name": F.when(dual, F.right(name, F.lit(4)))})


def single_indexes(df: DataFrame, name: str = "name") -> DataFrame:
    """df with i7_name of names such as D701, and i5, which is the same for all of them; null for other names."""
    single = F.col(name).rlike("^[ND]7[0-9]{2}$")
    return df.withColumns({"i7_name": F.when(single, F.col(name)), "i5": F.when(single, F.lit(SINGLE_I5))})


def sheet(df: DataFrame) -> str:
    """Text of a sample sheet of (lane, sample, i7, i5), indexes padded; a small table is gathered for it."""
    rows = pad_indexes(df.select("lane", "sample", "i7", "i5").distinct()).orderBy("lane", "sample").collect()
    head = ["[Settings]", "CreateFastqForIndexReads,0", "[Data]", "Lane,Sample_ID,index,index2"]
    return "\n".join([*head, *(f"{r['lane']},{r['sample']},{r['i7']},{r['i5']}" for r in rows)]) + "\n"


def unique_match(names: DataFrame, paths: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """(name, path): the one path that contains each name; an error where none or several do. Names are a short list."""
    found = names.join(paths.select(path), F.contains(path, F.col(name)), "left").groupBy(name).agg(F.count(path).alias("_n"), F.min(path).alias(path))
    return found.filter(F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("not one path for "), F.col(name)))).cast("boolean")).select(name, path)


def looked_up(sheet_: DataFrame, artifact: DataFrame, keys: list[str], value: str, missing: str = "") -> DataFrame:
    """sheet_ with the artifact's value, `missing` where there is none. Row order is kept by the caller's own row id."""
    return sheet_.join(artifact.select(*keys, value), keys, "left").withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit(missing)))


def listed(df: DataFrame, keys: list[str], value: str, mark: str = "\n") -> DataFrame:
    """(keys, value): each group's distinct values in order, joined."""
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(F.col(value).cast("string"))), mark).alias(value))


def parsed_paths(listing: DataFrame, path: str = "path") -> DataFrame:
    """listing with run (third part from the end), file, sample (before '_S') and link."""
    parts = F.split(path, "/")
    return listing.withColumns({"run": F.try_element_at(parts, F.lit(-3)), "file": basename(F.col(path)), "sample": before(basename(F.col(path)), "_S"), "link": hyperlink(F.col(path), basename(F.col(path)))})


def object_counts(listing: DataFrame, keys: list[str]) -> DataFrame:
    return listing.groupBy(*keys).agg(F.count("*").alias("n"))


def memory_estimate(listing: DataFrame, keys: list[str], size: str = "size", factor: float = 2.0, least: int = 64) -> DataFrame:
    """(keys, gb): ceil(max(factor * gigabytes, least))."""
    return listing.groupBy(*keys).agg(F.ceil(F.greatest(factor * F.coalesce(F.sum(size), F.lit(0)) / F.lit(1e9), F.lit(float(least)))).cast("bigint").alias("gb"))


def checked(df: DataFrame, keys: list[str], needed: list[str]) -> DataFrame:
    """df; an error where a needed column is null or empty or a key comes twice."""
    w = Window.partitionBy(*keys)
    fine = F.count("*").over(w) == 1
    for c in needed:
        fine = fine & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    out = df.withColumn("_ok", fine)
    return out.filter(F.when(F.col("_ok"), True).otherwise(F.raise_error(F.lit("empty value or repeated key"))).cast("boolean")).drop("_ok")
