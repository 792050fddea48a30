"""Column expressions on names, paths, indexes and numbers to be shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Affixes of puck names that are dropped, in this order, whatever their case.
PUCK_AFFIXES = ("^recon_", "^reconstruction_", "^pucks_", "^puck_", ".csv$", "_Puck$", "_UMAP[0-9]_.*")


def percent(x: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(F.round(x * 100, digits), digits), F.lit("%"))


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)


def trim_puck_name(name: Column, names: int = 1) -> Column:
    """The last two `_` parts of a puck name without its usual affixes, each cut to its last 30 // names characters."""
    for affix in PUCK_AFFIXES:
        name = F.regexp_replace(name, f"(?i){affix}", "")
    parts, width = F.split(name, "_"), F.lit(30 // names)
    return F.concat_ws("\n", *(F.right(F.try_element_at(parts, F.lit(k)), width) for k in (-2, -1)))


def tag_sequence(feature: Column) -> Column:
    """The barcode behind the last dash of a tag's feature name."""
    return F.regexp_replace(feature, ".+-([ATGCN]{8})", "$1")


def well(group: Column) -> Column:
    """Plate wells A1 ... H12 for groups 1 ... 96."""
    return F.concat(F.char(65 + F.floor((group - 1) / 12)), ((group - 1) % 12 + 1).cast("int").cast("string"))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def hyperlink(url: Column, label: Column) -> Column:
    return F.concat(F.lit('=HYPERLINK("'), url, F.lit('", "'), label, F.lit('")'))


def pad_indexes(df: DataFrame, i7: str = "i7", i5: str = "i5") -> DataFrame:
    """8-base indexes get AT behind i7 and AC before i5, if any index has 10 bases."""
    any_long = df.agg(F.max(F.greatest(F.length(i7), F.length(i5))).alias("_w")).select((F.col("_w") >= 10).alias("_long"))
    out = df.join(F.broadcast(any_long))  # one row
    long = F.col("_long")
    return out.withColumns({i7: F.when(long & (F.length(i7) == 8), F.concat(i7, F.lit("AT"))).otherwise(F.col(i7)), i5: F.when(long & (F.length(i5) == 8), F.concat(F.lit("AC"), i5)).otherwise(F.col(i5))}).drop("_long")


def bead_diameter(beads: Column) -> Column:
    """Diameter in micrometres of a puck with so many beads; an error below 0.3 million."""
    # Smallest bead counts and diameters.
    steps = ((17_000_000, 70_000), (8_430_000, 40_000), (4_220_000, 30_000), (1_630_000, 20_000), (300_000, 12_000))
    out = F.raise_error(F.lit("too few beads for a puck")).cast("int")
    for least, diameter in reversed(steps):
        out = F.when(beads > least, diameter).otherwise(out)
    return out


def clip01(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0))


def min_max(df: DataFrame, x: str, name: str) -> DataFrame:
    """df with x scaled to 0 ... 1 over the whole table; null where all values are equal."""
    ends = df.agg(F.min(x).alias("_low"), F.max(x).alias("_high"))  # one row
    return df.join(F.broadcast(ends)).withColumn(name, F.try_divide(F.col(x) - F.col("_low"), F.col("_high") - F.col("_low"))).drop("_low", "_high")


def natural_order(label: Column) -> Column:
    """A sort key by which numbers within labels count as numbers: the first number (none first), then the text."""
    return F.struct(F.regexp_extract(label, r"^[^0-9]*", 0).alias("head"), F.coalesce(F.nullif(F.regexp_extract(label, "[0-9]+", 0), F.lit("")).cast("bigint"), F.lit(-1)).alias("number"), label.alias("label"))
