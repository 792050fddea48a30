"""Column expressions on DNA strings: packing, slicing, distances, complexity. All stay in generated code or higher-order functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bead:
    """Where a bead read holds its barcode halves, constant site and molecular identifier: 1-based (start, length)."""

    sb_1: tuple[int, int]
    sb_2: tuple[int, int]
    up: tuple[int, int]
    umi: tuple[int, int]
    site: str

    @property
    def length(self) -> int:
        return self.umi[0] + self.umi[1] - 1


#: The five read layouts with their constant site.
UP_LONG, UP_SHORT = "TCTTCAGCGTTCCCGAGA", "CTGTTTCCTG"
BEADS = {
    "V10": Bead((1, 8), (27, 7), (9, 18), (34, 9), UP_LONG),
    "V15": Bead((1, 8), (9, 7), (16, 10), (26, 9), UP_SHORT),
    "V16": Bead((1, 9), (10, 8), (18, 10), (28, 9), UP_SHORT),
    "V17": Bead((1, 9), (28, 8), (10, 18), (36, 9), UP_LONG),
    "V19": Bead((1, 9), (20, 8), (10, 10), (28, 9), UP_LONG[:10]),
}

#: Digits 0-3 of packed bases; N packs as G.
DIGITS = "ACTG"


def _cut(seq: Column, at: tuple[int, int]) -> Column:
    return F.substring(seq, *at)


def slice_bead(seq: Column, bead: str) -> dict[str, Column]:
    """sb (both halves), up and umi of a bead read."""
    b = BEADS[bead]
    return {"sb": F.concat(_cut(seq, b.sb_1), _cut(seq, b.sb_2)), "up": _cut(seq, b.up), "umi": _cut(seq, b.umi)}


def slice_cell(seq: Column) -> dict[str, Column]:
    """cb (16 bases) and umi (12 bases) of a cell read."""
    return {"cb": F.substring(seq, 1, 16), "umi": F.substring(seq, 17, 12)}


def encode(seq: Column) -> Column:
    """Base-4 number of up to 31 bases, first base lowest; N counts as G."""
    return F.conv(F.reverse(F.translate(seq, "ACTGN", "01233")), 4, 10).cast("bigint")


def decode(number: Column, length: int) -> Column:
    """The `length` bases that encode() packs into number."""
    return F.translate(F.reverse(F.lpad(F.conv(number.cast("string"), 10, 4), length, "0")), "0123", DIGITS)


def count_base(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def commonest_base(seq: Column) -> Column:
    """How often the most frequent of A, C, G, T, N occurs."""
    return F.greatest(*(count_base(seq, b) for b in "ACGTN"))


def longest_run(seq: Column) -> Column:
    """Length of the longest run of one base; 0 for an empty string."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(seq, F.lit(r"((.)\2*)"), F.lit(1)), F.length)), F.lit(0))


def hamming(seq: Column, other: Column | str, length: int) -> Column:
    """Positions of the first `length` that differ; missing bases differ. One sum of comparisons, in generated code."""
    at = lambda k: F.substring(other, k, 1) if isinstance(other, Column) else F.lit(other[k - 1 : k])
    off = F.lit(0)
    for k in range(1, length + 1):
        off = off + F.when(F.substring(seq, k, 1) != at(k), 1).otherwise(0)
    return off


def near_homopolymer(seq: Column, length: int, tolerance: int) -> Column:
    """Whether the first `length` bases are within `tolerance` mismatches of a single repeated base."""
    return F.lit(length) - commonest_base(F.substring(seq, 1, length)) <= tolerance


def neighbours(df: DataFrame, seq: str, length: int, keep: list[str] | None = None) -> DataFrame:
    """(keep, seq, neighbour, pos): all strings over A, C, G, T, N that differ from seq at exactly one 1-based position."""
    keep = keep or []
    out = df.select(*keep, seq, F.explode(F.sequence(F.lit(1), F.lit(length))).alias("pos"))
    base = F.substr(seq, F.col("pos"), F.lit(1))
    out = out.withColumn("_b", F.explode(F.filter(F.array(*map(F.lit, "ACGTN")), lambda b: b != base)))
    return out.select(*keep, seq, F.overlay(seq, "_b", "pos").alias("neighbour"), "pos")


def expand_n(seq: Column) -> Column:
    """Array of the strings that a string can stand for: every N is each of A, C, G, T. Without N, the string itself."""
    each = lambda s: F.transform(F.array(*map(F.lit, "ACGT")), lambda b: F.overlay(s, b, F.instr(s, "N")))
    rounds = F.filter(F.sequence(F.lit(0), count_base(seq, "N")), lambda k: k > 0)
    return F.aggregate(rounds, F.array(seq), lambda found, _: F.flatten(F.transform(found, each)))


#: What each pair of bases 8-9 becomes in a remapped cell barcode.
REMAP = {"TC": "AG", "AG": "TC", "GT": "CA", "CA": "GT"}


def remap(cb: Column) -> Column:
    """A cell barcode with bases 8-9 exchanged by REMAP."""
    pair = F.substring(cb, 8, 2)
    swapped = pair
    for a, b in REMAP.items():
        swapped = F.when(pair == a, b).otherwise(swapped)
    return F.concat(F.substring(cb, 1, 7), swapped, F.substr(cb, F.lit(10)))


def strip_suffix(cb: Column) -> Column:
    return F.regexp_replace(cb, "-[0-9]*$", "")


def half_even(x: Column) -> Column:
    """Rounding to the nearest integer, halves to the even one."""
    return F.bround(x, 0).cast("int")


def kmer(key: Column, length: int, factor: int = 2654435761) -> Column:
    """A deterministic `length`-mer for an integer key, for synthetic reads."""
    return decode(F.pmod(key.cast("bigint") * factor, F.lit(4**length)), length)
