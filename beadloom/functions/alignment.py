"""Column expressions on alignment records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flag bits of unmapped, secondary and supplementary records.
UNWANTED = 4 + 256 + 2048


def strand(flag: Column) -> Column:
    """1 where exactly one of the bits 'reverse' (4) and 'second in pair' (7) is set, else 0."""
    return F.shiftright(flag, 4).bitwiseAND(F.lit(1)).bitwiseXOR(F.shiftright(flag, 7).bitwiseAND(F.lit(1)))


def primary(flag: Column, strict: bool = False) -> Column:
    """Whether a record is a mapped primary one; strict raises an error on others."""
    fine = flag.bitwiseAND(F.lit(UNWANTED)) == 0
    return F.when(fine, True).otherwise(F.raise_error(F.lit("unmapped, secondary or supplementary record")).cast("boolean")) if strict else fine


def mean_rounded(total: Column, n: Column) -> Column:
    """Integer mean, halves up."""
    return ((total + F.floor(n / 2)) / n).cast("bigint")


def with_defaults(cb: Column, ub: Column, xf: Column, re: Column, ts: Column, pa: Column) -> dict[str, Column]:
    """Tags with the values that stand for missing ones."""
    return {"cb": F.coalesce(cb, F.lit("")), "ub": F.coalesce(ub, F.lit("")), "xf": F.coalesce(xf, F.lit(255)), "re": F.coalesce(re, F.lit(ord("X"))), "ts": F.coalesce(ts, F.lit(0)), "pa": F.coalesce(pa, F.lit(0))}
