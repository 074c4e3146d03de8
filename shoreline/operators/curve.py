"""Positions on a space-filling curve through several columns.

Every column is cut at the quantiles of a bounded sample; a value's place among
the cuts is its rank. The bits of the ranks, interleaved, are the position:
rows close on the curve are close in every column, so a file of neighbours
covers a narrow range of each. Cuts only decide where rows lie, never what a
query returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.operators.read import quote

#: Rows sampled for the cuts, and bits of a rank by number of columns.
SAMPLE, BITS = 10_000, {2: 8, 3: 6, 4: 5}


def quantile_cuts(df: DataFrame, columns: list[str], bits: int) -> list[list]:
    """Per column up to ``2**bits - 1`` ascending values between its quantiles."""
    rows = df.select(*[F.col(quote(c)) for c in columns]).orderBy(F.rand(17)).limit(SAMPLE).collect()
    out = []
    for i in range(len(columns)):
        values = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        at = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        out.append([v for k, v in enumerate(at) if k == 0 or v != at[k - 1]])
    return out


def rank(value: Column, cuts: list) -> Column:
    """How many cuts are not above ``value`` (a binary search; NULL ranks last)."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return search(0, len(cuts))


def interleave(ranks: list[Column], bits: int) -> Column:
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for k, r in enumerate(ranks):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - k))
    return out


def curve_position(df: DataFrame, columns: list[str]) -> Column:
    """The position of a row of ``df`` (one sampling job)."""
    bits = BITS[len(columns)]
    cuts = quantile_cuts(df, columns, bits)
    return interleave([rank(F.col(quote(c)), cut) for c, cut in zip(columns, cuts)], bits)


__all__ = ["curve_position", "quantile_cuts", "rank", "interleave"]
